"""Scales, regressions and conjoint models."""

import itertools

from pyspark.sql import functions as F

from ...functions.scalars import round6
from ...operators import conjoint, models, moments, roles, scales
from ...operators.profile import is_likert_item, profile
from ..fixtures import view, with_views
from ..holding import hold
from . import query
from .sql import normal_p, r6, union_all

_SETS = [["product_quality", "product_quality_2", "product_quality_3"], ["perceived_value", "perceived_value_2"],
         ["brand_trust", "brand_trust_2"], ["purchase_intention", "purchase_intention_2"]]


def _alpha_sql(items: list[str]) -> str:
    """Row ``(n, alpha)`` of one item set over its complete rows."""
    total = " + ".join(items)
    k = len(items)
    return (f"select count(*) as n, case when count(*) >= {max(8, k + 2)} and var_samp({total}) > 0 then "
            f"{k}.0 / {k - 1} * (1 - ({' + '.join(f'var_samp({i})' for i in items)}) / var_samp({total})) end as alpha "
            f"from survey where {' and '.join(f'{i} is not null' for i in items)}")


def _mean_corr_sql(items: list[str]) -> str:
    pairs = list(itertools.combinations(items, 2))
    return f"(select ({' + '.join(f'abs(corr({a}, {b}))' for a, b in pairs)}) / {len(pairs)} from survey)"


def _rated_sql(sets: list[list[str]]) -> str:
    label = ("case when alpha >= 0.8 then 'good' when alpha >= 0.7 then 'acceptable' when alpha >= 0.6 then 'exploratory' "
             "when mean_corr >= 0.45 then 'two_item_exploratory' else 'weak' end")
    rows = union_all(f"select {s} as subset, '{', '.join(i)}' as items, {len(i)} as k, n, alpha, {_mean_corr_sql(i)} as mean_corr "
                     f"from ({_alpha_sql(i)})" for s, i in enumerate(sets))
    return f"select *, {label} as reliability, coalesce(alpha, 0) + coalesce(mean_corr, 0) / 2 as score from ({rows})"


@query("cronbach_alpha", with_views(f"select items, n, {r6('alpha')} as alpha from ({_rated_sql(_SETS)})", "survey"))
def cronbach_alpha(spark, d):
    t = scales.cronbach_alphas(view(spark, d, "survey"), _SETS)
    return t.select(F.array_join("items", ", ").alias("items"), "n", round6(F.col("alpha")).alias("alpha"))


@query("mean_interitem", with_views(f"select items, {r6('mean_corr')} as mean_corr from ({_rated_sql(_SETS)})", "survey"))
def mean_interitem(spark, d):
    survey = view(spark, d, "survey")
    sets = spark.createDataFrame(list(enumerate(_SETS)), "subset int, items array<string>")
    corr = moments.correlations(survey, [i for s in _SETS for i in s])
    t = scales.mean_interitem(corr, sets).join(sets, "subset")
    return t.select(F.array_join("items", ", ").alias("items"), round6(F.col("mean_corr")).alias("mean_corr"))


_SQUARE = ["income", "monthly_spend", "product_quality", "product_quality_3", "brand_trust"]


@query("correlation_matrix", with_views(union_all("select '" + a + "' as variable, " + ", ".join(
    r6("1" if a == b else f"corr({a}, {b})") + f" as {b}" for b in _SQUARE) + " from survey" for a in _SQUARE), "survey"))
def correlation_matrix(spark, d):
    t = moments.correlation_square(moments.correlations(view(spark, d, "survey"), _SQUARE), _SQUARE)
    return t.select("variable", *[round6(F.col(c)).alias(c) for c in _SQUARE])


_MIXED = [*_SETS, ["product_quality", "income"], ["brand_trust", "perceived_value"]]


@query("reliability_label", with_views(
    f"select items, reliability, {r6('score')} as score from ({_rated_sql(_MIXED)})", "survey"))
def reliability_label(spark, d):
    t = scales.rated_subsets(view(spark, d, "survey"), _MIXED)
    return t.select(F.array_join("items", ", ").alias("items"), "reliability", round6(F.col("score")).alias("score"))


_CANDIDATES = [(g[0], s) for g in _SETS for s in scales.item_subsets(g)]


@query("best_subset", with_views(f"""
select construct, items, reliability, {r6('score')} as score from (
  select r.*, g.construct, row_number() over (partition by g.construct order by score desc, subset) as rn
  from ({_rated_sql([s for _, s in _CANDIDATES])}) r
  join (values {', '.join(f"({i}, '{g}')" for i, (g, _) in enumerate(_CANDIDATES))}) g(id, construct) on g.id = r.subset
  where reliability <> 'weak') where rn = 1""", "survey"))
def best_subset(spark, d):
    survey = view(spark, d, "survey")
    items = [p.name for p in profile(survey).values() if is_likert_item(p)]
    groups = {g: i for g, i in scales.semantic_groups(items).items() if len(i) > 1}
    candidates = [(g, s) for g, i in groups.items() for s in scales.item_subsets(i)]
    t = scales.best_subsets(scales.rated_subsets(survey, [s for _, s in candidates]), {i: g for i, (g, _) in enumerate(candidates)})
    return t.select("construct", F.array_join("items", ", ").alias("items"), "reliability", round6(F.col("score")).alias("score"))


@query("construct_summary")
def construct_summary(spark, d):
    return scales.detect_constructs(view(spark, d, "survey"))[1]


# The same answers under names that share nothing, so that only correlations bring them together.
_PLAIN = dict(zip(["alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf", "hotel", "india"], [i for s in _SETS for i in s]))


def _greedy_sql() -> str:
    """Strongest free pair, first fair third, until the set is weak or no strong pair is left: four rounds at most for nine items."""
    names = list(_PLAIN)
    sets = [list(c) for k in (2, 3) for c in itertools.combinations(names, k)]
    places = {n: i for i, n in enumerate(names)}
    steps = ["plain as (select " + ", ".join(f"{old} as {new}" for new, old in _PLAIN.items()) + " from survey)",
             "rated as materialized (" + _rated_sql(sets).replace("from survey", "from plain") + ")",
             f"keys as (select * from (values {', '.join(f'({i}, {[places[n] for n in s]})' for i, s in enumerate(sets))}) v(subset, places))",
             "r as materialized (" + union_all(f"select {places[a]} as i, {places[b]} as j, abs(corr({a}, {b})) as r from plain" for a, b in itertools.combinations(names, 2)) + ")",
             "links as (select i, j, r from r union all select j, i, r from r)",
             "s0 as (select 0 as round, cast([] as int[]) as used, cast([] as int[]) as items, cast(null as int) as subset, '' as label)"]
    for k in range(1, 5):
        steps += [f"p{k} as (select used, i, j from s{k - 1}, r where r >= 0.55 and not list_contains(used, i) and not list_contains(used, j) order by r desc, i, j limit 1)",
                  f"t{k} as (select min(a.j) as third from p{k} p join links a on a.i = p.i join links b on b.i = p.j and b.j = a.j where a.r >= 0.45 and b.r >= 0.45 and not list_contains(used, a.j))",
                  f"n{k} as (select used, list_filter([i, j, third], lambda x: x is not null) as items from p{k}, t{k})",
                  f"s{k} as materialized (select {k} as round, list_concat(used, n.items) as used, n.items as items, rated.subset as subset, reliability as label from n{k} n join keys on places = list_sort(n.items) "
                  f"join rated on rated.subset = keys.subset where reliability <> 'weak')"]
    picks = union_all(f"select * from s{k}" for k in range(1, 5))
    named = f"array_to_string(list_transform(p.items, lambda i: {names}[i + 1]), ', ')"
    return (f"with {', '.join(steps)} select 'construct_auto_' || round as construct, {named} as items, k as n_items, {r6('alpha')} as cronbach_alpha, {r6('mean_corr')} as mean_interitem_corr, "
            f"reliability, 'correlation_auto' as source, 'construct_auto_' || round as construct_base from ({picks}) p join rated using (subset)")


@query("construct_correlation", with_views(_greedy_sql(), "survey"))
def construct_correlation(spark, d):
    plain = view(spark, d, "survey").select(*[F.col(old).alias(new) for new, old in _PLAIN.items()])
    t = scales.detect_constructs(plain)[1]
    return t.select(*[round6(F.col(c)).alias(c) if k == "double" else c for c, k in t.dtypes])


@query("construct_semantic", with_views(f"""
select g.construct || '_score' as construct, items, k as n_items, {r6('alpha')} as cronbach_alpha, {r6('mean_corr')} as mean_interitem_corr, reliability,
       'semantic_auto' as source, g.construct as construct_base from (
  select r.*, g.construct, row_number() over (partition by g.construct order by score desc, subset) as rn
  from ({_rated_sql([s for _, s in _CANDIDATES])}) r
  join (values {', '.join(f"({i}, '{g}')" for i, (g, _) in enumerate(_CANDIDATES))}) g(id, construct) on g.id = r.subset
  where reliability <> 'weak') g where rn = 1""", "survey"))
def construct_semantic(spark, d):
    """Those of the constructs that share a name; the correlation-based ones follow from what these leave over."""
    t = scales.detect_constructs(view(spark, d, "survey"))[1].where("source = 'semantic_auto'")
    return t.select(*[round6(F.col(c)).alias(c) if k == "double" else c for c, k in t.dtypes])


@query("construct_scores", with_views("select respondent, " + ", ".join(
    "case when " + " + ".join(f"(case when {i} is null then 0 else 1 end)" for i in s) + f" >= {(len(s) + 1) // 2} then "
    + r6("(" + " + ".join(f"coalesce({i}, 0)" for i in s) + ") / cast(" + " + ".join(
        f"(case when {i} is null then 0 else 1 end)" for i in s) + " as double)") + f" end as {s[0]}_score"
    for s in _SETS) + " from survey", "survey"))
def construct_scores(spark, d):
    survey = view(spark, d, "survey")
    names = scales.score_names(survey.columns, [s[0] for s in _SETS])
    return survey.select("respondent", *[round6(scales.score_column(survey, s)).alias(names[s[0]]) for s in _SETS])


_CAND = ["product_quality", "product_quality_2", "product_quality_3", "perceived_value", "perceived_value_2", "brand_trust", "brand_trust_2"]


@query("rank_predictors", with_views("select * from (" + union_all(
    f"select '{c}' as variable, count({c} + purchase_intention) as n, {r6(f'abs(corr({c}, purchase_intention))')} as abs_r from survey"
    for c in _CAND) + ") order by abs_r desc limit 12", "survey"))
def rank_predictors(spark, d):
    survey = view(spark, d, "survey")
    stats = profile(survey)
    outcome = roles.choose_outcome(survey.columns)
    t = roles.rank_predictors(survey, outcome, roles.predictor_candidates(survey.columns, outcome, {}, stats))
    return t.select("variable", "n", round6(F.col("abs_r")).alias("abs_r"))


_OLS_SQL = f"""
with f as (select avg(product_quality_3) m1, stddev_pop(product_quality_3) s1, avg(brand_trust) m2, stddev_pop(brand_trust) s2 from survey),
l as (select (product_quality_3 - m1) / s1 as z1, (brand_trust - m2) / s2 as z2, purchase_intention as y
      from survey, f where product_quality_3 is not null),
c as (select count(*)::double as n, avg(z1) a1, avg(z2) a2, var_pop(z1) c11, var_pop(z2) c22, covar_pop(z1, z2) c12,
             covar_pop(z1, y) / stddev_pop(y) as p, covar_pop(z2, y) / stddev_pop(y) as q from l),
b as (select *, c11 * c22 - c12 * c12 as det from c),
e as (select *, (c22 * p - c12 * q) / det as b1, (c11 * q - c12 * p) / det as b2 from b),
g as (select *, n * (1 - b1 * p - b2 * q) / (n - 3) as mse from e),
t as (select 'intercept' as term, -(b1 * a1 + b2 * a2) as beta,
             sqrt(mse * (1 / n + (a1 * a1 * c22 - 2 * a1 * a2 * c12 + a2 * a2 * c11) / (n * det))) as se from g
  union all select 'product_quality_3', b1, sqrt(mse * c22 / (n * det)) from g
  union all select 'brand_trust', b2, sqrt(mse * c11 / (n * det)) from g)
select 'purchase_intention' as outcome, term, {r6('beta')} as standardized_beta, {r6('se')} as std_error,
       {r6('beta / se')} as t_or_z, {r6(normal_p('(beta / se)'))} as approx_p from t"""


@query("ols_regression", with_views(_OLS_SQL, "survey"))
def ols_regression(spark, d):
    t, _ = models.run_regression(view(spark, d, "survey"), "purchase_intention", ["product_quality_3", "brand_trust"])
    return t.select("outcome", "term", *[round6(F.col(c)).alias(c) for c in ("standardized_beta", "std_error", "t_or_z", "approx_p")])


_PATHS = [("product_quality", "perceived_value", "purchase_intention"), ("product_quality_3", "brand_trust", "purchase_intention"),
          ("brand_trust", "perceived_value_2", "purchase_intention")]


@query("mediation_point", with_views("with r as (" + union_all(
    f"select '{x}' as predictor, '{m}' as mediator, count(*) as n, corr({x}, {m}) as rxm, corr({x}, {y}) as rxy, corr({m}, {y}) as rmy "
    f"from survey where {x} is not null and {m} is not null and {y} is not null" for x, m, y in _PATHS) + f""")
select predictor, mediator, n, {r6('rxm')} as a_path, {r6('rxm * (rmy - rxm * rxy) / (1 - rxm * rxm)')} as indirect_effect,
       {r6('(rxy - rxm * rmy) / (1 - rxm * rxm)')} as direct_effect from r""", "survey"))
def mediation_point(spark, d):
    t = models.mediation_effects(models.mediation_sums(view(spark, d, "survey"), _PATHS, "respondent", 0, 42))
    names = F.array(*[F.struct(F.lit(x).alias("predictor"), F.lit(m).alias("mediator")) for x, m, _ in _PATHS])
    return t.withColumn("_n", F.get(names, F.col("path"))).select(
        "_n.predictor", "_n.mediator", F.col("sw").cast("bigint").alias("n"),
        *[round6(F.col(c)).alias(c) for c in ("a_path", "indirect_effect", "direct_effect")])


_MASK = f"cast({2**64} as uhugeint)"


def _mix_sql(z: str, shift: int, factor: int) -> str:
    return f"((xor({z}, {z} >> {shift})) * cast({factor} as uhugeint)) % {_MASK}"


# The row's weights for every draw as 64-bit arithmetic in wider integers, then weighted correlations per draw.
_BOOTSTRAP_SQL = f"""
with w0 as (select respondent, draw, (cast(respondent as uhugeint) * cast({0xD1342543DE82EF95} as uhugeint)
              + cast(draw + 42 * 1000003 as uhugeint) * cast({0x9E3779B97F4A7C15} as uhugeint) % {_MASK}) % {_MASK} as z
            from survey, (select unnest(range(1, 301)) as draw)),
w1 as (select respondent, draw, {_mix_sql('z', 30, 0xBF58476D1CE4E5B9)} as z from w0),
w2 as (select respondent, draw, {_mix_sql('z', 27, 0x94D049BB133111EB)} as z from w1),
w3 as (select respondent, draw, xor(z, z >> 31) as z from w2),
w as (select respondent, draw, cast({' + '.join(f"(z >= cast({int(e)} as uhugeint))::int" for e in models.POISSON_ENDS)} as double) as w from w3
      union all select respondent, 0, 1 from survey),
v as ({union_all(f"select {i} as path, respondent, cast({x} as double) as x, cast({m} as double) as m, cast({y} as double) as y from survey where {x} is not null and {m} is not null and {y} is not null" for i, (x, m, y) in enumerate(_PATHS))}),
u as (select path, draw, sum(w) as n, sum(w * x) / sum(w) as ax, sum(w * m) / sum(w) as am, sum(w * y) / sum(w) as ay, sum(w * x * x) / sum(w) as xx, sum(w * m * m) / sum(w) as mm,
             sum(w * y * y) / sum(w) as yy, sum(w * x * m) / sum(w) as xm, sum(w * x * y) / sum(w) as xy, sum(w * m * y) / sum(w) as my from w join v using (respondent) group by path, draw),
r as (select path, draw, n, (xm - ax * am) / sqrt((xx - ax * ax) * (mm - am * am)) as rxm, (xy - ax * ay) / sqrt((xx - ax * ax) * (yy - ay * ay)) as rxy,
             (my - am * ay) / sqrt((mm - am * am) * (yy - ay * ay)) as rmy from u),
e as (select path, draw, n, rxm, rxm * (rmy - rxm * rxy) / (1 - rxm * rxm) as indirect, (rxy - rxm * rmy) / (1 - rxm * rxm) as direct from r),
c as (select path, quantile_cont(indirect, 0.025) filter (draw > 0) as lo, quantile_cont(indirect, 0.975) filter (draw > 0) as hi from e group by path)
select case path {' '.join(f"when {i} then '{p[0]}'" for i, p in enumerate(_PATHS))} end as predictor, case path {' '.join(f"when {i} then '{p[1]}'" for i, p in enumerate(_PATHS))} end as mediator,
       'purchase_intention' as outcome, cast(n as bigint) as n, {r6('rxm')} as a_path, {r6('indirect')} as indirect_effect, {r6('direct')} as direct_effect,
       {r6('lo')} as boot_ci_low, {r6('hi')} as boot_ci_high, lo > 0 or hi < 0 as supported from e join c using (path) where draw = 0"""


@query("mediation_bootstrap", with_views(_BOOTSTRAP_SQL, "survey"))
def mediation_bootstrap(spark, d):
    t = models.run_mediation(view(spark, d, "survey"), _PATHS, "respondent")
    return t.select("predictor", "mediator", "outcome", "n", *[round6(F.col(c)).alias(c) for c in (
        "a_path", "indirect_effect", "direct_effect", "boot_ci_low", "boot_ci_high")], "supported")


_MODERATION = list(itertools.product(["product_quality", "brand_trust"], ["income", "segment"]))


@query("moderation", with_views("with l as (" + union_all(f"""
select '{x}' as predictor, '{w}' as moderator, ({x} - avg({x}) over ()) / stddev_pop({x}) over () as z1,
       ({w} - avg({w}) over ()) / stddev_pop({w}) over () as z2, purchase_intention as y from survey""" for x, w in _MODERATION) + f"""),
t as (select *, z1 * z2 as z3 from l),
c as (select predictor, moderator, count(*)::double as n, var_pop(z1) a, covar_pop(z1, z2) b, covar_pop(z1, z3) c, var_pop(z2) d,
             covar_pop(z2, z3) e, var_pop(z3) f, covar_pop(z1, y) / stddev_pop(y) p, covar_pop(z2, y) / stddev_pop(y) q,
             covar_pop(z3, y) / stddev_pop(y) r from t group by all),
i as (select *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) as det from c),
s as (select *, ((d * f - e * e) * p + (c * e - b * f) * q + (b * e - c * d) * r) / det as b1,
             ((c * e - b * f) * p + (a * f - c * c) * q + (b * c - a * e) * r) / det as b2,
             ((b * e - c * d) * p + (b * c - a * e) * q + (a * d - b * b) * r) / det as b3 from i),
g as (select *, b1 * p + b2 * q + b3 * r as r2, sqrt(n * (1 - b1 * p - b2 * q - b3 * r) / (n - 4) * (a * d - b * b) / (n * det)) as se from s)
select predictor, moderator, cast(n as bigint) as n, {r6('b3')} as standardized_beta, {r6('se')} as std_error, {r6('b3 / se')} as t_or_z,
       {r6(normal_p('(b3 / se)'))} as approx_p, {r6('r2')} as r2 from g""", "survey"))
def moderation(spark, d):
    t = models.run_moderation(view(spark, d, "survey"), "purchase_intention", ["product_quality", "brand_trust"], ["income", "segment"])
    return t.select("predictor", "moderator", "n",
                    *[round6(F.col(c)).alias(c) for c in ("standardized_beta", "std_error", "t_or_z", "approx_p", "r2")])


@query("top_drivers", with_views(f"""with fit as (select * from ({_OLS_SQL}))
select outcome, term, standardized_beta, cast(row_number() over (order by abs(standardized_beta) desc, term) as int) as place,
       case when standardized_beta > 0 then 'positive' else 'negative' end as direction from fit where term <> 'intercept'""", "survey"))
def top_drivers(spark, d):
    t, _ = models.run_regression(view(spark, d, "survey"), "purchase_intention", ["product_quality_3", "brand_trust"])
    return models.top_drivers(t).select("outcome", "term", round6(F.col("standardized_beta")).alias("standardized_beta"), "place", "direction")


_ATTRIBUTES = ["product_type", "price_band", "package"]


@query("choice_profile_counts", with_views("""
select product_type, price_band, package, count(*) as n, cast(sum(chosen) as double) as n_chosen from choice group by all""", "choice"))
def choice_profile_counts(spark, d):
    return conjoint.choice_profile_counts(view(spark, d, "choice"), "chosen", _ATTRIBUTES)


_CHOICE_COLUMNS = ["respondent", "alternative", "product_type", "price_band", "package", "chosen", "rating"]


@query("conjoint_structure", with_views("with c as (" + union_all(
    f"select {i} as at, '{c}' as name, count(distinct {c}) as d, count(*) as n from choice" for i, c in enumerate(_CHOICE_COLUMNS)) + """)
select 'chosen' as role, name from c where name = 'chosen' union all select 'rating', name from c where name = 'rating'
union all select 'attribute', name from c where name not in ('chosen', 'rating') and d between 2 and 20 and d <= greatest(20, n * 0.75)
and not regexp_matches(name, 'id|编号|openid|phone|email')""", "choice"))
def conjoint_structure(spark, d):
    choice = view(spark, d, "choice")
    chosen, rating, attributes = conjoint.detect_structure(profile(choice))
    return spark.createDataFrame([("chosen", chosen), ("rating", rating), *[("attribute", a) for a in attributes]], "role string, name string")


# Profiles with the place of their intercept and three level terms, and the terms in order.
_TERMS_SQL = f"""sizes as (select count(distinct product_type) as n1, count(distinct price_band) as n2, count(distinct package) as n3 from choice),
g as (select product_type, price_band, package, count(*) as n, sum(chosen) as y, sum(rating) as r from choice group by all),
x as (select n, y, r, [1, 1 + dense_rank() over (order by product_type), 1 + n1 + dense_rank() over (order by price_band),
             1 + n1 + n2 + dense_rank() over (order by package)] as ks from g, sizes),
terms as (select 1 as k, 'intercept' as term, 'model' as attribute union all """ + union_all(
    f"select 1 + {before} + row_number() over (order by level), '{a}_' || level, '{a}' from (select distinct cast({a} as varchar) as level from choice), sizes"
    for a, before in zip(_ATTRIBUTES, ("0", "n1", "n1 + n2"))) + ")"


def _descent_sql(error: str, rate: float, steps: int, l2: float) -> str:
    """Full-batch steps from zero; ``error`` is the summed error of a profile given its linear value ``v``."""
    return (f"it as (select 0 as step, list_transform(range(1 + n1 + n2 + n3), lambda i: cast(0 as double)) as b from sizes union all "
            f"select step + 1, list(v order by k) from (select step, k, b[k] - {rate} * (sum(e) / (select sum(n) from x) + case when k > 1 then {l2} * b[k] else 0 end) as v "
            f"from (select step, b, unnest(ks) as k, {error} as e from (select step, b, x.*, list_sum(list_transform(ks, lambda j: b[j])) as v from it, x where step < {steps})) "
            f"group by step, k, b) group by step)")


_CHOICE_SQL = (f"with recursive {_TERMS_SQL}, {_descent_sql('n / (1 + exp(-greatest(-30, least(30, v)))) - y', 0.08, 2500, 0.001)} "
               f"select term, {r6('b[k]')} as utility, attribute from it, terms where step = 2500")
# Squared errors from zero settle at the minimum-norm solution.
_RATING_SQL = (f"with recursive {_TERMS_SQL}, m as (select avg(rating) as mu, stddev_pop(rating) as sd from choice), "
               f"{_descent_sql('(n * v - (r - n * (select mu from m)) / (select sd from m))', 0.4, 3000, 0)} "
               f"select term, {r6('b[k]')} as utility, attribute from it, terms where step = 3000")


@query("conjoint_choice", with_views(_CHOICE_SQL, "choice"))
def conjoint_choice(spark, d):
    choice = hold(view(spark, d, "choice").select("chosen", *_ATTRIBUTES))
    return conjoint.run_conjoint(choice, "chosen", None, _ATTRIBUTES)[0].select("term", round6(F.col("utility")).alias("utility"), "attribute")


@query("conjoint_rating", with_views(_RATING_SQL, "choice"))
def conjoint_rating(spark, d):
    choice = hold(view(spark, d, "choice").select("rating", *_ATTRIBUTES))
    return conjoint.run_conjoint(choice, None, "rating", _ATTRIBUTES)[0].select("term", round6(F.col("utility")).alias("utility"), "attribute")


# One attribute has a closed form: the intercept is the sum of the level means over one more than the levels.
@query("conjoint_rating_single", with_views(f"""
with z as (select product_type, (rating - avg(rating) over ()) / stddev_pop(rating) over () as y from choice),
g as (select product_type, count(*) as n, avg(y) as m, sum(y * y) as ss from z group by 1),
t as (select sum(m) / (count(*) + 1) as b0, count(*) + 1 as p, sum(n) as rows, sum(1.0 / n) as inv, sum(ss - n * m * m) / (sum(n) - count(*) - 1) as mse from g),
c as (select 'intercept' as term, b0 as b, sqrt(mse * inv) / p as se, 'model' as attribute from t union all
      select 'product_type_' || product_type, m - b0, sqrt(mse * ((1 - 1.0 / p) * (1 - 1.0 / p) / n + (inv - 1.0 / n) / (p * p))), 'product_type' from g, t)
select term, {r6('b')} as utility, {r6('se')} as std_error, {r6('b / se')} as t_or_z, {r6(normal_p('(b / se)'))} as approx_p, attribute from c""", "choice"))
def conjoint_rating_single(spark, d):
    choice = hold(view(spark, d, "choice").select("rating", "product_type"))
    t = conjoint.run_conjoint(choice, None, "rating", ["product_type"])[0]
    return t.select("term", *[round6(F.col(c)).alias(c) for c in ("utility", "std_error", "t_or_z", "approx_p")], "attribute")


@query("conjoint_importance", with_views("with s as (" + union_all(
    f"select '{a}' as attribute, cast({a} as varchar) as level, avg(chosen) as share from choice group by {a}" for a in _ATTRIBUTES) + f"""),
r as (select attribute, max(share) - min(share) as rng from s group by attribute)
select attribute, {r6('rng')} as utility_range, {r6('rng / (select sum(rng) from r)')} as relative_importance from r""", "choice"))
def conjoint_importance(spark, d):
    """Importance from the share of choices per level as utility."""
    counts = conjoint.choice_profile_counts(view(spark, d, "choice"), "chosen", _ATTRIBUTES)
    long = counts.select("n", "n_chosen", *[F.col(a).cast("string").alias(a) for a in _ATTRIBUTES]).unpivot(
        ["n", "n_chosen"], _ATTRIBUTES, "attribute", "level")
    shares = long.groupBy("attribute", "level").agg((F.sum("n_chosen") / F.sum("n")).alias("utility"))
    t = conjoint.attribute_importance(shares)
    return t.select("attribute", round6(F.col("utility_range")).alias("utility_range"),
                    round6(F.col("relative_importance")).alias("relative_importance"))
