"""Segments and personas."""

import numpy as np
from pyspark.sql import functions as F

from ...functions import fixed_values as fv
from ...functions.scalars import round6
from ...operators import clean, segments
from ...operators.profile import profile
from ..fixtures import view, with_views
from ..holding import hold
from . import query
from .sql import contains_any, r6, union_all

_FEATURES = ["product_quality", "perceived_value", "brand_trust", "purchase_intention", "monthly_spend"]
_SHORT = ["product_quality", "perceived_value", "brand_trust"]


@query("cluster_features", with_views("select variable from (" + union_all(
    f"select '{c}' as variable, count({c}) >= 0.6 * count(*) as keep from survey" for c in [*_FEATURES, "product_quality_3"])
    + ") where keep", "survey"))
def cluster_features(spark, d):
    stats = profile(view(spark, d, "survey"))
    names = segments.cluster_features(stats, [*_FEATURES, "product_quality_3", "market_segment"])
    return spark.createDataFrame([(n,) for n in names], "variable string")


def _standardized(spark, d):
    z, kept = clean.impute_and_standardize(view(spark, d, "survey"), _FEATURES, ["respondent"])
    return hold(z), kept


_PASSES = 6
_COORDS = [f"z{i}" for i in range(len(_FEATURES))]


def _bands(z, kept, k):
    """First centers: mean of each of k bands of the standardised spending."""
    band = F.greatest(F.lit(0), F.least(F.lit(k - 1), F.floor((F.col("monthly_spend") + 1.75) * k / 3.5)))
    rows = z.groupBy(band.alias("band")).agg(*[F.avg(f).alias(f) for f in kept]).orderBy("band").collect()
    return np.array([[r[f] for f in kept] for r in rows])


# Plain Lloyd passes for several k at once, then the nearest center of every row and the sizes.
def _lloyd_sql(ks) -> str:
    means = ", ".join(f"avg({c}) as {c}" for c in _COORDS)
    distance = " + ".join(f"(z.{c} - c.{c}) * (z.{c} - c.{c})" for c in _COORDS)
    steps = [f"z as materialized (select respondent, {', '.join(f'({f} - avg({f}) over ()) / stddev_pop({f}) over () as {c}' for f, c in zip(_FEATURES, _COORDS))} from survey)",
             f"c0 as materialized (select k, greatest(0, least(k - 1, floor(({_COORDS[-1]} + 1.75) * k / 3.5))) as j, {means} from z, (select unnest({list(ks)}) as k) group by 1, 2)"]
    for i in range(_PASSES + 1):
        steps.append(f"a{i} as materialized (select c.k, z.respondent, min_by(c.j, {distance}) as j, min({distance}) as d from z, c{i} c group by c.k, z.respondent)")
        steps.append(f"c{i + 1} as materialized (select a.k, a.j, {means} from a{i} a join z using (respondent) group by a.k, a.j)")
    steps.append(f"seg as (select k, j, n, cast(row_number() over (partition by k order by n desc, {', '.join(f'round({c}, 9)' for c in _COORDS)}) as int) as segment "
                 f"from (select k, j, count(*) as n from a{_PASSES} group by k, j) join c{_PASSES} using (k, j))")
    return ", ".join(steps)


@query("kmeans_segments", with_views(f"with {_lloyd_sql([4])} select respondent, segment from a{_PASSES} join seg using (k, j)", "survey"))
def kmeans_segments(spark, d):
    z, kept = _standardized(spark, d)
    points = hold(segments.counted_points(z, kept))
    fitted = segments.fit_kmeans(points, kept, 4, max_iter=_PASSES, starts=[_bands(z, kept, 4)])[0]
    return segments.assign_segments(z, kept, segments.ordered_centers(points, kept, fitted)[0], "respondent")


@query("kmeans_restarts")
def kmeans_restarts(spark, d):
    """Ten random starts."""
    z, kept = _standardized(spark, d)
    points = hold(segments.counted_points(z, kept))
    centers, _ = segments.ordered_centers(points, kept, segments.fit_kmeans(points, kept, 4)[0])
    return segments.assign_segments(z, kept, centers, "respondent")


_KS = [2, 3, 4, 5]


@query("select_k", with_views(f"""with {_lloyd_sql(_KS)},
fit as (select k, sum(d) as inertia from a{_PASSES} group by k),
share as (select k, case when count(*) = k then min(n) / sum(n) else 0 end as min_share from seg group by k),
l as (select k, segment, z.* from a{_PASSES} a join seg using (k, j) join z using (respondent)),
anchors as (select respondent from z order by (respondent * 7919) % 10007, respondent limit 500),
g as (select a.k, a.respondent as id, a.segment as own, b.segment as other, count(*) as n, sum(sqrt({' + '.join(f'(a.{c} - b.{c}) * (a.{c} - b.{c})' for c in _COORDS)})) as s
      from l a join anchors using (respondent) join l b on a.k = b.k group by all),
ab as (select k, id, max(case when own = other then n end) as own_n, max(case when own = other then s / (n - 1) end) as a, min(case when own <> other then s / n end) as b from g group by k, id),
sil as (select k, avg(case when greatest(a, b) > 0 then (b - a) / greatest(a, b) else 0 end) as silhouette from ab where own_n > 1 and b is not null group by k),
best as (select k from share join sil using (k) where min_share >= 0.05 order by k not in (3, 4), silhouette desc, k limit 1)
select cast(k as int) as k, {r6('inertia')} as inertia, {r6('min_share')} as min_share, {r6('silhouette')} as silhouette, k = coalesce((select k from best), 2) as selected
from fit join share using (k) join sil using (k)""", "survey"))
def select_k(spark, d):
    z, kept = _standardized(spark, d)
    anchors = z.orderBy((F.col("respondent") * 7919) % 10007, "respondent").limit(500)
    t = segments.select_k(z, kept, "respondent", max_iter=_PASSES, starts={k: [_bands(z, kept, k)] for k in _KS}, anchors=anchors)[0]
    return t.select("k", *[round6(F.col(c)).alias(c) for c in ("inertia", "min_share", "silhouette")], "selected")


def _group_centers(survey):
    """Mean of the short features per income class: one center per class."""
    rows = survey.groupBy("income").agg(*[F.avg(f).alias(f) for f in _SHORT]).orderBy("income").collect()
    return np.array([[r[f] for f in _SHORT] for r in rows])


_CENTERS_SQL = "centers as (select income as seg, " + ", ".join(f"avg({f}) as c_{f}" for f in _SHORT) + " from survey group by income)"
_DISTANCE = " + ".join(f"({f} - c_{f}) * ({f} - c_{f})" for f in _SHORT)
_ASSIGN_SQL = (f"{_CENTERS_SQL}, assigned as (select respondent, {', '.join(f'any_value({f}) as {f}' for f in _SHORT)}, "
               f"any_value(monthly_spend) as monthly_spend, cast(min_by(seg, {_DISTANCE}) as int) as cluster from survey, centers group by respondent)")


@query("kmeans_assign", with_views(f"with {_ASSIGN_SQL} select respondent, cluster as segment from assigned", "survey"))
def kmeans_assign(spark, d):
    survey = view(spark, d, "survey")
    return segments.assign_segments(survey, _SHORT, _group_centers(survey), "respondent")


@query("silhouette", with_views(f"""
with {_ASSIGN_SQL},
anchors as (select * from assigned order by (respondent * 7919) % 10007, respondent limit 500),
pairs as (select a.respondent as id, a.cluster as own, b.cluster, sqrt({' + '.join(f'(a.{f} - b.{f}) * (a.{f} - b.{f})' for f in _SHORT)}) as dist
  from anchors a, assigned b),
g as (select id, own, cluster, sum(dist) as s, count(*) as n from pairs group by all),
ab as (select id, max(case when cluster = own then s / (n - 1) end) as a, min(case when cluster <> own then s / n end) as b,
  max(case when cluster = own then n end) as n_own from g group by id)
select {r6('avg((b - a) / greatest(a, b))')} as silhouette, count(*) as anchors from ab where n_own > 1""", "survey"))
def silhouette(spark, d):
    survey = view(spark, d, "survey")
    anchors = survey.orderBy((F.col("respondent") * 7919) % 10007, "respondent").limit(500)
    points = segments.counted_points(survey, _SHORT)
    t = segments.silhouette(points, _SHORT, _group_centers(survey), anchors)
    return t.select(round6(F.col("silhouette")).alias("silhouette"), "anchors")


@query("segment_join", with_views(f"with {_ASSIGN_SQL} select respondent, monthly_spend, cluster as segment from assigned", "survey"))
def segment_join(spark, d):
    survey = view(spark, d, "survey")
    assigned = segments.assign_segments(survey, _SHORT, _group_centers(survey), "respondent")
    return segments.join_segments(survey, assigned, "respondent").select("respondent", "monthly_spend", "segment")


_MEANS_SQL = "m as (" + union_all(
    f"select segment, '{f}' as feature, count(*) as size, avg({f}) as mean, (select avg({f}) from survey) as overall_mean, "
    f"(avg({f}) - (select avg({f}) from survey)) / (select stddev_pop({f}) from survey) as z from survey group by segment" for f in _FEATURES) + ")"
_STRINGS_SQL = f"""{_MEANS_SQL},
h as (select *, row_number() over (partition by segment order by z desc, feature) as hr,
             row_number() over (partition by segment order by z, feature) as lr from m),
s as (select segment,
  coalesce(string_agg(printf('%s=%.2f', feature, z), '; ' order by hr) filter (where z > 0.25 and hr <= 5), '{fv.NO_HIGH_FEATURES}') as high_features_z,
  coalesce(string_agg(printf('%s=%.2f', feature, z), '; ' order by lr) filter (where z < -0.25 and lr <= 3), '{fv.NO_LOW_FEATURES}') as low_features_z,
  coalesce(string_agg(feature, ' ' order by hr) filter (where z > 0.25 and hr <= 4), '') as high_text,
  coalesce(string_agg(feature, ' ' order by lr) filter (where z < -0.25 and lr <= 3), '') as low_text from h group by segment)"""


def _label_sql() -> str:
    labels, support = fv.PERSONA_LABELS, fv.PERSONA_SUPPORT_TOKENS

    def has(t, *tokens):
        return contains_any(t, tokens)
    return (f"case when {has('high_text', 'purchase')} and {has('high_text', *support)} then '{labels['advocate']}' "
            f"when {has('low_text', 'purchase')} and {has('low_text', *support)} then '{labels['sceptic']}' "
            f"when {has('high_text', 'risk')} then '{labels['risk']}' "
            f"when {has('high_text', 'purchase', 'satisfaction')} then '{labels['potential']}' "
            f"when {has('high_text', 'brand', 'trust')} then '{labels['brand']}' "
            f"when {has('high_text', 'feature', 'quality')} then '{labels['product']}' "
            f"when {has('high_text', 'price', 'value')} then '{labels['value']}' else '{labels['balanced']}' end")


# Groups that differ: spending classes of the respondents.
_CLASSED = "select * replace (cast(least(4, floor((monthly_spend + 1000) / 2200)) as int) + 1 as segment) from survey"


def _classed(spark, d):
    spend_class = F.least(F.lit(4), F.floor((F.col("monthly_spend") + 1000) / 2200)).cast("int") + 1
    return view(spark, d, "survey").withColumn("segment", spend_class)


def _on_classes(sql: str) -> str:
    return with_views(f"with classed as ({_CLASSED}), " + sql.replace("from survey", "from classed")[5:], "survey")


@query("segment_profile", _on_classes(f"""with {_MEANS_SQL}
select segment, feature, size, {r6('mean')} as mean, {r6('overall_mean')} as overall_mean, {r6('z')} as z from m"""))
def segment_profile(spark, d):
    t = segments.segment_means(_classed(spark, d), "segment", _FEATURES)
    return t.select("segment", "feature", "size", *[round6(F.col(c)).alias(c) for c in ("mean", "overall_mean", "z")])


@query("persona_label", _on_classes(f"""with {_STRINGS_SQL}
select segment, high_features_z, low_features_z, {_label_sql()} as persona from s"""))
def persona_label(spark, d):
    t = segments.feature_strings(segments.segment_means(_classed(spark, d), "segment", _FEATURES), "segment")
    return t.select("segment", "high_features_z", "low_features_z",
                    segments.persona_label(F.col("high_text"), F.col("low_text")).alias("persona"))


@query("persona_strategy", _on_classes(f"""with {_STRINGS_SQL},
p as (select segment, concat_ws(' ', {_label_sql()}, high_features_z, low_features_z) as txt from s)
select segment, case {' '.join(f"when {contains_any('txt', t)} then '{s}'" for t, s in fv.STRATEGY_RULES)} else '{fv.STRATEGY_DEFAULT}' end as strategy from p"""))
def persona_strategy(spark, d):
    t = segments.feature_strings(segments.segment_means(_classed(spark, d), "segment", _FEATURES), "segment")
    label = segments.persona_label(F.col("high_text"), F.col("low_text"))
    return t.select("segment", segments.persona_strategy(F.concat_ws(" ", label, "high_features_z", "low_features_z")).alias("strategy"))


_GROUPS = {"basic": ["market_segment", "income"], "behavior": ["monthly_spend"], "cognitive": ["product_quality", "product_quality_3"]}
_NUMERIC = {"monthly_spend": "behavior", "product_quality": "cognitive"}
_COUNTED = {"market_segment": "basic", "income": "basic", "product_quality_3": "cognitive"}


def _details_sql(rounded) -> str:
    return union_all(
        [f"select segment, '{g}' as \"group\", '{v}' as variable, 'numeric_mean' as summary_type, {rounded(f'avg({v})')} as segment_value, "
         f"{rounded(f'(select avg({v}) from survey)')} as overall_value, "
         f"{rounded(f'(avg({v}) - (select avg({v}) from survey)) / (select stddev_pop({v}) from survey)')} as delta_or_index, '' as top_category, "
         f"cast(null as double) as segment_share, cast(null as double) as overall_share from survey group by segment" for v, g in _NUMERIC.items()]
        + [f"select * from (with c as (select segment, cast({v} as varchar) as level, count(*) as n from survey where {v} is not null group by all), "
           f"s as (select *, n / cast(sum(n) over (partition by segment) as double) as share, sum(n) over (partition by level) / cast(sum(n) over () as double) as base, "
           f"row_number() over (partition by segment order by n desc, level) as rn from c) "
           f"select segment, '{g}' as \"group\", '{v}' as variable, 'category_share' as summary_type, cast(null as double) as segment_value, "
           f"cast(null as double) as overall_value, {rounded('share / base')} as delta_or_index, level as top_category, {rounded('share')} as segment_share, "
           f"{rounded('base')} as overall_share from s where rn <= 2)" for v, g in _COUNTED.items()])


@query("persona_details", with_views(_details_sql(r6), "survey"))
def persona_details(spark, d):
    survey = view(spark, d, "survey")
    t = segments.persona_details(survey, "segment", _GROUPS, profile(survey), ["product_quality"])
    floats = ("segment_value", "overall_value", "delta_or_index", "segment_share", "overall_share")
    return t.select(*[round6(F.col(c)).alias(c) if c in floats else c for c in t.columns])


# Four strongest means, then four strongest levels (one per variable; only those above the overall share, if any is), six parts at most.
_INFO_SQL = f"""det as ({_details_sql(str)}),
means as (select segment, "group", row_number() over (partition by segment, "group" order by abs(delta_or_index) desc nulls last, variable) as place,
                 printf('%s均值%.2f(整体%.2f)', variable, segment_value, overall_value) as part from det where summary_type = 'numeric_mean'),
lv as (select *, max(case when delta_or_index >= 1 then 1 else 0 end) over (partition by segment, "group") as any_over, abs(delta_or_index - 1) as strength
       from det where summary_type = 'category_share'),
one as (select *, row_number() over (partition by segment, "group", variable order by strength desc nulls last, top_category) as rn
        from lv where any_over = 0 or delta_or_index >= 1),
levels as (select segment, "group", 4 + row_number() over (partition by segment, "group" order by strength desc nulls last, variable) as place,
                  printf('%s偏向“%s”(%.1f%%, 整体%.1f%%)', variable, top_category, segment_share * 100, overall_share * 100) as part from one where rn = 1),
parts as (select * from means where place <= 4 union all select * from levels where place <= 8),
numbered as (select *, row_number() over (partition by segment, "group" order by place, part) as k from parts),
info as (select segment, "group", string_agg(part, '；' order by k) as info from numbered where k <= 6 group by all)"""


@query("persona_info", with_views(f"with {_INFO_SQL} select * from info", "survey"))
def persona_info(spark, d):
    survey = view(spark, d, "survey")
    details = segments.persona_details(survey, "segment", _GROUPS, profile(survey), ["product_quality"])
    return segments.persona_info(details, "segment")


_COLUMNS = ["respondent", "market_segment", "segment", "income", "monthly_spend", "product_quality", "product_quality_2", "product_quality_3", "perceived_value",
            "perceived_value_2", "brand_trust", "brand_trust_2", "purchase_intention", "purchase_intention_2"]


def _hinted_sql(name: str, hints) -> str:
    tests = [f"contains({name}, '{h}')" for h in hints if len(h) >= 5]
    tests += [f"regexp_matches({name}, '(^|[^a-z0-9]){h}([^a-z0-9]|$)')" for h in hints if len(h) < 5]
    return "(" + " or ".join(tests) + ")"


_GROUPS_SQL = "with c as (" + union_all(
    f"select {i} as pos, '{c}' as variable, count({c}) >= 0.2 * count(*) and count(distinct {c}) > 1 as fit, count(distinct {c}) > greatest(20, 0.75 * count(*)) "
    f"or {'true' if any(t in c for t in fv.ID_TOKENS) else 'false'} as id_like from survey" for i, c in enumerate(_COLUMNS)) + "), g as (" + union_all(
    f"select '{g}' as \"group\", pos, variable from c where fit and not id_like and ({_hinted_sql('variable', h)}"
    + (" or variable = 'purchase_intention')" if g == "cognitive" else ")")
    for g, h in (("basic", fv.BASIC_HINTS), ("behavior", fv.BEHAVIOR_HINTS), ("cognitive", fv.COGNITIVE_HINTS))) + """)
select "group", cast(row_number() over (partition by "group" order by pos) as int) as position, variable from g"""


@query("profile_groups", with_views(_GROUPS_SQL, "survey"))
def profile_groups(spark, d):
    groups = segments.profile_groups(profile(view(spark, d, "survey")), outcome="purchase_intention")
    return spark.createDataFrame([(g, i, v) for g, cols in groups.items() for i, v in enumerate(cols, start=1)],
                                 "group string, position int, variable string")


@query("persona_summary", with_views(f"""with {_INFO_SQL}, {_STRINGS_SQL},
sizes as (select segment, count(*) as size, count(*) / (select cast(count(*) as double) from survey) as share from survey group by segment),
wide as (select segment, max(info) filter ("group" = 'basic') as basic, max(info) filter ("group" = 'behavior') as behavior,
                max(info) filter ("group" = 'cognitive') as cognitive from info group by segment),
p as (select segment, size, share, {_label_sql()} as persona, coalesce(basic, '{fv.NO_PROFILE_INFO}') as basic, coalesce(behavior, '{fv.NO_PROFILE_INFO}') as behavior,
             coalesce(cognitive, '{fv.NO_PROFILE_INFO}') as cognitive, high_features_z, low_features_z from sizes join s using (segment) left join wide using (segment)),
t as (select *, concat_ws(' ', persona, behavior, cognitive, high_features_z, low_features_z) as txt from p)
select printf('第%d类', segment) as "类型编号", persona as "消费者类型", size as "样本量", printf('%.2f%%', share * 100) as "占比", basic as "基础信息", behavior as "行为信息",
       cognitive as "认知信息", high_features_z as "核心区分特征",
       case {' '.join(f"when {contains_any('txt', w)} then '{v}'" for w, v in fv.STRATEGY_RULES)} else '{fv.STRATEGY_DEFAULT}' end as "策略定位" from t""", "survey"))
def persona_summary(spark, d):
    survey = view(spark, d, "survey")
    details = segments.persona_details(survey, "segment", _GROUPS, profile(survey), ["product_quality"])
    return segments.persona_summary(segments.segment_profiles(survey, "segment", _FEATURES, details))
