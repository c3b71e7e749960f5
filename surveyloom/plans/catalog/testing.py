"""Randomness and independence tests."""

import itertools

from pyspark.sql import functions as F

from ...functions.pvalues import chi_square_p, normal_p
from ...functions.scalars import round6
from ...operators import moments, stat_tests
from ...operators.profile import profile
from ..fixtures import table, view, with_views
from . import query
from .sql import chi_p, normal_p as normal_p_sql, r6, union_all


def _rounded(t, *names):
    return t.select(*[round6(F.col(c)).alias(c) if c in names else c for c in t.columns])


@query("runs_test", f"""
with m as (select median(value) as med from events),
top as (select event_type as lv from events group by event_type order by count(*) desc, event_type limit 1),
s as (select 'value' as variable, ts, event_id, case when value > med then 1 else 0 end as sgn from events, m where value <> med
      union all select 'event_type', ts, event_id, case when event_type = lv then 1 else 0 end from events, top),
g as (select variable, sgn, lag(sgn) over (partition by variable order by ts, event_id) as prev from s),
c as (select variable, sum(sgn)::double as n1, sum(1 - sgn)::double as n2,
             1 + sum(case when prev is not null and prev <> sgn then 1 else 0 end) as runs from g group by variable),
e as (select *, 1 + 2 * n1 * n2 / (n1 + n2) as ex,
             2 * n1 * n2 * (2 * n1 * n2 - n1 - n2) / ((n1 + n2) * (n1 + n2) * (n1 + n2 - 1)) as va from c),
z as (select *, (runs - ex) / sqrt(va) as z from e)
select variable, cast(n1 + n2 as bigint) as n, cast(n2 as bigint) as n_low_or_other, cast(n1 as bigint) as n_high_or_top,
       cast(runs as bigint) as runs, {r6('ex')} as expected_runs, {r6('z')} as statistic, {r6(normal_p_sql('z'))} as approx_p from z""")
def runs_test(spark, d):
    t = stat_tests.runs_test(table(spark, d, "events"), ["value", "event_type"], ["ts", "event_id"])
    t = t.select("variable", "n", "n_low_or_other", "n_high_or_top", "runs", "expected_runs", "statistic", "approx_p")
    return _rounded(t, "expected_runs", "statistic", "approx_p")


def _balance_sql(columns):
    long = union_all(f"select '{c}' as variable, cast({c} as varchar) as level, count(*) as n from lineitem group by {c}" for c in columns)
    return f"""with f as ({long}), k as (select variable, count(*) as k, sum(n)::double as total from f group by variable),
s as (select variable, k, total, sum((n - total / k) * (n - total / k) / (total / k)) as stat from f join k using (variable) group by all)
select variable, cast(total as bigint) as n, {r6('stat')} as statistic, cast(k - 1 as bigint) as df,
       {r6(chi_p('stat', '(k - 1)'))} as approx_p from s"""


@query("level_balance", _balance_sql(["l_returnflag", "l_linestatus", "l_linenumber", "l_discount"]))
def level_balance(spark, d):
    t = stat_tests.level_balance(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount"])
    return _rounded(t.select("variable", "n", "statistic", "df", "approx_p"), "statistic", "approx_p")


def chi_sql(pairs: list[tuple[str, str, str]], source: str, method: str) -> str:
    """``pairs`` are (a, b, b as SQL text). Full table of expected counts, empty cells included."""
    long = union_all(f"select '{a}' as va, '{b}' as vb, coalesce(cast({a} as varchar), 'nan') as a, coalesce({bt}, 'nan') as b from {source}"
                     for a, b, bt in pairs)
    return f"""with long as ({long}),
o as (select va, vb, a, b, count(*) as n from long group by all),
ra as (select va, vb, a, sum(n) as ra from o group by all), rb as (select va, vb, b, sum(n) as rb from o group by all),
tt as (select va, vb, sum(n)::double as total from o group by all),
full_table as (select ra.va, ra.vb, coalesce(o.n, 0) as n, ra.ra * rb.rb / total as e, total
  from ra join rb on ra.va = rb.va and ra.vb = rb.vb join tt on tt.va = ra.va and tt.vb = ra.vb
  left join o on o.va = ra.va and o.vb = ra.vb and o.a = ra.a and o.b = rb.b),
s as (select va, vb, any_value(total) as total, sum((n - e) * (n - e) / e) as stat from full_table group by all),
k as (select va, vb, (select count(*) from ra where ra.va = s.va and ra.vb = s.vb) as r,
             (select count(*) from rb where rb.va = s.va and rb.vb = s.vb) as c, total, stat from s)
select va as variable_a, vb as variable_b, '{method}' as method, cast(total as bigint) as n, {r6('stat')} as statistic,
       cast((r - 1) * (c - 1) as bigint) as df, {r6(chi_p('stat', '((r - 1) * (c - 1))'))} as approx_p,
       {r6('sqrt(stat / (total * greatest(1, least(r - 1, c - 1))))')} as effect_size,
       case when {chi_p('stat', '((r - 1) * (c - 1))')} < 0.05 then 'association_detected' else 'independence_not_rejected' end as interpretation
from k where r > 1 and c > 1"""


def _chi_columns(t):
    t = t.select("variable_a", "variable_b", "method", "n", "statistic", "df", "approx_p", "effect_size", "interpretation")
    return _rounded(t, "statistic", "approx_p", "effect_size")


_CATEGORICAL = ["l_linenumber", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("chi_square_pairs", chi_sql([(a, b, f"cast({b} as varchar)") for a, b in itertools.combinations(_CATEGORICAL, 2)],
                                   "lineitem", "chi_square_independence"))
def chi_square_pairs(spark, d):
    lineitem = table(spark, d, "lineitem").drop("l_orderkey", "l_partkey", "l_suppkey")
    stats = profile(lineitem)
    return _chi_columns(stat_tests.chi_square_tests(lineitem, stat_tests.categorical_pairs(stats), stats=stats))


_SEGMENT_VARS = ["market_segment", "income", "product_quality", "product_quality_2", "product_quality_3", "perceived_value",
                 "perceived_value_2", "brand_trust", "brand_trust_2", "purchase_intention", "purchase_intention_2"]


# Spending in hundreds has more than 12 values, so the test cuts it into quartiles.
_HUNDREDS = "cast(floor(monthly_spend / 100) as bigint)"


def _with_quartiles(sql: str) -> str:
    quart = f"""quartiles as (select quantile_cont({_HUNDREDS}, [0.0, 0.25, 0.5, 0.75, 1.0]) as e from survey),
binned as (select survey.*, cast(greatest(1, len(list_filter(e, lambda x: x < {_HUNDREDS}))) as varchar) as spend_hundreds from survey, quartiles)"""
    return with_views(f"with {quart}, {sql[5:]}", "survey")


@query("segment_chi_square", _with_quartiles(chi_sql([("segment", b, f"cast({b} as varchar)") for b in [*_SEGMENT_VARS, "spend_hundreds"]],
                                                     "binned", "segment_chi_square_independence")))
def segment_chi_square(spark, d):
    survey = view(spark, d, "survey").drop("respondent").withColumn("spend_hundreds", F.expr(_HUNDREDS))
    return _chi_columns(stat_tests.segment_tests(survey, "segment", profile(survey)))


_SCREEN = ["segment", "income", "product_quality", "product_quality_2", "product_quality_3", "perceived_value", "perceived_value_2",
           "brand_trust", "brand_trust_2", "purchase_intention", "purchase_intention_2"]


@query("pearson_screen", with_views("with p as (" + union_all(
    f"select '{a}' as variable_a, '{b}' as variable_b, count({a} + {b}) as n, corr({a}, {b}) as r from survey "
    f"having count(distinct {a}) > 2 and count(distinct {b}) > 2" for a, b in itertools.combinations(_SCREEN, 2)) + f"""),
z as (select *, atanh(r) * sqrt(greatest(1, n - 3)) as z from p)
select variable_a, variable_b, n, {r6('z')} as statistic, {r6(normal_p_sql('z'))} as approx_p, {r6('r')} as effect_size
from z where n >= 12 and abs(r) < 1""", "survey"))
def pearson_screen(spark, d):
    survey = view(spark, d, "survey").select(*_SCREEN)
    t = stat_tests.pearson_screen(survey, stat_tests.pearson_pairs(profile(survey)))
    t = t.select("variable_a", "variable_b", "n", "statistic", "approx_p", "effect_size")
    return _rounded(t, "statistic", "approx_p", "effect_size")


_SUPPLIER_SQL = """
with c as (select l_suppkey, l_returnflag, count(*) as n from lineitem group by all),
s as (select l_suppkey, count(*) as k, sum(n)::double as total, sum(n * n)::double as sq from c group by all),
t as (select l_suppkey, k - 1 as df, k * sq / total - total as stat from s),"""


@query("p_values", _SUPPLIER_SQL + f"""
u as (select l_suppkey, df, stat, (stat - df) / sqrt(2.0 * df) as z from t where df > 0)
select l_suppkey, {r6('stat')} as statistic, {r6(chi_p('stat', 'df'))} as chi_square_p, {r6(normal_p_sql('z'))} as normal_p from u""")
def p_values(spark, d):
    """Balance of the return flags of every supplier, and the normal approximation of the same."""
    counts = table(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    t = counts.groupBy("l_suppkey").agg(
        (F.count(F.lit(1)) - 1).alias("df"), F.sum("n").alias("total"), F.sum(F.col("n") * F.col("n")).alias("sq")).where("df > 0")
    t = t.withColumn("statistic", (F.col("df") + 1) * F.col("sq") / F.col("total") - F.col("total"))
    z = (F.col("statistic") - F.col("df")) / F.sqrt(2.0 * F.col("df"))
    return t.select("l_suppkey", round6(F.col("statistic")).alias("statistic"),
                    round6(chi_square_p(F.col("statistic"), F.col("df"))).alias("chi_square_p"), round6(normal_p(z)).alias("normal_p"))


_CORR = ["monthly_spend", *_SCREEN[1:]]


@query("correlations", with_views(union_all(
    f"select '{a}' as a, '{b}' as b, count({a} + {b}) as n, {r6(f'corr({a}, {b})')} as r from survey"
    for a, b in itertools.combinations(_CORR, 2)), "survey"))
def correlations(spark, d):
    t = moments.correlations(view(spark, d, "survey"), _CORR)
    return t.select("a", "b", "n", round6(F.col("r")).alias("r"))
