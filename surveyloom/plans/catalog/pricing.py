"""Price sensitivity."""

from pyspark.sql import functions as F

from ...functions import fixed_values as fv
from ...functions.scalars import round6
from ...operators import pricing
from ..fixtures import view, with_views
from ..holding import hold
from . import query
from .sql import r6, union_all

_PRICES = {k: k for k in fv.PRICE_KEYS}
_CHECKED = """checked as (select respondent, {seg} as seg, too_cheap, cheap, expensive, too_expensive,
  too_cheap < cheap and cheap < expensive and expensive < too_expensive as ok from psm
  where too_cheap is not null and cheap is not null and expensive is not null and too_expensive is not null),
good as (select * from checked where ok),
prices as (select seg, too_cheap as p from good union all select seg, cheap from good union all select seg, expensive from good
           union all select seg, too_expensive from good),
ends as (select seg, cast(min(p) as double) as lo, cast(max(p) as double) as hi from prices group by seg),
grid as (select distinct seg, price from (
  select seg, cast(p as double) as price from prices
  union all select seg, case when i = 4999 then hi else lo + i * ((hi - lo) / 4999) end from ends, range(5000) r(i))),
named as (select seg, 'tc' as kind, too_cheap as p, count(*) as n from good group by all union all
  select seg, 'c', cheap, count(*) from good group by all union all select seg, 'e', expensive, count(*) from good group by all union all
  select seg, 'te', too_expensive, count(*) from good group by all),
sizes as (select seg, count(*)::double as n from good group by seg),
curves as (select g.seg, g.price,
  sum(case when kind = 'tc' and p >= price then d.n else 0 end) / any_value(s.n) as tc,
  sum(case when kind = 'c' and p >= price then d.n else 0 end) / any_value(s.n) as c,
  sum(case when kind = 'e' and p <= price then d.n else 0 end) / any_value(s.n) as e,
  sum(case when kind = 'te' and p <= price then d.n else 0 end) / any_value(s.n) as te
  from grid g join named d on d.seg = g.seg join sizes s on s.seg = g.seg group by g.seg, g.price)"""

_DIFFS = {"OPP": "tc - te", "IPP": "c - e", "PMC": "tc - e", "PME": "te - (1 - e)"}

# First block of equality, else first sign change, else the smallest gap: an ordered scan of the grid.
_CROSS = "diffs as (" + union_all(f"select seg, '{k}' as point, price, {d} as d from curves" for k, d in _DIFFS.items()) + """),
scan as (select *, abs(d) <= 1e-12 as zero, lag(price) over w as p0, lag(d) over w as d0, lag(abs(d) <= 1e-12) over w as zero0
  from diffs window w as (partition by seg, point order by price)),
blocks as (select *, sum(case when zero and not coalesce(zero0, false) then 1 else 0 end) over (partition by seg, point order by price) as block from scan),
equal as (select seg, point, (min(price) + max(price)) / 2 as x from blocks where zero and block = 1 group by all),
change as (select seg, point, min_by(p0 - d0 * (price - p0) / (d - d0), price) as x from scan where d * d0 < 0 group by all),
nearest as (select seg, point, min_by(price, abs(d)) as x, min(abs(d)) as gap from scan group by all),
points as (select n.seg, n.point, coalesce(q.x, h.x, n.x) as x, case when q.x is null and h.x is null then n.gap else 0.0 end as gap
  from nearest n left join equal q on q.seg = n.seg and q.point = n.point left join change h on h.seg = n.seg and h.point = n.point),
sample as (select seg, count(*)::double as valid, sum(case when ok then 1 else 0 end)::double as mono from checked group by seg),
medians as (select seg, median(too_cheap) m_tc, median(cheap) m_c, median(expensive) m_e, median(too_expensive) m_te from good group by seg),
summary as (select seg, 'valid_raw_rows' as metric, valid as value from sample
  union all select seg, 'monotonic_valid_rows', mono from sample union all select seg, 'monotonic_valid_rate', mono / valid from sample
  union all select seg, case point when 'OPP' then 'OPP_optimal_price_point' when 'IPP' then 'IPP_indifference_price_point'
    when 'PMC' then 'PMC_lower_acceptable_price' else 'PME_upper_acceptable_price' end, x from points
  union all select seg, point || '_curve_gap', gap from points
  union all select seg, 'median_too_cheap_price', m_tc from medians union all select seg, 'median_cheap_price', m_c from medians
  union all select seg, 'median_expensive_price', m_e from medians union all select seg, 'median_too_expensive_price', m_te from medians)"""


def _psm(segment: str, tail: str) -> str:
    return with_views("with " + _CHECKED.replace("{seg}", segment) + ", " + _CROSS + " " + tail, "psm")


def _checked(spark, d, keep):
    return pricing.monotonicity(view(spark, d, "psm"), _PRICES, keep)


def _overall(spark, d):
    return hold(_checked(spark, d, []).withColumn("_all", F.lit(1)))


# Question names of which the guards leave one per kind.
_QUESTIONS = {"too_expensive": "q4_too_expensive", "too_cheap": "q1_too_cheap", "expensive": "q3_expensive", "cheap": "q2_cheap"}


@query("price_columns", with_views(union_all(
    f"select '{k}' as kind, '{q}' as name, count({k}) as answers, {r6(f'avg({k})')} as mean from psm" for k, q in _QUESTIONS.items()), "psm"))
def price_columns(spark, d):
    """The price questions found by name, and what they were answered."""
    asked = view(spark, d, "psm").select("respondent", *[F.col(k).alias(q) for k, q in _QUESTIONS.items()])
    found = pricing.detect_price_columns(asked.columns)
    return asked.agg(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).alias("name"), F.count(c).alias("answers"), round6(F.avg(c)).alias("mean"))
                               for k, c in found.items()]).alias("a")).select(F.inline("a"))


@query("psm_monotonicity", with_views("""
select respondent, cast(too_cheap as double) as too_cheap, cast(cheap as double) as cheap, cast(expensive as double) as expensive,
       cast(too_expensive as double) as too_expensive,
       too_cheap < cheap and cheap < expensive and expensive < too_expensive as monotonic_valid
from psm where too_cheap is not null and cheap is not null and expensive is not null and too_expensive is not null""", "psm"))
def psm_monotonicity(spark, d):
    return _checked(spark, d, ["respondent"])


@query("psm_curves", _psm("1", f"select {r6('price')} as price, {r6('tc')} as too_cheap_curve, {r6('c')} as cheap_curve, "
                               f"{r6('e')} as expensive_curve, {r6('te')} as too_expensive_curve from curves"))
def psm_curves(spark, d):
    t = pricing.curves(pricing.cumulative_prices(_overall(spark, d), "_all"), "_all")
    return t.select(round6(F.col("price")).alias("price"), *[round6(F.col(c)).alias(c) for c in pricing.CURVES])


@query("psm_intersections", _psm("segment", f"select seg as segment, point, {r6('x')} as price, {r6('gap')} as gap from points"))
def psm_intersections(spark, d):
    checked = hold(_checked(spark, d, ["segment"]))
    t = pricing.intersections(pricing.cumulative_prices(checked, "segment"), "segment")
    rows = F.array(*[F.struct(F.lit(p).alias("point"), F.col(p).alias("price"), F.col(f"{p}_gap").alias("gap")) for p in _DIFFS])
    return t.select("segment", F.inline(rows)).select("segment", "point", round6(F.col("price")).alias("price"), round6(F.col("gap")).alias("gap"))


@query("psm_summary", _psm("1", f"select metric, {r6('value')} as value from summary"))
def psm_summary(spark, d):
    return pricing.price_summary(_overall(spark, d), "_all").select("metric", round6(F.col("value")).alias("value"))


@query("psm_by_segment", _psm("segment", f"select seg as segment, metric, {r6('value')} as value from summary"))
def psm_by_segment(spark, d):
    checked = hold(_checked(spark, d, ["segment"]))
    return pricing.price_summary(checked, "segment").select("segment", "metric", round6(F.col("value")).alias("value"))


_PIVOT = ["valid_raw_rows", "monotonic_valid_rate", "OPP_optimal_price_point", "IPP_indifference_price_point",
          "PMC_lower_acceptable_price", "PME_upper_acceptable_price"]


@query("psm_pivot", _psm("segment", "select seg as segment, " + ", ".join(
    r6(f"max(case when metric = '{m}' then value end)") + f" as {m}" for m in _PIVOT) + " from summary group by seg"))
def psm_pivot(spark, d):
    checked = hold(_checked(spark, d, ["segment"]))
    t = pricing.price_pivot(pricing.price_summary(checked, "segment"), ["segment"])
    return t.select("segment", *[round6(F.col(m)).alias(m) for m in _PIVOT])
