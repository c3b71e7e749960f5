"""Descriptive tables."""

from pyspark.sql import functions as F

from ...functions.scalars import round6
from ...operators import describe
from ..fixtures import table, view, with_views
from . import query
from .sql import r6, union_all

_NUMERIC = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("descriptives", union_all(
    f"select '{c}' as variable, count({c}) as count, count(*) - count({c}) as missing, round(avg({c}), 7) + 0.0 as mean, "
    f"{r6(f'stddev_samp({c})')} as std, {r6(f'min({c})')} as min, {r6(f'quantile_cont({c}, 0.25)')} as p25, "
    f"{r6(f'median({c})')} as median, {r6(f'quantile_cont({c}, 0.75)')} as p75, {r6(f'max({c})')} as max, "
    f"count(distinct {c}) as \"unique\" from lineitem" for c in _NUMERIC))
def descriptives(spark, d):
    t = describe.descriptives(table(spark, d, "lineitem"), _NUMERIC)
    floats = ["std", "min", "p25", "median", "p75", "max"]
    # Means of two-digit decimals fall on half units of the sixth digit.
    return t.select("variable", "count", "missing", F.round("mean", 7).alias("mean"), *[round6(F.col(c)).alias(c) for c in floats], "unique")


def _levels_sql(source: str, columns: list[str], top: int = 20) -> str:
    long = union_all(f"select '{c}' as variable, cast({c} as varchar) as level from {source} where {c} is not null" for c in columns)
    return f"""with long as ({long}),
c as (select variable, level, count(*) as n from long group by all),
r as (select *, row_number() over (partition by variable order by n desc, level) as level_order from c),
k as (select * from r where level_order <= {top})
select variable, cast(level_order as int) as level_order, level, n as count,
       round(n / cast(sum(n) over (partition by variable) as double), 6) + 0.0 as percent from k"""


@query("categorical_dist", _levels_sql("lineitem", ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax"]))
def categorical_dist(spark, d):
    # The keys of the small test scales have few values too.
    t = describe.categorical_distributions(table(spark, d, "lineitem").drop("l_orderkey", "l_partkey", "l_suppkey"))
    return t.withColumn("percent", round6(F.col("percent")))


def bins_sql(source: str, columns: list[str], q: int) -> str:
    probs = "[" + ", ".join(f"{i}.0 / {q}" for i in range(q + 1)) + "]"
    return union_all(f"""select * from (with e as (select list_sort(list_distinct(quantile_cont(cast({c} as double), {probs}))) as edges from {source}),
b as (select {c} as v, edges, greatest(1, len(list_filter(edges, lambda x: x < {c}))) as bin from {source}, e where {c} is not null)
select '{c}' as variable, cast(bin as int) as bin, round(any_value(edges[bin]), 6) as bin_lo, round(any_value(edges[bin + 1]), 6) as bin_hi,
       count(*) as count, round(count(*) / cast(sum(count(*)) over () as double), 6) as percent from b group by bin)"""
                     for c in columns)


@query("quantile_bins", bins_sql("lineitem", ["l_quantity", "l_extendedprice"], 6))
def quantile_bins(spark, d):
    t = describe.quantile_bins(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"], 6)
    return t.select("variable", "bin", round6(F.col("bin_lo")).alias("bin_lo"), round6(F.col("bin_hi")).alias("bin_hi"),
                    "count", round6(F.col("percent")).alias("percent"))


_RANKS = {"health_rank_alpha": ("health_rank", "健康认知排序", "alpha"), "health_rank_beta": ("health_rank", "健康认知排序", "beta"),
          "health_rank_gamma": ("health_rank", "健康认知排序", "gamma"), "function_rank_alpha": ("function_rank", "功能认知排序", "alpha"),
          "function_rank_beta": ("function_rank", "功能认知排序", "beta")}
_RANK_SQL = union_all(
    f"select '{p}' as dimension, '{title}' as dimension_label, '{c}' as variable, '{b}' as brand, {r6(f'avg({c})')} as mean_rank, "
    f"{r6(f'median({c})')} as median_rank, count({c}) as n from ranks" for c, (p, title, b) in _RANKS.items())


@query("ranking_summary", with_views(_RANK_SQL, "ranks"))
def ranking_summary(spark, d):
    t = describe.ranking_summary(view(spark, d, "ranks"))
    return t.withColumn("mean_rank", round6(F.col("mean_rank"))).withColumn("median_rank", round6(F.col("median_rank")))


@query("ranking_top3", with_views(
    f"select dimension, brand, mean_rank, cast(row_number() over (partition by dimension order by mean_rank, brand) as int) as place "
    f"from ({_RANK_SQL}) qualify place <= 3", "ranks"))
def ranking_top3(spark, d):
    t = describe.ranking_top(describe.ranking_summary(view(spark, d, "ranks")))
    return t.select("dimension", "brand", round6(F.col("mean_rank")).alias("mean_rank"), "place")
