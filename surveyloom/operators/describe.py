"""Descriptive tables."""

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed_values as fv
from ..plans.holding import hold
from .ordered import MAX_ROWS_PER_TASK, quantile_columns, running_totals, weighted_quantiles
from .profile import (ColumnProfile, is_categorical, is_id_like, level_frequencies, numeric_columns,
                      numeric_frequencies, profiles_of, profiled_columns)

MAX_LEVELS = 20
DESCRIPTIVES_SCHEMA = ("variable string, count bigint, missing bigint, mean double, std double, min double, p25 double, median double, "
                       "p75 double, max double, unique bigint")


def descriptives(df: DataFrame, columns: list[str] | None = None, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Count, missing, moments, exact quartiles and exact distinct count per numeric column."""
    columns = columns or numeric_columns(df)
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], DESCRIPTIVES_SCHEMA)
    # All of it follows from the counted values; squares are taken around the mean.
    freq = hold(numeric_frequencies(df, columns))
    centers = freq.groupBy("variable").agg(F.sum("n").alias("count"), (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"))
    cum = running_totals(freq, ["variable"], "value", ["n"], max_rows).join(F.broadcast(centers), "variable")  # one row per column
    aggs, finals = quantile_columns("value", "cum_n", "tot_n", {"p25": 0.25, "median": 0.5, "p75": 0.75})
    off = F.col("value") - F.col("mean")
    spread = cum.groupBy("variable", "count", "mean").agg(
        F.sqrt(F.try_divide(F.sum(off * off * F.col("n")), F.col("count") - 1)).alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"), F.count(F.lit(1)).alias("unique"), *aggs,
    ).select("variable", "count", "mean", "std", "min", *finals, "max", "unique")
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    every = spark.createDataFrame([(c,) for c in columns], "variable string").crossJoin(F.broadcast(rows))  # columns x 1
    count = F.coalesce("count", F.lit(0)).cast("bigint")
    return every.where("rows > 0").join(spread, "variable", "left").select(
        "variable", count.alias("count"), (F.col("rows") - count).alias("missing"), "mean", "std", "min", "p25", "median", "p75", "max",
        F.coalesce("unique", F.lit(0)).alias("unique"))


def top_levels_per_key(freq: DataFrame, keys: list[str], max_levels: int = MAX_LEVELS) -> DataFrame:
    """Largest levels per key with their share of the kept counts.

    The rank filter is pushed below the shuffle, so a key sends at most ``max_levels`` rows per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc("level"))
    kept = freq.withColumn("level_order", F.row_number().over(ranked)).where(F.col("level_order") <= max_levels)
    share = F.col("n") / F.sum("n").over(Window.partitionBy(*keys))
    return kept.select(*keys, "level_order", "level", F.col("n").alias("count"), share.alias("percent"))


def categorical_distributions(df: DataFrame, columns: list[str] | None = None,
                              max_levels: int = MAX_LEVELS, id_columns=(), stats: dict[str, ColumnProfile] | None = None) -> DataFrame:
    """Top levels of every categorical column that is not id-like and has at least five answers."""
    stats = profiles_of(df, columns or profiled_columns(df), stats)
    chosen = [p.name for p in stats.values() if not is_id_like(p, id_columns) and p.count >= 5
              and (is_categorical(p) or (p.numeric and p.distinct <= 12))]
    if not chosen:
        return df.sparkSession.createDataFrame(
            [], "variable string, level_order int, level string, count bigint, percent double")
    # The profile has counted the levels of columns with few; only the others are scanned again.
    known = [c for c in chosen if stats[c].levels and len(stats[c].levels) == stats[c].distinct]
    rest = [c for c in chosen if c not in known]
    parts = [df.sparkSession.createDataFrame(
        [(c, level, n) for c in known for level, n in stats[c].levels], "variable string, level string, n bigint")] if known else []
    parts += [level_frequencies(df, rest)] if rest else []
    return top_levels_per_key(functools.reduce(DataFrame.unionByName, parts), ["variable"], max_levels)


def quantile_bins(df: DataFrame, columns: list[str], q: int, keys: list[str] = (),
                  max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Right-closed quantile bins: ``(variable, bin, bin_lo, bin_hi, count, percent)``.

    Equal edges collapse. The bins are counted on the distinct values, not on the rows.
    """
    freq = hold(numeric_frequencies(df, columns))
    names = [f"e{i}" for i in range(q + 1)]
    edges = weighted_quantiles(freq, ["variable"], "value", "n",
                               {n: i / q for i, n in enumerate(names)}, max_rows)
    edges = edges.select("variable", F.array_distinct(F.array(*names)).alias("edges"))
    placed = freq.join(F.broadcast(edges), "variable").withColumn(  # one edge row per column
        "bin", F.greatest(F.size(F.filter("edges", lambda e: e < F.col("value"))), F.lit(1)))
    counts = placed.groupBy("variable", "bin").agg(F.first("edges").alias("edges"), F.sum("n").alias("count"))
    share = F.col("count") / F.sum("count").over(Window.partitionBy("variable"))
    return counts.select(
        "variable", "bin",
        F.get("edges", F.col("bin") - 1).alias("bin_lo"), F.get("edges", F.col("bin")).alias("bin_hi"),
        "count", share.alias("percent"),
    )


def bin_edges(df: DataFrame, columns: list[str], q: int, max_rows: int = MAX_ROWS_PER_TASK) -> dict[str, list[float]]:
    """Distinct quantile edges per column: at most ``q + 1`` numbers each."""
    freq = numeric_frequencies(df, columns)
    names = [f"e{i}" for i in range(q + 1)]
    rows = weighted_quantiles(freq, ["variable"], "value", "n", {n: i / q for i, n in enumerate(names)}, max_rows)
    return {r["variable"]: sorted({r[n] for n in names}) for r in rows.collect()}


def ranking_columns(columns: list[str]) -> list[tuple[str, str]]:
    return [(prefix, c) for prefix in fv.RANK_DIMENSIONS for c in columns if c.startswith(prefix + "_")]


def ranking_summary(df: DataFrame, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Mean and median rank per brand of every ranking block with at least five answers."""
    blocks = ranking_columns(df.columns)
    schema = ("dimension string, dimension_label string, variable string, brand string, "
              "mean_rank double, median_rank double, n bigint")
    if not blocks:
        return df.sparkSession.createDataFrame([], schema)
    freq = numeric_frequencies(df, [c for _, c in blocks])
    cum = running_totals(freq, ["variable"], "value", ["n"], max_rows)
    aggs, finals = quantile_columns("value", "cum_n", "tot_n", {"median_rank": 0.5})
    stats = cum.groupBy("variable").agg(
        F.sum("n").alias("total"), F.sum(F.col("value") * F.col("n")).alias("weighted"), *aggs,
    ).where(F.col("total") >= 5)
    dimension = F.coalesce(*[F.when(F.col("variable").startswith(p + "_"), F.lit(p)) for p in fv.RANK_DIMENSIONS])
    key = F.expr("substring(variable, length(dimension) + 2)")
    titles = F.create_map(*[F.lit(x) for kv in fv.RANK_DIMENSIONS.items() for x in kv])
    brands = F.create_map(*[F.lit(x) for kv in fv.BRAND_LABELS.items() for x in kv])
    return stats.withColumn("dimension", dimension).select(
        "dimension", F.try_element_at(titles, F.col("dimension")).alias("dimension_label"), "variable",
        F.coalesce(F.try_element_at(brands, key), F.replace(key, F.lit("_"), F.lit(" "))).alias("brand"),
        (F.col("weighted") / F.col("total")).alias("mean_rank"), *finals, F.col("total").alias("n"),
    )


def ranking_top(summary: DataFrame, n: int = 3) -> DataFrame:
    """Best brands per dimension: the lowest mean ranks."""
    w = Window.partitionBy("dimension").orderBy("mean_rank", "brand")
    return summary.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)
