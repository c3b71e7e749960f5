"""Running totals and exact quantiles without a single-task window.

A window that is partitioned by a handful of variables or segments would sort each of them in
one task. Where a group has more than ``max_rows``, the table is cut into sorted ranges of all keys
and values first: every range is summed on its own and then shifted by the ranges before it.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.holding import hold

MAX_ROWS_PER_TASK = 1_000_000


def running_totals(df: DataFrame, keys: list[str], order: str, columns: list[str],
                   max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Add ``cum_<c>`` (sum up to and including the row) and ``tot_<c>`` per key group; NULL keys are a group.

    ``order`` is numeric and unique within a group. ``df`` is held: its group sizes are looked at first.
    Both ways give the same rows; a group may have any number of ranges, each the size of a task.
    """
    df = hold(df)
    largest = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).agg(F.max("_rows"), F.sum("_rows")).first()
    if (largest[0] or 0) <= max_rows:
        whole = Window.partitionBy(*keys)
        upto = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select(
            "*",
            *[F.sum(c).over(upto).alias(f"cum_{c}") for c in columns],
            *[F.sum(c).over(whole).alias(f"tot_{c}") for c in columns],
        )

    # The ranges are held: both uses below have to see the same ones.
    ranges = max(2, -(-4 * largest[1] // max_rows))
    ranged = hold(df.repartitionByRange(ranges, *keys, order).withColumn("_range", F.spark_partition_id()))
    sums = ranged.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_s_{c}") for c in columns])
    over_ranges = Window.partitionBy(*keys)  # one row per range
    before = over_ranges.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_at"),
        *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_b_{c}") for c in columns],
        *[F.sum(f"_s_{c}").over(over_ranges).alias(f"tot_{c}") for c in columns],
    )
    inside = Window.partitionBy("_range", *keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", *[F.sum(c).over(inside).alias(f"_l_{c}") for c in columns])
    same = reduce(lambda x, k: x & F.col(k).eqNullSafe(F.col(f"_k_{k}")), keys, F.col("_range") == F.col("_at"))
    return local.join(shifts, same).select(
        *df.columns,
        *[(F.col(f"_l_{c}") + F.col(f"_b_{c}")).alias(f"cum_{c}") for c in columns],
        *[F.col(f"tot_{c}") for c in columns],
    )


def quantile_columns(value: str, cum: str, tot: str, probs: dict[str, float]) -> tuple[list[Column], list[Column]]:
    """Linear-interpolated quantiles as aggregates over a running-total table.

    Returns the aggregates and the projection that combines them.
    """
    aggs, finals = [], []
    for name, p in probs.items():
        at = (F.col(tot) - 1) * F.lit(float(p))
        low, high = F.floor(at), F.ceil(at)
        aggs += [
            F.min(F.when(F.col(cum) >= low + 1, F.col(value))).alias(f"_{name}_lo"),
            F.min(F.when(F.col(cum) >= high + 1, F.col(value))).alias(f"_{name}_hi"),
            F.max(at - low).alias(f"_{name}_w"),
        ]
        lo, hi, w = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_w")
        finals.append((lo + (hi - lo) * w).alias(name))
    return aggs, finals


def weighted_quantiles(freq: DataFrame, keys: list[str], value: str, weight: str, probs: dict[str, float],
                       max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Exact quantiles per key of a ``(keys, value, weight)`` frequency table."""
    cum = running_totals(freq, keys, value, [weight], max_rows)
    aggs, finals = quantile_columns(value, f"cum_{weight}", f"tot_{weight}", probs)
    return cum.groupBy(*keys).agg(*aggs).select(*keys, *finals)
