"""Price sensitivity: monotone answers, cumulative curves and their crossing points.

Segments are a key of every step; the whole sample is one constant key.
"""

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.scalars import finite
from ..plans.holding import hold
from .ordered import MAX_ROWS_PER_TASK, running_totals
from .profile import number

GRID_POINTS = 5000
MIN_ROWS = 20
CURVES = tuple(f"{k}_curve" for k in fv.PRICE_KEYS)


def detect_price_columns(columns: list[str], configured: dict[str, str] | None = None) -> dict[str, str]:
    """The four price questions, configured or by name; empty unless all four are found."""
    def fits(key: str, name: str) -> bool:
        return contains_one(name, fv.PRICE_NEEDLES[key]) and not contains_one(name, fv.PRICE_GUARDS.get(key, ()))

    def contains_one(name: str, needles) -> bool:
        return any(map(name.lower().__contains__, needles))

    by_name = {key: next(filter(partial(fits, key), columns), None) for key in fv.PRICE_KEYS}
    by_name |= {key: name for key, name in (configured or {}).items() if key in by_name and name in columns}
    return by_name if all(by_name.values()) else {}


def monotonicity(df: DataFrame, prices: dict[str, str], keep: list[str]) -> DataFrame:
    """Rows with all four prices and whether they rise strictly."""
    t = df.select(*keep, *[finite(number(df, prices[k])).alias(k) for k in fv.PRICE_KEYS]).dropna(subset=list(fv.PRICE_KEYS))
    rising = (F.col("too_cheap") < F.col("cheap")) & (F.col("cheap") < F.col("expensive")) & (
        F.col("expensive") < F.col("too_expensive"))
    return t.withColumn("monotonic_valid", rising)


def price_counts(checked: DataFrame, segment: str) -> DataFrame:
    """``(segment, price, n_<kind>...)``: how often each price was named, per kind of price."""
    valid = checked.where("monotonic_valid")
    long = valid.select(segment, *fv.PRICE_KEYS).unpivot([segment], list(fv.PRICE_KEYS), "kind", "price")
    return long.groupBy(segment, "price").agg(
        *[F.sum((F.col("kind") == k).cast("bigint")).alias(f"n_{k}") for k in fv.PRICE_KEYS])


def price_grid(counts: DataFrame, segment: str, points: int = GRID_POINTS) -> DataFrame:
    """Observed prices and ``points`` even steps between the lowest and the highest, per segment."""
    ends = counts.groupBy(segment).agg(F.min("price").alias("lo"), F.max("price").alias("hi"),
                                       F.sum("n_too_cheap").alias("rows")).where(F.col("rows") >= MIN_ROWS)
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    at = F.transform(F.sequence(F.lit(0), F.lit(points - 1)),
                     lambda i: F.when(i == points - 1, F.col("hi")).otherwise(F.col("lo") + i * step))
    even = ends.select(segment, F.explode(at).alias("price"), *[F.lit(0).cast("bigint").alias(f"n_{k}") for k in fv.PRICE_KEYS])
    kept = counts.join(ends.select(segment), segment, "left_semi")
    return kept.unionByName(even).groupBy(segment, "price").agg(
        *[F.sum(f"n_{k}").alias(f"n_{k}") for k in fv.PRICE_KEYS])


def cumulative_prices(checked: DataFrame, segment: str, points: int = GRID_POINTS,
                      max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Grid with ``c_<kind>``: answers at or above (cheap kinds) or at or below (expensive kinds) the price."""
    counts = hold(price_counts(checked, segment))
    names = [f"n_{k}" for k in fv.PRICE_KEYS]
    cum = running_totals(price_grid(counts, segment, points), [segment], "price", names, max_rows)
    out = [segment, "price", *names, F.col("tot_n_too_cheap").alias("rows")]
    for k in fv.PRICE_KEYS:
        upto = F.col(f"cum_n_{k}")
        if k in ("too_cheap", "cheap"):
            out.append((F.col(f"tot_n_{k}") - upto + F.col(f"n_{k}")).alias(f"c_{k}"))
        else:
            out.append(upto.alias(f"c_{k}"))
        out.append(upto.alias(f"u_{k}"))
    return cum.select(*out)


def curves(cumulative: DataFrame, segment: str) -> DataFrame:
    return cumulative.select(segment, "price", *[
        (F.col(f"c_{k}") / F.col("rows")).alias(f"{k}_curve") for k in fv.PRICE_KEYS])


# Where two curves meet: name -> difference of the counts. Each difference only falls
# (or only rises) with the price, so its zero block and its sign change are extreme values
# of plain aggregates; no ordered scan of the grid is needed.
def _differences() -> dict[str, tuple[Column, bool]]:
    tc, c, e, te, n = (F.col(x) for x in ("c_too_cheap", "c_cheap", "c_expensive", "c_too_expensive", "rows"))
    return {
        "OPP": (tc - te, True),
        "IPP": (c - e, True),
        "PMC": (tc - e, True),
        "PME": (te - (n - e), False),
    }


def _crossing_aggregates(name: str, d: Column, falling: bool) -> list[Column]:
    price = F.col("price")
    before, after = (d > 0, d < 0) if falling else (d < 0, d > 0)
    return [
        F.min(F.when(d == 0, price)).alias(f"{name}_z0"), F.max(F.when(d == 0, price)).alias(f"{name}_z1"),
        F.max(F.when(before, F.struct(price.alias("x"), d.alias("y")))).alias(f"{name}_b"),
        F.min(F.when(after, F.struct(price.alias("x"), d.alias("y")))).alias(f"{name}_a"),
        F.min(F.struct(F.abs(d).alias("gap"), price.alias("x"))).alias(f"{name}_n"),
    ]


def _crossing_point(name: str) -> tuple[Column, Column]:
    z0, b, a, n = (F.col(f"{name}_{x}") for x in ("z0", "b", "a", "n"))
    middle = (z0 + F.col(f"{name}_z1")) / 2
    x0, x1, y0, y1 = b["x"], a["x"], b["y"] / F.col("rows"), a["y"] / F.col("rows")
    crossed = x0 - y0 * (x1 - x0) / (y1 - y0)
    found = z0.isNotNull() | (b.isNotNull() & a.isNotNull())
    point = F.coalesce(middle, crossed, n["x"])
    gap = F.when(found, F.lit(0.0)).otherwise(n["gap"] / F.col("rows"))
    return point.alias(name), gap.alias(f"{name}_gap")


def intersections(cumulative: DataFrame, segment: str) -> DataFrame:
    """``(segment, rows, OPP, OPP_gap, IPP, ..., median_<kind>)``, one row per segment."""
    aggs = [c for name, (d, falling) in _differences().items() for c in _crossing_aggregates(name, d, falling)]
    low = F.floor((F.col("rows") + 1) / 2)
    high = F.floor(F.col("rows") / 2) + 1
    for k in fv.PRICE_KEYS:
        aggs += [F.min(F.when(F.col(f"u_{k}") >= low, F.col("price"))).alias(f"_lo_{k}"),
                 F.min(F.when(F.col(f"u_{k}") >= high, F.col("price"))).alias(f"_hi_{k}")]
    t = cumulative.groupBy(segment).agg(F.first("rows").alias("rows"), *aggs)
    points = [c for name in _differences() for c in _crossing_point(name)]
    medians = [((F.col(f"_lo_{k}") + F.col(f"_hi_{k}")) / 2).alias(f"median_{k}") for k in fv.PRICE_KEYS]
    return t.select(segment, "rows", *points, *medians)


def price_summary(checked: DataFrame, segment: str, points: int = GRID_POINTS,
                  max_rows: int = MAX_ROWS_PER_TASK, cumulative: DataFrame | None = None) -> DataFrame:
    """``(segment, metric, value, description)``, 15 metrics per segment with enough monotone rows."""
    sample = checked.groupBy(segment).agg(
        F.count(F.lit(1)).alias("valid"), F.sum(F.col("monotonic_valid").cast("bigint")).alias("monotone"))
    cumulative = cumulative if cumulative is not None else cumulative_prices(checked, segment, points, max_rows)
    found = intersections(cumulative, segment)
    t = sample.where((F.col("valid") >= MIN_ROWS) & (F.col("monotone") >= MIN_ROWS)).join(found, segment)
    values = {
        "valid_raw_rows": F.col("valid"), "monotonic_valid_rows": F.col("monotone"),
        "monotonic_valid_rate": F.col("monotone") / F.col("valid"),
        "OPP_optimal_price_point": F.col("OPP"), "IPP_indifference_price_point": F.col("IPP"),
        "PMC_lower_acceptable_price": F.col("PMC"), "PME_upper_acceptable_price": F.col("PME"),
        **{f"median_{k}_price": F.col(f"median_{k}") for k in fv.PRICE_KEYS},
        **{f"{p}_curve_gap": F.col(f"{p}_gap") for p in _differences()},
    }
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), values[m].cast("double").alias("value"),
                              F.lit(d).alias("description")) for m, d in fv.PRICE_METRICS])
    return t.select(segment, F.inline(rows))


def price_pivot(summary: DataFrame, keys: list[str]) -> DataFrame:
    """One row per segment, the main metrics as columns."""
    metrics = ["valid_raw_rows", "monotonic_valid_rate", "OPP_optimal_price_point", "IPP_indifference_price_point",
               "PMC_lower_acceptable_price", "PME_upper_acceptable_price"]
    return summary.groupBy(*keys).pivot("metric", metrics).agg(F.first("value"))


def run_pricing(df: DataFrame, configured: dict[str, str] | None, row_id: str, segments: DataFrame | str | None = None,
                personas: DataFrame | None = None) -> dict[str, DataFrame]:
    """Overall tables, or per-segment ones when ``segments(row_id, segment)`` is given or, as ``"segment"``, a column of ``df``. Rows without segment are left out."""
    prices = detect_price_columns([c for c in df.columns if c != row_id], configured)
    if not prices:
        return {}
    if segments is None:
        checked = hold(monotonicity(df, prices, [row_id]).withColumn("_all", F.lit(1)))
        segment, drop = "_all", ["_all"]
    else:
        base = df if isinstance(segments, str) else df.drop("segment").join(segments.select(row_id, "segment"), row_id)
        checked = hold(monotonicity(base.where("segment is not null"), prices, [row_id, "segment"]))
        segment, drop = "segment", []
    enough = checked.groupBy(segment).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= MIN_ROWS)
    checks = checked.join(F.broadcast(enough.select(segment)), segment, "left_semi")  # one row per segment
    cumulative = hold(cumulative_prices(checks, segment))
    out = {
        "monotonicity": checks,
        "summary": price_summary(checks, segment, cumulative=cumulative),
        "curves": curves(cumulative, segment),
    }
    if personas is not None:
        named = personas.select("segment", "persona")
        out = {k: t.join(F.broadcast(named), "segment", "left") for k, t in out.items()}  # one row per segment
    return {k: t.drop(*drop) for k, t in out.items()}
