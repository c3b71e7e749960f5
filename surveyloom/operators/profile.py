"""Column profile: one scan for the cheap facts, one partial aggregation for exact distinct counts.

Everything that classifies columns reads the small result of this module.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fv
from ..functions.scalars import is_numeric, label_sql, number_sql, round6, sql_name, text_array

SMALL_DISTINCT = 64
_HELD_VALUES = 2_000_000  # different values that a counting task keeps


@dataclass
class ColumnProfile:
    name: str
    numeric: bool
    rows: int
    count: int
    distinct: int
    mean: float | None = None
    std_pop: float | None = None
    low: float | None = None
    high: float | None = None
    levels: list[tuple[str, int]] = field(default_factory=list)

    @property
    def filled(self) -> float:
        return self.count / self.rows if self.rows else 0.0


def profiled_columns(df: DataFrame) -> list[str]:
    """Numeric and text columns; dates, nested values and binaries are not survey answers."""
    return [f.name for f in df.schema if is_numeric(f.dataType) or isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_numeric(f.dataType)]


def number_text(df: DataFrame, name: str) -> str:
    return number_sql(name, df.schema[name].dataType)


def label_text(df: DataFrame, name: str) -> str:
    return label_sql(name, df.schema[name].dataType)


def number(df: DataFrame, name: str):
    return F.expr(number_text(df, name))


def label(df: DataFrame, name: str):
    return F.expr(label_text(df, name))


def numeric_frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(variable, value, n)`` of the non-null numbers; repeated answers shrink in the scanning tasks.

    A task sorts its batches column by column and merges the counts; what it holds is bounded, more different values
    are sent on in several parts.
    """
    wide = df.selectExpr(*[f"{number_text(df, c)} as _v{k}" for k, c in enumerate(columns)])

    def count(batches):
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in columns]
        size = 0

        def merged(parts):
            values, at = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
            return values, np.bincount(at, np.concatenate([n for _, n in parts]), len(values)).astype(np.int64)

        def sent():
            for k, parts in enumerate(held):
                if parts:
                    values, n = merged(parts)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), k, np.int32)), pa.array(values), pa.array(n)], names=["k", "value", "n"])

        for batch in batches:
            for k, parts in enumerate(held):
                values = batch.column(k).to_numpy(zero_copy_only=False).astype(np.float64)
                values, n = np.unique(values[~np.isnan(values)], return_counts=True)
                if len(values):
                    parts.append((values + 0.0, n))
                if len(parts) == 32:
                    held[k] = [merged(parts)]
            size = sum(len(v) for parts in held for v, _ in parts)
            if size > _HELD_VALUES:
                yield from sent()
                held = [[] for _ in columns]
        yield from sent()

    counted = wide.mapInArrow(count, "k int, value double, n bigint").groupBy("k", "value").agg(F.sum("n").alias("n"))
    return counted.select(F.get(text_array(columns), F.col("k")).alias("variable"), "value", "n")


def level_frequencies(df: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """``(keys, variable, level, n)`` of the non-null answers as text."""
    wide = df.selectExpr(*keys, *[f"{label_text(df, c)} as {sql_name(c)}" for c in columns])
    long = wide.unpivot(list(keys), columns, "variable", "level").where("level is not null")
    return long.groupBy(*keys, "variable", "level").agg(F.expr("count(1) as n"))


def exact_distincts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(variable, distinct)``; two-step aggregation, so no set is ever held for one variable."""
    texts = [c for c in columns if not is_numeric(df.schema[c].dataType)]
    numbers = [c for c in columns if c not in texts]
    parts = []
    if numbers:
        parts.append(numeric_frequencies(df, numbers).select("variable"))
    if texts:
        parts.append(level_frequencies(df, texts).select("variable"))
    values = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return values.groupBy("variable").agg(F.count(F.lit(1)).alias("distinct"))


def scan_statistics(df: DataFrame, columns: list[str], sketch: bool = False) -> DataFrame:
    """``(variable, numeric, rows, count, [approx_distinct,] mean, std, std_pop, low, high)``.

    One row per column, aggregated in the scanning tasks. The long form has one small buffer per
    column, so the stage stays in generated code for any number of columns; a wide aggregation
    would not. The distinct-count sketch is an imperative aggregate outside generated code, so only
    callers that need it ask for it.
    """
    numbers = [c for c in columns if is_numeric(df.schema[c].dataType)]
    texts = [c for c in columns if c not in numbers]
    parts = []
    for names, numeric, text in ((numbers, True, number_text), (texts, False, lambda d, c: sql_name(c))):
        if not names:
            continue
        wide = df.selectExpr(*[f"{text(df, c)} as {sql_name(c)}" for c in names])
        value = "v" if numeric else "cast(null as double)"
        parts.append(wide.unpivot([], names, "variable", "v").groupBy("variable").agg(
            F.lit(numeric).alias("numeric"), F.expr("count(1) as rows"), F.expr("count(v) as count"),
            *([F.expr("approx_count_distinct(v) as approx_distinct")] if sketch else []),
            *[F.expr(f"{f}({value}) as {n}") if numeric else F.expr(f"{value} as {n}") for f, n in (
                ("avg", "mean"), ("stddev_samp", "std"), ("stddev_pop", "std_pop"), ("min", "low"), ("max", "high"))]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Profile as a table with exact distinct counts."""
    columns = columns or profiled_columns(df)
    stats = scan_statistics(df, columns)
    joined = stats.join(exact_distincts(df, columns), "variable", "left")
    return joined.select(
        "variable", "count", (F.col("rows") - F.col("count")).alias("missing"),
        F.coalesce("distinct", F.lit(0)).alias("distinct"),
        round6(F.col("low")).alias("min"), round6(F.col("high")).alias("max"),
    )


def _undecided(rows: int, approx: int) -> bool:
    """HLL alone cannot tell on which side of a distinct-count rule the column lies."""
    bound = max(20, rows * 0.75)
    return approx <= SMALL_DISTINCT or 0.75 * bound <= approx <= 1.25 * bound


def profile(df: DataFrame, columns: list[str] | None = None, exact: bool = False) -> dict[str, ColumnProfile]:
    """Profile for the driver: one row per column, levels only where there are few.

    Sketches settle the columns that lie far from every distinct-count rule; only the others
    are counted exactly (all of them with ``exact``).
    """
    columns = columns or profiled_columns(df)
    if not columns:
        return {}
    stats = {r["variable"]: r for r in scan_statistics(df, columns, sketch=True).collect()}
    if not stats:
        return {c: ColumnProfile(c, is_numeric(df.schema[c].dataType), 0, 0, 0) for c in columns}
    near = [c for c in columns if stats[c]["approx_distinct"] > SMALL_DISTINCT
            and (exact or _undecided(stats[c]["rows"], stats[c]["approx_distinct"]))]
    distinct = {c: int(stats[c]["approx_distinct"]) for c in columns}
    if near:
        distinct.update({r["variable"]: r["distinct"] for r in exact_distincts(df, near).collect()})
    few = [c for c in columns if stats[c]["approx_distinct"] <= SMALL_DISTINCT]
    levels: dict[str, list] = {c: [] for c in columns}
    if few:
        for r in level_frequencies(df, few).collect():
            levels[r["variable"]].append((r["level"], r["n"]))
        for c in few:
            distinct[c] = len(levels[c])
    return {
        c: ColumnProfile(
            name=c, numeric=stats[c]["numeric"], rows=stats[c]["rows"], count=stats[c]["count"],
            distinct=distinct[c], mean=stats[c]["mean"], std_pop=stats[c]["std_pop"],
            low=stats[c]["low"], high=stats[c]["high"],
            levels=sorted(levels[c], key=lambda lv: (-lv[1], lv[0])),
        )
        for c in columns
    }


def profiles_of(df: DataFrame, columns: list[str], stats: dict[str, ColumnProfile] | None = None) -> dict[str, ColumnProfile]:
    """Profiles of the columns: those at hand, the others in one scan."""
    stats = stats or {}
    missing = [c for c in columns if c not in stats]
    return {c: stats[c] for c in columns if c in stats} | (profile(df, missing) if missing else {})


def all_levels(df: DataFrame, p: ColumnProfile) -> list[str]:
    """The levels of one column, however many: from the profile if it has them, else counted now."""
    if len(p.levels) == p.distinct:
        return [level for level, _ in p.levels]
    return [r["level"] for r in level_frequencies(df, [p.name]).select("level").toLocalIterator()]


# --- classifiers over the profile ---------------------------------------------------


def is_id_like(p: ColumnProfile, id_columns=(), tokens=fv.ID_TOKENS) -> bool:
    low = p.name.lower()
    if p.name in set(id_columns) or any(t in low for t in tokens):
        return True
    return p.distinct > max(20, p.rows * 0.75)


def is_likert_item(p: ColumnProfile, id_columns=()) -> bool:
    if not p.numeric or is_id_like(p, id_columns):
        return False
    if p.name.lower().startswith(fv.BASIC_HINTS) or p.count < 8:
        return False
    return 2 <= p.distinct <= 11 and p.low >= 0 and p.high <= 10


def is_categorical(p: ColumnProfile) -> bool:
    if p.count == 0:
        return False
    return (not p.numeric) or 2 <= p.distinct <= 12


def is_binary_selection(p: ColumnProfile) -> bool:
    values = {level.strip().lower() for level, _ in p.levels}
    if p.distinct != len(p.levels) or len(values) < 2:
        return False
    return any(values <= set(allowed) for allowed in fv.BINARY_VALUE_SETS)


def variable_matches(name: str, hints) -> bool:
    """Driver-side twin of :func:`functions.scalars.matches_hints` for column names."""
    low = name.lower()
    tokens = "".join(ch if ch.isascii() and ch.isalnum() else " " for ch in low).split()
    return any(h in low if len(h) >= 5 else h in tokens or ("_" in h and f"_{h}_" in f"_{low}_") for h in hints)


def classification(df: DataFrame, columns: list[str] | None = None, id_columns=(), exact: bool = False) -> DataFrame:
    """One row per column with every class flag. ``exact`` counts the distinct values of columns that are far from every rule too."""
    rows = [(p.name, p.numeric, p.distinct, is_id_like(p, id_columns), is_likert_item(p, id_columns), is_categorical(p))
            for p in profile(df, columns, exact).values()]
    return df.sparkSession.createDataFrame(
        rows, "variable string, numeric boolean, distinct bigint, id_like boolean, likert_item boolean, categorical boolean")


def binary_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(variable, is_binary)`` by the stripped, lower-cased answer sets."""
    rows = [(p.name, is_binary_selection(p)) for p in profile(df, columns).values() if p.count]
    return df.sparkSession.createDataFrame(rows, "variable string, is_binary boolean")
