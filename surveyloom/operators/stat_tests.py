"""Randomness and independence tests."""

import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.pvalues import chi_square_p, normal_p, verdict
from ..functions.scalars import sql_text, text_structs
from .describe import bin_edges, top_levels_per_key
from .headers import resolve_names
from .moments import correlations
from .ordered import weighted_quantiles
from .profile import (ColumnProfile, is_categorical, is_id_like, label, label_text, level_frequencies, number,
                      number_text, numeric_frequencies, profile)

RANDOMNESS_COLUMNS = ["variable", "method", "n", "n_low_or_other", "n_high_or_top", "runs", "expected_runs",
                      "statistic", "df", "approx_p", "interpretation"]
INDEPENDENCE_COLUMNS = ["variable_a", "variable_b", "method", "n", "statistic", "df", "approx_p", "effect_size",
                        "effect_size_name", "interpretation"]
RANDOMNESS_SCHEMA = ("variable string, method string, n bigint, n_low_or_other bigint, n_high_or_top bigint, "
                     "runs bigint, expected_runs double, statistic double, df bigint, approx_p double, "
                     "interpretation string")
INDEPENDENCE_SCHEMA = ("variable_a string, variable_b string, method string, n bigint, statistic double, df bigint, "
                       "approx_p double, effect_size double, effect_size_name string, interpretation string")
NULL_LEVEL = "nan"
_TILE_ROWS = 1 << 15


# --- runs test --------------------------------------------------------------------------


def sign_columns(df: DataFrame, stats: dict[str, ColumnProfile]) -> dict[str, Column]:
    """0/1 per variable: above the median, or equal to the most frequent level; NULL is left out."""
    measured = [p.name for p in stats.values() if p.numeric and p.distinct > 2]
    named = [p.name for p in stats.values() if p.name not in measured]
    signs: dict[str, Column] = {}
    if measured:
        freq = numeric_frequencies(df, measured)
        medians = weighted_quantiles(freq, ["variable"], "value", "n", {"median": 0.5}).collect()
        for r in medians:
            value = number(df, r["variable"])
            signs[r["variable"]] = F.when(value != F.lit(r["median"]), (value > F.lit(r["median"])).cast("double"))
    tops = {n: stats[n].levels[0][0] for n in named if stats[n].levels}
    unknown = [n for n in named if n not in tops]
    if unknown:
        top = top_levels_per_key(level_frequencies(df, unknown), ["variable"], 1)
        tops.update({r["variable"]: r["level"] for r in top.collect()})
    for n, level in tops.items():
        signs[n] = (label(df, n) == F.lit(level)).cast("double")
    return {n: signs[n] for n in stats if n in signs}


def run_segments(df: DataFrame, signs: dict[str, Column], order: list[str]) -> DataFrame:
    """``(part, variable, first, last, changes, n1, n2)`` of every range of the ordered sequence."""
    names = list(signs)
    keep = df.select(*order, *[s.alias(f"_s{k}") for k, s in enumerate(signs.values())])
    ranged = keep.repartitionByRange(*order).sortWithinPartitions(*order).select(*[f"_s{k}" for k in range(len(names))])

    def summarise(batches):
        part = TaskContext.get().partitionId()
        first, last = [None] * len(names), [None] * len(names)
        changes, ones, n = np.zeros(len(names), int), np.zeros(len(names), int), np.zeros(len(names), int)
        for batch in batches:
            for k in range(len(names)):
                s = batch.column(k).to_numpy(zero_copy_only=False).astype(float)
                s = s[~np.isnan(s)]
                if not len(s):
                    continue
                changes[k] += int(np.count_nonzero(s[1:] != s[:-1]))
                if last[k] is None:
                    first[k] = s[0]
                else:
                    changes[k] += int(s[0] != last[k])
                last[k] = s[-1]
                ones[k] += int(s.sum())
                n[k] += len(s)
        seen = [k for k in range(len(names)) if n[k]]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part] * len(seen), pa.int32()),
            "variable": pa.array([names[k] for k in seen], pa.string()),
            "first": pa.array([first[k] for k in seen], pa.float64()),
            "last": pa.array([last[k] for k in seen], pa.float64()),
            "changes": pa.array([int(changes[k]) for k in seen], pa.int64()),
            "n1": pa.array([int(ones[k]) for k in seen], pa.int64()),
            "n2": pa.array([int(n[k] - ones[k]) for k in seen], pa.int64()),
        })

    return ranged.mapInArrow(
        summarise, "part int, variable string, first double, last double, changes bigint, n1 bigint, n2 bigint")


def runs_statistics(segments: DataFrame) -> DataFrame:
    """Joins the ranges of each variable (one row per range) and computes z."""
    w = Window.partitionBy("variable").orderBy("part")
    seam = F.coalesce((F.col("first") != F.lag("last").over(w)).cast("bigint"), F.lit(0))
    t = segments.withColumn("seam", seam).groupBy("variable").agg(
        (F.lit(1) + F.sum(F.col("changes") + F.col("seam"))).alias("runs"),
        F.sum("n1").alias("n_high_or_top"), F.sum("n2").alias("n_low_or_other"))
    n1, n2 = F.col("n_high_or_top").cast("double"), F.col("n_low_or_other").cast("double")
    n, twice = n1 + n2, 2.0 * n1 * n2
    expected = 1.0 + F.try_divide(twice, n)
    variance = F.try_divide(twice * (twice - n), n * n * (n - 1.0))
    z = F.try_divide(F.col("runs") - F.col("expected_runs"), F.sqrt("_variance"))
    return (t.where((n1 > 0) & (n2 > 0))
            .withColumn("n", F.col("n_high_or_top") + F.col("n_low_or_other"))
            .withColumn("expected_runs", expected).withColumn("_variance", variance)
            .where(F.col("_variance") > 0).withColumn("statistic", z))


def runs_test(df: DataFrame, columns: list[str], order: list[str],
              stats: dict[str, ColumnProfile] | None = None) -> DataFrame:
    """Runs test of each column along ``order`` (a unique key); at least 20 answers, two distinct."""
    stats = stats or profile(df, columns)
    usable = {c: stats[c] for c in columns if stats[c].count >= 20 and stats[c].distinct >= 2}
    if not usable:
        return df.sparkSession.createDataFrame([], RANDOMNESS_SCHEMA)
    t = runs_statistics(run_segments(df, sign_columns(df, usable), order)).withColumn(
        "approx_p", normal_p(F.col("statistic")))
    return t.select(
        "variable", F.lit("runs_test_sequence").alias("method"), "n", "n_low_or_other", "n_high_or_top", "runs",
        "expected_runs", "statistic", F.lit(None).cast("bigint").alias("df"), "approx_p",
        verdict(F.col("approx_p"), "sequence_may_be_non_random", "sequence_randomness_not_rejected").alias("interpretation"))


def level_balance(df: DataFrame, columns: list[str], max_levels: int = 30) -> DataFrame:
    """Chi-square of the observed levels against equal shares."""
    freq = level_frequencies(df, columns)
    t = freq.groupBy("variable").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"))
    statistic = F.col("k") * F.col("squares") / F.col("n") - F.col("n")
    t = (t.where(F.col("k").between(2, max_levels))
         .withColumn("statistic", F.greatest(statistic, F.lit(0.0))).withColumn("df", F.col("k") - 1)
         .withColumn("approx_p", chi_square_p(F.col("statistic"), F.col("df"))))
    none = F.lit(None)
    return t.select(
        "variable", F.lit("level_balance_uniformity").alias("method"), "n",
        none.cast("bigint").alias("n_low_or_other"), none.cast("bigint").alias("n_high_or_top"),
        none.cast("bigint").alias("runs"), none.cast("double").alias("expected_runs"), "statistic", "df", "approx_p",
        verdict(F.col("approx_p"), "level_distribution_not_uniform", "level_balance_not_rejected").alias("interpretation"))


def run_randomness_tests(df: DataFrame, order: list[str], configured: list[str] = (), id_columns=(),
                         max_variables: int | None = None, stats: dict[str, ColumnProfile] | None = None) -> DataFrame:
    """All configured variables, else the first ``max_variables`` that qualify (None: all)."""
    stats = stats or profile(df)
    configured = [c for c in dict.fromkeys(configured) if c in stats]
    names = configured or [p.name for p in stats.values()
                           if not is_id_like(p, id_columns) and p.count >= 20 and p.distinct > 1][:max_variables]
    tests = runs_test(df, names, order, stats) if names else df.sparkSession.createDataFrame([], RANDOMNESS_SCHEMA)
    balanced = [c for c in configured if c in names and is_categorical(stats[c])]
    return tests.unionByName(level_balance(df, balanced)) if balanced else tests


# --- chi-square -------------------------------------------------------------------------


def level_code(df: DataFrame, name: str, levels: list[str]) -> tuple[str, int]:
    """SQL of a small integer per level and how many there are; missing answers are a level of their own."""
    known = [*levels, *([] if NULL_LEVEL in levels else [NULL_LEVEL])]
    text = f"coalesce({label_text(df, name)}, {sql_text(NULL_LEVEL)})"
    return f"array_position(array({', '.join(sql_text(v) for v in known)}), {text})", len(known) + 1


def bin_code(df: DataFrame, name: str, edges: list[float]) -> tuple[str, int]:
    value = number_text(df, name)
    below = " + ".join(f"if({value} > {e!r}D, 1L, 0L)" for e in edges)
    return f"if({value} is null, 0L, greatest({below}, 1L))", len(edges) + 1


def coded_tests(df: DataFrame, codes: dict[str, tuple[str, int]], pairs: list[tuple[str, str]]) -> DataFrame:
    """``(pair, n, statistic, df, effect_size)`` of all pairs in one pass.

    Every column is coded once. A task counts all pairs tile by tile into their small tables and sends those, whatever
    its rows; a pair's table then meets in one row, from which its statistic follows.
    """
    used = list(dict.fromkeys(c for p in pairs for c in p))
    at = {c: i for i, c in enumerate(used)}
    width = [codes[c][1] for c in used]
    place = [(at[a], at[b]) for a, b in pairs]
    ends = np.cumsum([width[i] * width[j] for i, j in place])
    starts = np.concatenate([[0], ends[:-1]])

    def count(batches):
        total = np.zeros(ends[-1], np.int64)
        for batch in batches:
            columns = [batch.column(k).to_numpy() for k in range(len(used))]
            for first in range(0, batch.num_rows, _TILE_ROWS):
                tile = [c[first:first + _TILE_ROWS].astype(np.int64) for c in columns]
                for (i, j), lo, hi in zip(place, starts, ends):
                    total[lo:hi] += np.bincount(tile[i] * width[j] + tile[j], minlength=hi - lo)
        seen = np.flatnonzero(total)
        pair = np.searchsorted(ends, seen, side="right")
        yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int32()), pa.array(seen - starts[pair], pa.int32()), pa.array(total[seen])], names=["pair", "cell", "n"])

    def test(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                i, j = place[row["pair"]]
                table = np.zeros((width[i], width[j]))
                table.flat[[c["cell"] for c in row["cells"]]] = [c["n"] for c in row["cells"]]
                table = table[table.any(axis=1)][:, table.any(axis=0)]
                r, c = table.shape
                if r > 1 and c > 1:
                    n = table.sum()
                    expected = np.outer(table.sum(axis=1), table.sum(axis=0) / n)
                    statistic = float(((table - expected) ** 2 / expected).sum())
                    out.append((row["pair"], int(n), statistic, (r - 1) * (c - 1), float(np.sqrt(statistic / (n * (min(r, c) - 1))))))
            yield pa.RecordBatch.from_pylist([dict(zip(names, o)) for o in out], schema)

    names = ["pair", "n", "statistic", "df", "effect_size"]
    schema = pa.schema(list(zip(names, [pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.float64()])))
    coded = df.selectExpr(*[f"cast({codes[c][0]} as smallint) as _k{i}" for i, c in enumerate(used)])
    cells = coded.mapInArrow(count, "pair int, cell int, n bigint").groupBy("pair", "cell").agg(F.sum("n").alias("n"))
    tables = cells.groupBy("pair").agg(F.collect_list(F.struct("cell", "n")).alias("cells"))
    return tables.mapInArrow(test, "pair int, n bigint, statistic double, df bigint, effect_size double")


def text_cells(df: DataFrame, pairs: list[tuple[int, str, str]]) -> DataFrame:
    """``(pair, a, b, n)`` for columns with any number of levels."""
    def text(c):
        return f"coalesce({label_text(df, c)}, {sql_text(NULL_LEVEL)})"
    structs = ", ".join(f"named_struct('pair', {i}, 'a', {text(a)}, 'b', {text(b)})" for i, a, b in pairs)
    return df.selectExpr(f"inline(array({structs}))").groupBy("pair", "a", "b").agg(F.expr("count(1) as n"))


def chi_square_cells(cells: DataFrame) -> DataFrame:
    """``(pair, n, statistic, df, effect_size)`` from observed cells only.

    An unobserved cell adds its expectation; together they are ``N - sum(E over observed)``.
    Margins come from aggregations joined back, so no level has to fit into one task.
    """
    rows = cells.groupBy("pair", "a").agg(F.sum("n").alias("row_n"))
    cols = cells.groupBy("pair", "b").agg(F.sum("n").alias("col_n"))
    sizes = rows.groupBy("pair").agg(F.sum("row_n").alias("total"), F.count(F.lit(1)).alias("r"))
    widths = cols.groupBy("pair").agg(F.count(F.lit(1)).alias("c"))
    # One row per pair: the pairs are listed by the caller.
    sizes = F.broadcast(sizes.join(widths, "pair"))
    full = cells.join(rows, ["pair", "a"]).join(cols, ["pair", "b"]).join(sizes, "pair")
    e = F.col("row_n") * (F.col("col_n") / F.col("total"))
    part = full.groupBy("pair").agg(
        F.sum((F.col("n") - e) * (F.col("n") - e) / e).alias("_seen"), F.sum(e).alias("_expected"),
        F.first("total").alias("n"), F.first("r").alias("r"), F.first("c").alias("c"))
    t = part.where((F.col("r") > 1) & (F.col("c") > 1))
    statistic = F.col("_seen") + F.greatest(F.col("n") - F.col("_expected"), F.lit(0.0))
    narrow = F.greatest(F.lit(1), F.least(F.col("r"), F.col("c")) - 1)
    return (t.withColumn("statistic", statistic).withColumn("df", (F.col("r") - 1) * (F.col("c") - 1))
            .withColumn("effect_size", F.sqrt(F.col("statistic") / (F.col("n") * narrow)))
            .select("pair", "n", "statistic", "df", "effect_size"))


def _association(t: DataFrame, pairs: list[tuple[str, str]], method: str) -> DataFrame:
    t = t.withColumn("_names", F.get(text_structs(pairs, ["a", "b"]), F.col("pair"))).withColumn(
        "approx_p", chi_square_p(F.col("statistic"), F.col("df")))
    return t.select(
        F.col("_names.a").alias("variable_a"), F.col("_names.b").alias("variable_b"), F.lit(method).alias("method"),
        "n", "statistic", "df", "approx_p", "effect_size", F.lit("cramers_v").alias("effect_size_name"),
        verdict(F.col("approx_p"), "association_detected", "independence_not_rejected").alias("interpretation"))


def chi_square_tests(df: DataFrame, pairs: list[tuple[str, str]], method: str = "chi_square_independence",
                     stats: dict[str, ColumnProfile] | None = None, bins: dict[str, list[float]] | None = None) -> DataFrame:
    """Chi-square independence and Cramer's V of the pairs. ``bins`` holds edges of columns to group first."""
    if not pairs:
        return df.sparkSession.createDataFrame([], INDEPENDENCE_SCHEMA)
    bins = bins or {}
    used = list(dict.fromkeys(c for p in pairs for c in p))
    stats = stats or profile(df, used)
    codes = {}
    for c in used:
        if c in bins:
            codes[c] = bin_code(df, c, bins[c])
        elif len(stats[c].levels) == stats[c].distinct:
            codes[c] = level_code(df, c, [lv for lv, _ in stats[c].levels])
    small = [(a, b) for a, b in pairs if a in codes and b in codes]
    large = [(a, b) for a, b in pairs if (a, b) not in small]
    ordered = small + large
    tables = []
    if small:
        tables.append(coded_tests(df, codes, small))
    if large:
        tables.append(chi_square_cells(text_cells(df, [(len(small) + i, a, b) for i, (a, b) in enumerate(large)])))
    tests = tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])
    return _association(tests, ordered, method)


def categorical_pairs(stats: dict[str, ColumnProfile], id_columns=(), max_columns: int | None = None,
                      max_pairs: int | None = None) -> list[tuple[str, str]]:
    names = [p.name for p in stats.values()
             if not is_id_like(p, id_columns) and is_categorical(p) and 2 <= p.distinct <= 20]
    return list(itertools.combinations(names[:max_columns], 2))[:max_pairs]


def segment_tests(df: DataFrame, segment: str, stats: dict[str, ColumnProfile], skip: set[frozenset] = frozenset(),
                  id_columns=(), max_columns: int | None = None) -> DataFrame:
    """Segment against every other column; numbers with more than 12 values are cut into quartiles."""
    names = [p.name for p in stats.values() if p.name != segment and not is_id_like(p, id_columns)
             and p.count >= 12 and p.distinct > 1][:max_columns]
    names = [c for c in names if frozenset((segment, c)) not in skip]
    wide = [c for c in names if stats[c].numeric and stats[c].distinct > 12]
    bins = bin_edges(df, wide, 4) if wide else {}
    bins = {c: e for c, e in bins.items() if len(e) > 1}
    names = [c for c in names if c not in wide or c in bins]
    return chi_square_tests(df, [(segment, c) for c in names], "segment_chi_square_independence", stats, bins)


# --- correlation screen -----------------------------------------------------------------


def pearson_pairs(stats: dict[str, ColumnProfile], priority: list[str] = (), id_columns=(),
                  max_columns: int | None = None, max_pairs: int | None = None) -> list[tuple[str, str]]:
    """Pairs with a priority column, all of them; without one the first pairs of the first columns (None: all)."""
    names = [p.name for p in stats.values() if not is_id_like(p, id_columns) and p.numeric and p.distinct > 2]
    priority = [c for c in priority if c in names]
    if priority:
        candidates = [(a, b) for a in priority for b in names if a != b]
    else:
        candidates = list(itertools.combinations(names[:max_columns], 2))[:max_pairs]
    unique: dict[frozenset, tuple[str, str]] = {}
    for a, b in candidates:
        unique.setdefault(frozenset((a, b)), (a, b))
    return list(unique.values())


def pearson_screen(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Fisher z test of the pairs with at least 12 shared rows."""
    if not pairs:
        return df.sparkSession.createDataFrame([], INDEPENDENCE_SCHEMA)
    columns = list(dict.fromkeys(c for p in pairs for c in p))
    wanted = df.sparkSession.createDataFrame(pairs, "variable_a string, variable_b string")
    wanted = wanted.withColumn("lo", F.least("variable_a", "variable_b")).withColumn("hi", F.greatest("variable_a", "variable_b"))
    known = correlations(df, columns).select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), "n", "r")
    z = F.atanh("r") * F.sqrt(F.greatest(F.lit(1), F.col("n") - 3))
    t = (wanted.join(known, ["lo", "hi"]).where((F.col("n") >= 12) & (F.abs("r") < 1))
         .withColumn("statistic", z).withColumn("approx_p", normal_p(F.col("statistic"))))
    return t.select(
        "variable_a", "variable_b", F.lit("pearson_correlation_independence").alias("method"), "n", "statistic",
        F.lit(None).cast("bigint").alias("df"), "approx_p", F.col("r").alias("effect_size"),
        F.lit("pearson_r").alias("effect_size_name"),
        verdict(F.col("approx_p"), "association_detected", "independence_not_rejected").alias("interpretation"))


def run_independence_tests(df: DataFrame, pairs: list[tuple[str, str]] = (), priority: list[str] = (),
                           segment: str = "segment", id_columns=(), mapping: dict[str, str] | None = None,
                           limits: dict | None = None, stats: dict[str, ColumnProfile] | None = None) -> DataFrame:
    """Categorical pairs, segment against the rest, correlations of the numeric columns.

    ``limits`` may cut what is chosen automatically (pair_columns, pairs, segment_columns,
    correlation_columns, correlation_pairs); without it the described limits hold. Named pairs are all tested.
    """
    stats = stats or profile(df)
    cut = {"pair_columns": 18, "pairs": 100, "segment_columns": 40, "correlation_columns": 14, "correlation_pairs": 100} if limits is None else limits
    explicit = [tuple(resolve_names(p, mapping or {})) for p in pairs]
    explicit = [(a, b) for a, b in explicit if a in stats and b in stats]
    chosen = [(a, b) for a, b in explicit or categorical_pairs(stats, id_columns, cut.get("pair_columns"), cut.get("pairs"))
              if is_categorical(stats[a]) and is_categorical(stats[b])]
    tests = chi_square_tests(df, chosen, stats=stats)
    if segment in df.columns:
        tests = tests.unionByName(segment_tests(df, segment, stats, {frozenset(p) for p in chosen}, id_columns, cut.get("segment_columns")))
    return tests.unionByName(pearson_screen(df, pearson_pairs(stats, priority, id_columns, cut.get("correlation_columns"), cut.get("correlation_pairs"))))
