"""Multi-item scales: reliability, detection and scoring."""

import heapq
import itertools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed_values as fv
from ..plans.holding import hold
from .headers import resolve_names, slug_names
from .moments import batch_matrix, correlations
from .profile import ColumnProfile, is_likert_item, number, number_text, profile

_PATTERN_BYTES = 64 << 20  # Gram matrices of answer patterns that a task keeps
_SUMMARY_SCHEMA = ("construct string, items string, n_items int, cronbach_alpha double, "
                   "mean_interitem_corr double, reliability string, source string, construct_base string")


def alpha_column(k: Column, n: Column, item_var: Column, total_var: Column) -> Column:
    alpha = k / (k - 1) * (1 - F.try_divide(item_var, total_var))
    return F.when((k >= 2) & (n >= F.greatest(F.lit(8), k + 2)) & (total_var > 0), alpha)


def set_moments(df: DataFrame, subsets: list[list[str]]) -> DataFrame:
    """``(subset, cell, value)`` of listwise sums, all sets in one scan: cell 0 the complete rows, 1 the squares of the items,
    2 the squares of their total, from 3 on the sum of every item.

    A row belongs to the pattern of the items it answers. A task sums its rows into one Gram matrix per pattern and
    then adds up, for every set, the patterns that contain it; what it holds is bounded by ``_PATTERN_BYTES``.
    """
    items = list(dict.fromkeys(i for s in subsets for i in s))
    at = {c: k for k, c in enumerate(items)}
    places = [np.array([at[i] for i in s]) for s in subsets]
    width, ends = len(items), np.cumsum([3 + len(s) for s in subsets])
    starts = np.concatenate([[0], ends[:-1]])
    values = [number_text(df, i) for i in items]
    # Shifted by the means, so that squares stay well conditioned.
    means = df.agg(F.expr("array(" + ", ".join(f"avg({v})" for v in values) + ") as m")).first()["m"]
    room = max(1, _PATTERN_BYTES // (8 * (width + 1) ** 2))

    def reduce_rows(batches):
        total, held = np.zeros(ends[-1]), {}

        def fold():
            if not held:
                return
            bits = np.array([np.frombuffer(k, np.uint8) for k in held])
            answered = np.unpackbits(bits, axis=1, count=width).astype(bool)
            grams = np.array(list(held.values()))
            for place, lo in zip(places, starts):
                above = grams[answered[:, place].all(axis=1)]
                if len(above):
                    g = above.sum(axis=0)
                    square = g[np.ix_(place + 1, place + 1)]
                    total[lo:lo + 3 + len(place)] += [g[0, 0], np.trace(square), square.sum(), *g[0, place + 1]]
            held.clear()

        for batch in batches:
            x = batch_matrix(batch, width)
            there = ~np.isnan(x)
            rows = np.column_stack([np.ones(len(x)), np.where(there, x, 0.0)])
            patterns, which = np.unique(np.packbits(there, axis=1), axis=0, return_inverse=True)
            which = which.reshape(-1)
            by = np.argsort(which, kind="stable")
            cuts = np.searchsorted(which[by], np.arange(len(patterns) + 1))
            for p, pattern in enumerate(patterns):
                part = rows[by[cuts[p]:cuts[p + 1]]]
                key = pattern.tobytes()
                held[key] = held.get(key, 0) + part.T @ part
                if len(held) >= room:
                    fold()
        fold()
        subset = np.repeat(np.arange(len(subsets)), ends - starts)
        yield pa.RecordBatch.from_arrays([pa.array(subset, pa.int32()), pa.array(np.arange(ends[-1]) - starts[subset], pa.int32()), pa.array(total)],
                                         names=["subset", "cell", "value"])

    shifted = df.selectExpr(*[f"{v} - ({m or 0.0!r}D) as _i{k}" for k, (v, m) in enumerate(zip(values, means))])
    return shifted.mapInArrow(reduce_rows, "subset int, cell int, value double").groupBy("subset", "cell").agg(F.sum("value").alias("value"))


def cronbach_alphas(df: DataFrame, subsets: list[list[str]]) -> DataFrame:
    """``(subset, items, k, n, alpha)`` for any number of item sets, in one scan."""
    def cell(k):
        return F.max(F.when(F.col("cell") == k, F.col("value")))

    sums = F.when(F.col("cell") >= 3, F.col("value"))
    moments = set_moments(df, subsets).groupBy("subset").agg(
        cell(0).cast("bigint").alias("n"), cell(1).alias("squares"), cell(2).alias("total_squares"), F.sum(sums * sums).alias("sums"), F.sum(sums).alias("total"))
    free = F.col("n") - 1
    item_var = F.try_divide(F.col("squares") - F.try_divide(F.col("sums"), F.col("n")), free)
    around = F.col("total_squares") - F.try_divide(F.col("total") * F.col("total"), F.col("n"))
    # A total that does not vary leaves only rounding.
    total_var = F.try_divide(F.when(around > 1e-12 * F.col("total_squares"), around).otherwise(F.lit(0.0)), free)
    sets = df.sparkSession.createDataFrame([(s, list(items), len(items)) for s, items in enumerate(subsets)], "subset int, items array<string>, k int")
    alpha = alpha_column(F.col("k"), F.col("n"), item_var, total_var)
    return sets.join(moments, "subset").select("subset", "items", "k", "n", alpha.alias("alpha"))


def mean_interitem(corr: DataFrame, sets: DataFrame) -> DataFrame:
    """``(subset, mean_corr)``: mean absolute correlation over the pairs of each item set.

    ``sets`` has ``(subset, items)``. The pair list per set follows from its few items, so this
    is an equi-join of two metadata-sized tables.
    """
    indexed = sets.select("subset", F.posexplode("items").alias("p", "a"), "items")
    pairs = indexed.select("subset", "a", F.explode(F.slice("items", F.col("p") + 2, F.size("items"))).alias("b"))
    keyed = pairs.select("subset", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    known = corr.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), F.abs("r").alias("r"))
    return keyed.join(known, ["lo", "hi"], "left").groupBy("subset").agg(F.avg("r").alias("mean_corr"))


def reliability_label(alpha: Column, mean_corr: Column) -> Column:
    return (F.when(alpha >= 0.80, "good").when(alpha >= 0.70, "acceptable").when(alpha >= 0.60, "exploratory")
            .when(mean_corr >= 0.45, "two_item_exploratory").otherwise("weak"))


def item_subsets(items: list[str]) -> list[list[str]]:
    """Pairs, then triples, in item order."""
    return [list(c) for size in range(2, min(3, len(items)) + 1) for c in itertools.combinations(items, size)]


def rated_subsets(df: DataFrame, subsets: list[list[str]], corr: DataFrame | None = None) -> DataFrame:
    """``(subset, items, k, n, alpha, mean_corr, reliability, score)``."""
    items = list(dict.fromkeys(i for s in subsets for i in s))
    corr = corr if corr is not None else correlations(df, items)
    alphas = cronbach_alphas(df, subsets)
    sets = df.sparkSession.createDataFrame(list(enumerate(subsets)), "subset int, items array<string>")
    rated = alphas.join(mean_interitem(corr, sets), "subset", "left")
    score = F.coalesce("alpha", F.lit(0.0)) + F.coalesce("mean_corr", F.lit(0.0)) / 2
    return rated.withColumn("reliability", reliability_label(F.col("alpha"), F.col("mean_corr"))).withColumn("score", score)


def best_subsets(rated: DataFrame, group_of: dict[int, str]) -> DataFrame:
    """Best non-weak subset per group; the earlier (smaller) subset wins ties."""
    groups = F.create_map(*[F.lit(x) for kv in group_of.items() for x in kv])
    w = Window.partitionBy("construct").orderBy(F.desc("score"), "subset")
    return (rated.where(F.col("reliability") != "weak")
            .withColumn("construct", F.element_at(groups, F.col("subset")))
            .withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank"))


_RUNNING_END = re.compile(r"(_[a-z])?(_\d+)?$")
_TWO_WORDS = re.compile(r"[a-z]+_[a-z]+")


def base_construct_name(name: str) -> str:
    """Without the running letter or number at the end: the semantic name it begins with, else its first two words, else all of it."""
    stem = _RUNNING_END.sub("", name.lower(), count=1)
    known = (semantic for semantic, _ in fv.SEMANTIC_PATTERNS if stem.startswith(semantic))
    words = _TWO_WORDS.match(stem)
    return next(known, words[0] if words else stem)


def score_column(df: DataFrame, items: list[str]) -> Column:
    """Mean of the answered items, NULL if fewer than half of them are answered."""
    values = [number(df, i) for i in items]
    answered = sum((v.isNotNull().cast("int") for v in values[1:]), values[0].isNotNull().cast("int"))
    total = sum((F.coalesce(v, F.lit(0.0)) for v in values[1:]), F.coalesce(values[0], F.lit(0.0)))
    return F.when(answered >= max(1, math.ceil(len(items) / 2)), total / answered)


def score_names(columns: list[str], constructs: list[str]) -> dict[str, str]:
    """Construct -> free column name: ``c``, ``c_score``, ``c_score_2``, ..."""
    taken = set(columns)
    out = {}
    for construct in constructs:
        candidates = itertools.chain(
            [construct, f"{construct}_score"], (f"{construct}_score_{i}" for i in itertools.count(2)))
        out[construct] = next(c for c in candidates if c not in taken)
        taken.add(out[construct])
    return out


def semantic_groups(items: list[str]) -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for item in items:
        groups.setdefault(base_construct_name(item), []).append(item)
    return groups


class ThresholdGraph:
    """Items as nodes; the strong correlations are edges that found a construct, the fair ones let a third item join."""

    STRONG, FAIR = 0.55, 0.45

    def __init__(self, items: list[str], r_abs: dict[tuple[str, str], float]):
        self.items = items
        place = {c: i for i, c in enumerate(items)}
        self.near: list[set[int]] = [set() for _ in items]
        self.edges = []  # (-r, first, second): the strongest first, then by place
        for (a, b), r in r_abs.items():
            if a in place and b in place and r >= self.FAIR:
                i, j = sorted((place[a], place[b]))
                self.near[i].add(j)
                self.near[j].add(i)
                if r >= self.STRONG:
                    self.edges.append((-r, i, j))

    def candidates(self) -> list[list[str]]:
        """Every strong pair, alone and with each item that is fair to both."""
        sets = [[i, j, *third] for _, i, j in self.edges for third in [[], *([c] for c in self.near[i] & self.near[j])]]
        return [[self.items[i] for i in s] for s in sets]

    def picks(self, used):
        """The strongest pair of unused items with the first fair third, then the next; edges of used items go when they come up."""
        heap, gone = list(self.edges), {i for i, c in enumerate(self.items) if c in used}
        heapq.heapify(heap)
        while heap:
            _, i, j = heapq.heappop(heap)
            if i in gone or j in gone:
                continue
            third = min((self.near[i] & self.near[j]) - gone, default=None)
            taken = [i, j] if third is None else [i, j, third]
            gone.update(taken)
            yield [self.items[k] for k in taken]


def detect_constructs(df: DataFrame, constructs: dict[str, list[str]] | None = None, id_columns=(),
                      mapping: dict[str, str] | None = None,
                      stats: dict[str, ColumnProfile] | None = None) -> tuple[DataFrame, DataFrame, dict[str, list[str]]]:
    """Configured, then semantic, then correlation-based constructs.

    Returns ``(scored table, construct_summary, score name -> items)``. The cluster computes one
    profile, one correlation matrix and the reliabilities of all candidate sets in one scan; the
    choice between them is made on those small results.
    """
    spark = df.sparkSession
    mapping = mapping or {}
    stats = stats or profile(df)
    id_columns = set(resolve_names(id_columns, mapping))
    fixed = {}
    slugs = slug_names(spark, list(constructs or {}))
    for name, raw in (constructs or {}).items():
        items = [i for i in resolve_names(raw, mapping) if i in stats and stats[i].numeric]
        if len(items) >= 2:
            fixed[slugs.get(name, name)] = items
    used = {i for items in fixed.values() for i in items}
    likert = [c for c in df.columns if c in stats and c not in used and is_likert_item(stats[c], id_columns)]
    groups = {g: items for g, items in semantic_groups(likert).items() if len(items) >= 2 and g not in fixed}

    needed = list(dict.fromkeys([*used, *likert]))
    if len(needed) < 2:
        return df, spark.createDataFrame([], _SUMMARY_SCHEMA), {}
    corr = hold(correlations(df, needed))
    r_abs = {(r["a"], r["b"]): abs(r["r"]) for r in corr.where("r is not null").select("a", "b", "r").collect()}
    graph = ThresholdGraph(likert, r_abs)

    owner = [("config", name, items) for name, items in fixed.items()]
    owner += [("semantic_auto", g, s) for g, items in groups.items() for s in item_subsets(items)]
    owner += [("correlation_auto", "", s) for s in graph.candidates()]
    if not owner:
        return df, spark.createDataFrame([], _SUMMARY_SCHEMA), {}
    rated = hold(rated_subsets(df, [items for _, _, items in owner], corr))
    ratings = {r["subset"]: (r["items"], r["alpha"], r["mean_corr"], r["reliability"]) for r in rated.collect()}

    chosen = [(name, *ratings[s], source) for s, (source, name, _) in enumerate(owner) if source == "config"]
    semantic = {s: name for s, (source, name, _) in enumerate(owner) if source == "semantic_auto"}
    if semantic:
        best = {r["construct"]: r["subset"] for r in best_subsets(rated.where(F.col("subset").isin(list(semantic))), semantic).collect()}
        chosen += [(g, *ratings[best[g]], "semantic_auto") for g in groups if g in best]
    used.update(i for _, items, *_ in chosen for i in items)
    found = {tuple(items): ratings[s] for s, (source, _, items) in enumerate(owner) if source == "correlation_auto"}
    for index, items in enumerate(graph.picks(used), start=1):
        rating = found[tuple(items)]
        if rating[3] == "weak":
            break
        chosen.append((f"construct_auto_{index}", *rating, "correlation_auto"))

    names = score_names(df.columns, [c[0] for c in chosen])
    scored = df.withColumns({names[c]: score_column(df, items) for c, items, *_ in chosen}) if chosen else df
    summary = spark.createDataFrame(
        [(names[c], ", ".join(items), len(items), alpha, mean_r, label, source, c)
         for c, items, alpha, mean_r, label, source in chosen], _SUMMARY_SCHEMA)
    return scored, summary, {names[c]: items for c, items, *_ in chosen}

