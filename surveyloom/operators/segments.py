"""Segmentation: K-means, silhouette, segment profiles and personas."""

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed_values as fv
from ..functions.scalars import any_contains, sql_name, sql_text
from ..plans.holding import hold
from .clean import imputed_columns
from .moments import batch_matrix
from .profile import ColumnProfile, is_id_like, level_frequencies, number_text, variable_matches
from .rounds import TASK_CELLS, Exchange, iterated

MIN_SHARE = 0.05
MAX_K = 6
DETAILS_SCHEMA = ("`{segment}` {kind}, `group` string, variable string, summary_type string, segment_value double, overall_value double, "
                  "delta_or_index double, top_category string, segment_share double, overall_share double")


# --- clustering ---------------------------------------------------------------------------


def cluster_features(stats: dict[str, ColumnProfile], candidates: list[str]) -> list[str]:
    """Numeric candidates that at least 60 % of the rows answered."""
    return [c for c in dict.fromkeys(candidates) if c in stats and stats[c].numeric and stats[c].filled >= 0.60]


def counted_points(z: DataFrame, features: list[str]) -> DataFrame:
    """``(features, weight)``: equal rows collapse at every size, so start rows are drawn from different points."""
    return z.groupBy(*features).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def start_rows(points: DataFrame, features: list[str], n: int, seed: int) -> np.ndarray:
    """``n`` rows drawn in proportion to their weight, the same ones in every run.

    The smallest exponential arrival times, so this is one bounded top-k.
    """
    u = (F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{f}`") for f in features]), F.lit(1 << 52)) + 1) / F.lit(float(1 << 52) + 1)
    arrival = -F.log(u) / F.col("weight")
    rows = points.select(*[F.col(f"`{f}`").cast("double") for f in features], arrival.alias("_t")).orderBy("_t").limit(n)
    return rows.drop("_t").toPandas().to_numpy(dtype=float)


def _sweep(x: np.ndarray, weight: np.ndarray, fits: list[np.ndarray], exchange: Exchange) -> tuple[list[np.ndarray], list[np.ndarray], list[float]]:
    """One pass over the points for all fits: per center the coordinate sums and the weight, per fit the cost."""
    width = x.shape[1]
    centers = np.vstack(fits)
    ends = np.cumsum([len(c) for c in fits])
    starts = ends - [len(c) for c in fits]
    norms = (centers * centers).sum(axis=1)
    sums = np.zeros((len(centers), width + 2))
    step = max(1, 4_000_000 // len(centers))
    for first in range(0, len(x), step):
        part, w = x[first:first + step], weight[first:first + step]
        distance = (part * part).sum(axis=1)[:, None] - 2.0 * (part @ centers.T) + norms
        member = np.zeros_like(distance)
        line = np.arange(len(part))
        for lo, hi in zip(starts, ends):
            member[line, lo + distance[:, lo:hi].argmin(axis=1)] = w
        sums[:, :width] += member.T @ part
        sums[:, width] += member.sum(axis=0)
        sums[:, width + 1] += (member * np.maximum(distance, 0.0)).sum(axis=0)
    total = exchange.total(sums)
    parts = [total[lo:hi] for lo, hi in zip(starts, ends)]
    return [p[:, :width] for p in parts], [p[:, width] for p in parts], [float(p[:, width + 1].sum()) for p in parts]


def fit_kmeans(points: DataFrame, features: list[str], k: int, restarts: int = 10, seed: int = 42,
               max_iter: int = 100, starts: list[np.ndarray] | None = None) -> tuple[np.ndarray, float]:
    """Best of several random starts, or of the given ones: ``(centers, inertia)``."""
    return fit_many(points, features, [k], restarts, seed, max_iter, {k: starts} if starts else None)[k]


def fit_many(points: DataFrame, features: list[str], ks: list[int], restarts: int = 10, seed: int = 42,
             max_iter: int = 100, starts: dict[int, list[np.ndarray]] | None = None,
             task_cells: int = TASK_CELLS) -> dict[int, tuple[np.ndarray, float]]:
    """K-means for every k and restart at once: ``{k: (centers, inertia)}`` with the lowest inertia.

    All fits and iterations are one job over points that stay in their tasks; an iteration of all
    ``len(ks) * restarts`` fits shares one pass, and a fit that has settled leaves the sweep. ``starts``
    gives the first centers of every k instead of random rows.
    """
    names = [f"f{j}" for j in range(len(features))]
    table = hold(points.select(*[F.col(f"`{f}`").cast("double").alias(n) for f, n in zip(features, names)], F.col("weight").cast("double").alias("weight")))
    pool = start_rows(table, names, restarts * sum(ks), seed)
    rng = np.random.default_rng(seed)
    # A fit starts from k different rows; empty clusters move to another row of the pool.
    first = {(k, r): c for k, given in starts.items() for r, c in enumerate(given)} if starts else {
        (k, r): pool[rng.choice(len(pool), size=min(k, len(pool)), replace=False)] for k in ks for r in range(restarts)}
    width, draws = len(names), rng.integers(0, len(pool), 4096)

    def lloyd(rows: np.ndarray, exchange: Exchange) -> np.ndarray:
        x, weight, drawn = rows[:, :width], rows[:, width], 0
        active, best = dict(first), {}

        def settle(k, centers, cost):
            if k not in best or cost < best[k][1]:
                best[k] = (centers, cost)

        for _ in range(max_iter):
            if not active:
                break
            sums, weights, costs = _sweep(x, weight, list(active.values()), exchange)
            for (key, centers), s, w, cost in zip(list(active.items()), sums, weights, costs):
                spare = pool[draws[(drawn + np.arange(len(w))) % len(draws)]]
                drawn += int((w <= 0).sum())
                moved = np.where(w[:, None] > 0, s / np.where(w > 0, w, 1.0)[:, None], spare)
                if np.abs(moved - centers).max() <= 1e-9:
                    settle(key[0], centers, cost)
                    del active[key]
                else:
                    active[key] = moved
        if active:
            for (k, _), centers, cost in zip(active, active.values(), _sweep(x, weight, list(active.values()), exchange)[2]):
                settle(k, centers, cost)
        return np.concatenate([np.concatenate([[len(best[k][0]), best[k][1]], best[k][0].ravel()]) for k in sorted(best)])

    flat, found = iterated(table, table.count(), lloyd, task_cells), {}
    for k in sorted({key[0] for key in first}):
        size = int(flat[0])
        found[k], flat = (flat[2:2 + size * width].reshape(size, width), float(flat[1])), flat[2 + size * width:]
    return found


def nearest_center(features: list[str], centers: np.ndarray) -> Column:
    """1-based index of the closest center; ties go to the lower index. Stays in generated code."""
    structs = []
    for i, c in enumerate(centers, start=1):
        terms = " + ".join(f"({sql_name(f)} - ({float(v)!r}D)) * ({sql_name(f)} - ({float(v)!r}D))" for f, v in zip(features, c))
        structs.append(f"struct({terms} as d, {i} as segment)")
    return F.expr(f"least({', '.join(structs)}).segment" if len(structs) > 1 else "1")


def ordered_centers(points: DataFrame, features: list[str], centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centers by cluster size, then by coordinates, and the sizes: labels that a rerun repeats."""
    nearest = nearest_center(features, centers)
    sizes = {r["s"]: r["w"] for r in points.groupBy(nearest.alias("s")).agg(F.sum("weight").alias("w")).collect()}
    order = sorted((i for i in range(len(centers)) if sizes.get(i + 1)),
                   key=lambda i: (-sizes[i + 1], tuple(np.round(centers[i], 9))))
    return centers[order], np.array([sizes[i + 1] for i in order])


def silhouette(points: DataFrame, features: list[str], centers: np.ndarray, anchors: DataFrame) -> DataFrame:
    """Euclidean silhouette of the anchor rows against all points: one row ``(silhouette, anchors)``.

    ``anchors`` holds at most some hundred rows; they travel with the task. A task returns one
    sum per anchor and cluster.
    """
    width = len(features)
    columns = [F.col(f"`{f}`") for f in features]
    sample = anchors.select(*columns, nearest_center(features, centers).alias("segment")).toPandas().to_numpy(dtype=float)
    anchor_x, anchor_c = sample[:, :width], sample[:, width].astype(int)
    k = len(centers)

    def reduce_rows(batches):
        sums, sizes = np.zeros((len(anchor_x), k)), np.zeros(k)
        for batch in batches:
            rows = batch_matrix(batch, width + 2)
            x, weight, cluster = rows[:, :width], rows[:, width], rows[:, width + 1].astype(int) - 1
            member = np.zeros((len(rows), k))
            member[np.arange(len(rows)), cluster] = weight
            step = max(1, 4_000_000 // max(1, x.size))
            for start in range(0, len(anchor_x), step):
                diff = anchor_x[start:start + step, None, :] - x[None, :, :]
                sums[start:start + step] += np.sqrt((diff * diff).sum(axis=2)) @ member
            sizes += member.sum(axis=0)
        a, c = np.divmod(np.arange(sums.size), k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int32()), pa.array(c + 1, pa.int32()), pa.array(sums.ravel()), pa.array(sizes[c])],
            names=["anchor", "cluster", "distance", "size"])

    labelled = points.select(*columns, "weight", nearest_center(features, centers).alias("segment"))
    sums = labelled.mapInArrow(reduce_rows, "anchor int, cluster int, distance double, size double").groupBy(
        "anchor", "cluster").agg(F.sum("distance").alias("distance"), F.sum("size").alias("size"))
    own = F.get(F.array(*[F.lit(int(c)) for c in anchor_c]), F.col("anchor"))
    is_own = F.col("cluster") == own
    per_anchor = sums.withColumn("own", own).groupBy("anchor").agg(
        F.max(F.when(is_own, F.col("size"))).alias("own_size"),
        F.max(F.when(is_own, F.try_divide(F.col("distance"), F.col("size") - 1))).alias("a"),
        F.min(F.when(~is_own & (F.col("size") > 0), F.col("distance") / F.col("size"))).alias("b"))
    top = F.greatest("a", "b")
    score = F.when(top > 0, (F.col("b") - F.col("a")) / top).otherwise(F.lit(0.0))
    return per_anchor.where((F.col("own_size") > 1) & F.col("b").isNotNull()).agg(
        F.avg(score).alias("silhouette"), F.count(F.lit(1)).alias("anchors"))


def anchor_rows(z: DataFrame, row_id: str, n: int = 500, seed: int = 42) -> DataFrame:
    """A fixed pseudo-random set of rows: the smallest hashes of the row id."""
    return z.orderBy(F.xxhash64(F.lit(seed), F.col(row_id)), F.col(row_id)).limit(n)


def choose_k(candidates: list[tuple[int, float, float | None]], wanted: int | None = None) -> int | None:
    """``(k, smallest share, silhouette)`` -> k: the wanted one, else the better of 4 and 3, else the best."""
    usable = {k: s if s is not None else -999.0 for k, share, s in candidates if share >= MIN_SHARE}
    if not usable:
        return None
    if wanted in usable:
        return wanted
    preferred = [k for k in (3, 4) if k in usable]  # the smaller one of equals
    return max(preferred or sorted(usable), key=lambda k: usable[k])


def select_k(z: DataFrame, features: list[str], row_id: str, wanted: int | None = None, restarts: int = 10,
             seed: int = 42, max_points: int = 500, max_iter: int = 100, starts: dict[int, list[np.ndarray]] | None = None,
             anchors: DataFrame | None = None) -> tuple[DataFrame, np.ndarray, float | None]:
    """Candidate table ``(k, inertia, min_share, silhouette, selected)``, chosen centers, silhouette.

    ``starts`` gives the candidates and their first centers, ``anchors`` the rows of the silhouette.
    """
    points = hold(counted_points(z, features))
    rows = points.agg(F.sum("weight")).first()[0] or 0
    ks = sorted(starts) if starts else list(range(2, min(MAX_K, max(2, int(rows) // 20)) + 1))
    anchors = hold(anchors if anchors is not None else anchor_rows(z, row_id, max_points, seed))
    fits = fit_many(points, features, ks, restarts, seed, max_iter, starts)

    def rate(k):
        centers, sizes = ordered_centers(points, features, fits[k][0])
        share = float(sizes.min() / sizes.sum()) if len(sizes) == k else 0.0
        score = silhouette(points, features, centers, anchors).first()["silhouette"] if len(centers) > 1 else None
        return k, centers, float(fits[k][1]), share, score

    with ThreadPoolExecutor(max_workers=4) as pool:
        rated = list(pool.map(rate, ks))
    chosen = choose_k([(k, share, score) for k, _, _, share, score in rated], wanted) or 2
    table = z.sparkSession.createDataFrame(
        [(k, inertia, share, score, k == chosen) for k, _, inertia, share, score in rated],
        "k int, inertia double, min_share double, silhouette double, selected boolean")
    centers, score = next((c, s) for k, c, _, _, s in rated if k == chosen)
    return table, centers, score


def assign_segments(z: DataFrame, features: list[str], centers: np.ndarray, row_id: str) -> DataFrame:
    return z.select(row_id, nearest_center(features, centers).alias("segment"))


def with_segment(df: DataFrame, columns: dict[str, Column], centers: np.ndarray) -> DataFrame:
    """``df`` with the segment whose center is nearest to the given columns, one of the same name replaced."""
    base = df.drop("segment")
    places = [f"_z{i}" for i in range(len(columns))]
    staged = base.select("*", *[c.alias(p) for p, c in zip(places, columns.values())])
    return staged.select(*[F.col(f"`{c}`") for c in base.columns], nearest_center(places, centers).alias("segment"))


def join_segments(df: DataFrame, assignments: DataFrame, row_id: str) -> DataFrame:
    """Segments back on the rows; unclustered rows keep NULL."""
    base = df.drop("segment") if "segment" in df.columns else df
    return base.join(assignments.select(row_id, "segment"), row_id, "left")


# --- profiles -----------------------------------------------------------------------------


def segment_means(df: DataFrame, segment: str, features: list[str]) -> DataFrame:
    """``(segment, feature, size, mean, overall_mean, overall_sd, z)``.

    One pass over the rows; the overall figures are pooled from the per-segment ones.
    """
    structs = ", ".join(
        f"named_struct('feature', {sql_text(f)}, 'n', count({v}), 'mean', avg({v}), 'sd', stddev_pop({v}))"
        for f, v in ((f, number_text(df, f)) for f in features))
    rows = df.groupBy(segment).agg(F.expr("count(1) as size"), F.expr(f"array({structs}) as s")).select(
        segment, "size", F.inline("s"))
    w = Window.partitionBy("feature")  # one row per segment
    n = F.sum("n").over(w)
    rows = rows.withColumn("overall_mean", F.try_divide(F.sum(F.col("n") * F.col("mean")).over(w), n))
    gap = F.col("mean") - F.col("overall_mean")
    spread = F.sum(F.col("n") * (F.col("sd") * F.col("sd") + gap * gap)).over(w)
    rows = rows.withColumn("overall_sd", F.sqrt(F.try_divide(spread, n)))
    z = F.try_divide(F.col("mean") - F.col("overall_mean"), F.col("overall_sd"))
    return rows.where(F.col(segment).isNotNull()).select(
        segment, "feature", "size", "mean", "overall_mean", "overall_sd", z.alias("z"))


def feature_strings(means: DataFrame, segment: str) -> DataFrame:
    """``(segment, high_features_z, low_features_z, high_text, low_text)``.

    The texts feed the persona rules: strong names among the top four and bottom three.
    """
    high = Window.partitionBy(segment).orderBy(F.desc_nulls_last("z"), "feature")
    low = Window.partitionBy(segment).orderBy(F.asc_nulls_last("z"), "feature")
    t = means.withColumn("h", F.row_number().over(high)).withColumn("l", F.row_number().over(low))
    shown = F.format_string("%s=%.2f", "feature", "z")

    def joined(rank, limit, strong, text, separator):
        rows = F.sort_array(F.collect_list(F.when(strong & (F.col(rank) <= limit), F.struct(rank, text.alias("t")))))
        return F.array_join(F.transform(rows, lambda r: r["t"]), separator)

    up, down = F.col("z") > 0.25, F.col("z") < -0.25
    name = F.lower("feature")
    t = t.groupBy(segment).agg(
        joined("h", 5, up, shown, "; ").alias("high"), joined("l", 3, down, shown, "; ").alias("low"),
        joined("h", 4, up, name, " ").alias("high_text"), joined("l", 3, down, name, " ").alias("low_text"))
    return t.select(
        segment, F.when(F.col("high") == "", fv.NO_HIGH_FEATURES).otherwise(F.col("high")).alias("high_features_z"),
        F.when(F.col("low") == "", fv.NO_LOW_FEATURES).otherwise(F.col("low")).alias("low_features_z"),
        "high_text", "low_text")


def persona_label(high: Column, low: Column) -> Column:
    def has(text, *tokens):
        return any_contains(text, tokens)
    support = fv.PERSONA_SUPPORT_TOKENS
    return (F.when(has(high, "purchase") & has(high, *support), fv.PERSONA_LABELS["advocate"])
            .when(has(low, "purchase") & has(low, *support), fv.PERSONA_LABELS["sceptic"])
            .when(has(high, "risk"), fv.PERSONA_LABELS["risk"])
            .when(has(high, "purchase", "satisfaction"), fv.PERSONA_LABELS["potential"])
            .when(has(high, "brand", "trust"), fv.PERSONA_LABELS["brand"])
            .when(has(high, "feature", "quality"), fv.PERSONA_LABELS["product"])
            .when(has(high, "price", "value"), fv.PERSONA_LABELS["value"])
            .otherwise(fv.PERSONA_LABELS["balanced"]))


def profile_groups(stats: dict[str, ColumnProfile], configured: dict[str, list[str]] | None = None,
                   constructs=(), predictors=(), outcome: str | None = None, id_columns=(),
                   max_variables: int | None = 18) -> dict[str, list[str]]:
    """Basic, behaviour and cognitive variables: all configured ones, then by hints up to ``max_variables`` each (None: all)."""
    configured = configured or {}
    hints = {"basic": fv.BASIC_HINTS, "behavior": fv.BEHAVIOR_HINTS, "cognitive": fv.COGNITIVE_HINTS}
    seeds = {*constructs, *predictors, outcome}
    groups = {}
    for group, words in hints.items():
        named = [c for c in configured.get(group, []) if c in stats]
        names = named + [c for c, p in stats.items() if not is_id_like(p, id_columns)
                  and (variable_matches(c, words) or (group == "cognitive" and c in seeds))]
        fit = [c for c in dict.fromkeys(names) if stats[c].filled >= 0.20 and stats[c].distinct > 1]
        groups[group] = fit[:None if max_variables is None else max(max_variables, sum(c in named for c in fit))]
    return groups


def persona_details(df: DataFrame, segment: str, groups: dict[str, list[str]], stats: dict[str, ColumnProfile],
                    force_numeric=()) -> DataFrame:
    """Numeric means against the overall, top two levels with share and lift, per segment and variable."""
    force = set(force_numeric)
    names = list(dict.fromkeys(c for cols in groups.values() for c in cols))
    measured = [c for c in names if stats[c].numeric and (c in force or stats[c].distinct > 12)]
    counted = [c for c in names if c not in measured]
    parts = []
    none = F.lit(None).cast("double")
    if measured:
        m = segment_means(df.where(F.col(segment).isNotNull()), segment, measured).where(F.col("mean").isNotNull())
        parts.append(m.select(
            segment, F.col("feature").alias("variable"), F.lit("numeric_mean").alias("summary_type"),
            F.col("mean").alias("segment_value"), F.col("overall_mean").alias("overall_value"),
            F.col("z").alias("delta_or_index"), F.lit("").alias("top_category"),
            none.alias("segment_share"), none.alias("overall_share")))
    if counted:
        freq = hold(level_frequencies(df.where(F.col(segment).isNotNull()), counted, [segment]))
        overall = freq.groupBy("variable", "level").agg(F.sum("n").alias("all_n"))
        totals = overall.groupBy("variable").agg(F.sum("all_n").alias("all_total"))
        sizes = freq.groupBy(segment, "variable").agg(F.sum("n").alias("total"))
        top = Window.partitionBy(segment, "variable").orderBy(F.desc("n"), "level")
        first = freq.withColumn("rn", F.row_number().over(top)).where("rn <= 2")
        t = first.join(sizes, [segment, "variable"]).join(overall, ["variable", "level"]).join(totals, "variable")
        share, base = F.col("n") / F.col("total"), F.col("all_n") / F.col("all_total")
        parts.append(t.select(
            segment, "variable", F.lit("category_share").alias("summary_type"), none.alias("segment_value"),
            none.alias("overall_value"), F.try_divide(share, base).alias("delta_or_index"),
            F.col("level").alias("top_category"), share.alias("segment_share"), base.alias("overall_share")))
    if not parts:
        return df.sparkSession.createDataFrame([], DETAILS_SCHEMA.format(segment=segment, kind=df.schema[segment].dataType.simpleString()))
    details = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    members = df.sparkSession.createDataFrame(
        [(g, c) for g, cols in groups.items() for c in cols], "group string, variable string")
    return details.join(F.broadcast(members), "variable").select(  # at most 3 x 18 rows
        segment, "group", "variable", "summary_type", "segment_value", "overall_value", "delta_or_index",
        "top_category", "segment_share", "overall_share")


def persona_info(details: DataFrame, segment: str) -> DataFrame:
    """``(segment, group, info)``: four strongest means, four strongest levels, six parts at most."""
    numeric = details.where(F.col("summary_type") == "numeric_mean")
    w = Window.partitionBy(segment, "group").orderBy(F.desc_nulls_last(F.abs("delta_or_index")), "variable")
    means = numeric.withColumn("place", F.row_number().over(w)).where("place <= 4").select(
        segment, "group", "place",
        F.format_string("%s均值%.2f(整体%.2f)", "variable", "segment_value", "overall_value").alias("part"))
    levels = details.where(F.col("summary_type") == "category_share")
    over = F.max((F.col("delta_or_index") >= 1).cast("int")).over(Window.partitionBy(segment, "group"))
    strength = F.abs(F.col("delta_or_index") - 1)
    levels = levels.withColumn("any_over", over).where((F.col("any_over") == 0) | (F.col("delta_or_index") >= 1))
    one = Window.partitionBy(segment, "group", "variable").orderBy(F.desc_nulls_last(strength), "top_category")
    best = Window.partitionBy(segment, "group").orderBy(F.desc_nulls_last(strength), "variable")
    levels = levels.withColumn("rn", F.row_number().over(one)).where("rn = 1").withColumn(
        "place", F.row_number().over(best)).where("place <= 4").select(
        segment, "group", (F.col("place") + 4).alias("place"),
        F.format_string("%s偏向“%s”(%.1f%%, 整体%.1f%%)", F.col("variable"), F.col("top_category"),
                        F.col("segment_share") * 100, F.col("overall_share") * 100).alias("part"))
    parts = means.unionByName(levels).groupBy(segment, "group").agg(
        F.sort_array(F.collect_list(F.struct("place", "part"))).alias("p"))
    text = F.array_join(F.transform(F.slice("p", 1, 6), lambda r: r["part"]), "；")
    return parts.select(segment, "group", text.alias("info"))


def segment_profiles(df: DataFrame, segment: str, features: list[str], details: DataFrame,
                     silhouette_score: float | None = None, names: dict[str, str] | None = None) -> DataFrame:
    """One row per segment: size, share, persona, info strings, strong features, means."""
    means = hold(segment_means(df, segment, features))
    strings = feature_strings(means, segment).withColumn("persona", persona_label(F.col("high_text"), F.col("low_text")))
    if names:
        given = F.create_map(*[F.lit(x) for k, v in names.items() for x in (str(k), v)])
        strings = strings.withColumn("persona", F.coalesce(
            F.try_element_at(given, F.col(segment).cast("string")), F.col("persona")))
    wide = means.groupBy(segment).pivot("feature", features).agg(F.first("mean"))
    wide = wide.select(segment, *[F.col(f"`{f}`").alias(f"mean_{f}") for f in features])
    sizes = means.groupBy(segment).agg(F.first("size").alias("size"))
    share = F.col("size") / F.sum("size").over(Window.partitionBy(F.lit(1)))  # one row per segment
    info = persona_info(details, segment).groupBy(segment).pivot("group", ["basic", "behavior", "cognitive"]).agg(F.first("info"))
    t = sizes.withColumn("share", share).join(strings, segment).join(info, segment, "left").join(wide, segment)
    return t.select(
        segment, "size", "share", "persona",
        *[F.coalesce(g, F.lit(fv.NO_PROFILE_INFO)).alias(f"{g}_info") for g in ("basic", "behavior", "cognitive")],
        "high_features_z", "low_features_z", F.lit(silhouette_score).cast("double").alias("silhouette"),
        *[f"mean_{f}" for f in features])


def persona_strategy(text: Column) -> Column:
    rule = None
    for tokens, strategy in fv.STRATEGY_RULES:
        hit = any_contains(text, tokens)
        rule = F.when(hit, F.lit(strategy)) if rule is None else rule.when(hit, F.lit(strategy))
    return rule.otherwise(F.lit(fv.STRATEGY_DEFAULT))


def persona_summary(profiles: DataFrame, segment: str = "segment") -> DataFrame:
    """Presentation table, one row per segment."""
    text = F.concat_ws(" ", "persona", "behavior_info", "cognitive_info", "high_features_z", "low_features_z")
    return profiles.select(
        F.format_string("第%d类", F.col(segment).cast("int")).alias("类型编号"), F.col("persona").alias("消费者类型"),
        F.col("size").alias("样本量"), F.format_string("%.2f%%", F.col("share") * 100).alias("占比"),
        F.col("basic_info").alias("基础信息"), F.col("behavior_info").alias("行为信息"),
        F.col("cognitive_info").alias("认知信息"), F.col("high_features_z").alias("核心区分特征"),
        persona_strategy(text).alias("策略定位"))


def run_segmentation(df: DataFrame, row_id: str, features: list[str], groups: dict[str, list[str]],
                     stats: dict[str, ColumnProfile], force_numeric=(), wanted: int | None = None,
                     names: dict[str, str] | None = None, restarts: int = 10, seed: int = 42) -> dict[str, DataFrame]:
    """Assignments, profiles, persona details and summary; empty when there is too little to cluster."""
    rows = next(iter(stats.values())).rows if stats else 0
    if len(features) < 2 or rows < 30:
        return {}
    columns = imputed_columns(df, features)
    if len(columns) < 2:
        return {}
    z = hold(df.select(row_id, *[c.alias(f) for f, c in columns.items()]))
    table, centers, score = select_k(z, list(columns), row_id, wanted, restarts, seed)
    # The segment is a function of the row: a projection, no join back.
    joined = with_segment(df, columns, centers)
    assignments = joined.select(row_id, "segment")
    details = hold(persona_details(joined, "segment", groups, stats, {*features, *force_numeric}))
    profiles = hold(segment_profiles(joined, "segment", features, details, score, names))
    return {"assignments": assignments, "profiles": profiles, "details": details,
            "summary": persona_summary(profiles), "candidates": table, "joined": joined}
