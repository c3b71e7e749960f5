"""Standardised regression, mediation and moderation from one pass of cross-product sums."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import fixed_values as fv
from ..functions.scalars import finite, text_structs
from .clean import encode_predictors, zscore_column
from .moments import batch_matrix, gram_matrices
from .profile import ColumnProfile, number, profiles_of

COEFFICIENT_SCHEMA = ("outcome string, term string, standardized_beta double, std_error double, "
                      "t_or_z double, approx_p double")
MODERATION_SCHEMA = ("term string, standardized_beta double, std_error double, t_or_z double, approx_p double, "
                     "predictor string, moderator string, outcome string, n bigint, r2 double")
MEDIATION_SCHEMA = ("predictor string, mediator string, outcome string, n bigint, a_path double, "
                    "indirect_effect double, direct_effect double, boot_ci_low double, boot_ci_high double, "
                    "supported boolean")
_SINGULAR = 1e-10


def solve_standardized(gram: np.ndarray) -> dict | None:
    """Coefficients from the Gram matrix of ``[1, x..., y]`` with y standardised on its own rows.

    Minimum-norm solution, so a full set of dummies next to the intercept is fine.
    """
    n, width = gram[0, 0], gram.shape[0] - 1
    if width < 2 or n < max(12, width - 1 + 4):
        return None
    mean = gram[0, -1] / n
    var = gram[-1, -1] / n - mean * mean
    if var <= 1e-14 * max(1.0, gram[-1, -1] / n):
        return None
    xtx = gram[:-1, :-1]
    xty = (gram[:-1, -1] - mean * gram[:-1, 0]) / math.sqrt(var)
    inverse = np.linalg.pinv(xtx, rcond=_SINGULAR, hermitian=True)
    beta = inverse @ xty
    df_resid = max(1.0, n - width)
    sse = max(0.0, n - float(beta @ xty))
    r2 = 1 - sse / n
    se = np.sqrt(np.maximum(np.diag(sse / df_resid * inverse), 0.0))
    with np.errstate(divide="ignore", invalid="ignore"):
        t = beta / se
    return {"n": int(n), "r2": float(r2), "adj_r2": float(1 - (1 - r2) * (n - 1) / df_resid), "beta": beta, "se": se, "t": t}


def _number_or_none(v: float) -> float | None:
    return float(v) if np.isfinite(v) else None


def coefficient_rows(fit: dict, terms: list[str]) -> list[tuple]:
    rows = []
    for k, term in enumerate(["intercept", *terms]):
        t = fit["t"][k]
        p = math.erfc(abs(t) / math.sqrt(2)) if np.isfinite(t) else None
        rows.append((term, float(fit["beta"][k]), float(fit["se"][k]), _number_or_none(t), p))
    return rows


def fit_ols(df: DataFrame, outcome: str, design: dict, stats: dict[str, ColumnProfile] | None = None) -> tuple[list[tuple], dict]:
    """Coefficient rows and fit facts; ``design`` holds ready-made (standardised) columns."""
    stats = profiles_of(df, [outcome], stats)[outcome]
    y = zscore_column(finite(number(df, outcome)), stats.mean, stats.std_pop)
    if not design or not stats.std_pop:
        return [], {"n": 0, "r2": None, "adj_r2": None}
    columns = {f"x{k}": c for k, c in enumerate(design.values())} | {"y": y}
    gram = gram_matrices(df, columns, [[(c,) for c in columns]])[0]
    fit = solve_standardized(gram)
    if fit is None:
        return [], {"n": int(gram[0, 0]), "r2": None, "adj_r2": None}
    return coefficient_rows(fit, list(design)), {k: fit[k] for k in ("n", "r2", "adj_r2")}


def run_regression(df: DataFrame, outcome: str | None, predictors: list[str],
                   stats: dict[str, ColumnProfile] | None = None) -> tuple[DataFrame, dict]:
    spark = df.sparkSession
    if not outcome or outcome not in df.columns:
        return spark.createDataFrame([], COEFFICIENT_SCHEMA), {"n": 0, "r2": None, "adj_r2": None}
    rows, meta = fit_ols(df, outcome, encode_predictors(df, predictors, stats), stats)
    return spark.createDataFrame([(outcome, *r) for r in rows], COEFFICIENT_SCHEMA), meta


def named_or_scored(names, columns) -> list[str]:
    """Configured names; the construct score wins over the plain column."""
    out = []
    for n in names:
        if f"{n}_score" in columns:
            out.append(f"{n}_score")
        elif n in columns:
            out.append(n)
    return out


def choose_moderators(df: DataFrame, outcome: str, configured, constructs: list[str]) -> list[str]:
    chosen = named_or_scored(configured, df.columns)
    if chosen:
        return chosen
    return [c for c in [*constructs, *df.columns]
            if c != outcome and any(h in c.lower() for h in fv.MODERATOR_HINTS)]


def run_moderation(df: DataFrame, outcome: str | None, predictors: list[str], moderators: list[str],
                   max_predictors: int | None = None, max_moderators: int | None = None,
                   stats: dict[str, ColumnProfile] | None = None) -> DataFrame:
    """``y ~ z(x) + z(w) + z(x) z(w)`` for every pair; all pairs share one pass over the rows."""
    spark = df.sparkSession
    pairs = list(dict.fromkeys(
        (x, w) for x in predictors[:max_predictors] for w in moderators[:max_moderators] if x != w))
    names = list(dict.fromkeys([outcome, *[c for p in pairs for c in p]])) if outcome and pairs else []
    stats = profiles_of(df, [c for c in names if c in df.columns], stats)
    pairs = [(x, w) for x, w in pairs if x in stats and w in stats and stats[x].numeric and stats[w].numeric]
    if not pairs:
        return spark.createDataFrame([], MODERATION_SCHEMA)
    used = list(dict.fromkeys([outcome, *[c for p in pairs for c in p]]))
    columns = {c: zscore_column(finite(number(df, c)), stats[c].mean, stats[c].std_pop) for c in used}
    specs = [[(x,), (w,), (x, w), (outcome,)] for x, w in pairs]
    rows = []
    for (x, w), gram in zip(pairs, gram_matrices(df, columns, specs)):
        fit = solve_standardized(gram)
        if fit:
            interaction = coefficient_rows(fit, [x, w, f"{x}_x_{w}"])[-1]
            rows.append((*interaction, x, w, outcome, fit["n"], fit["r2"]))
    return spark.createDataFrame(rows, MODERATION_SCHEMA)


# --- mediation ------------------------------------------------------------------------

# Upper ends of the Poisson(1) distribution function on the 64-bit integers.
POISSON_ENDS = np.array(
    [min(2**64 - 1, int(sum(1 / math.factorial(i) for i in range(k + 1)) / math.e * 2**64)) for k in range(12)],
    dtype=np.uint64)


def poisson_weights(keys: np.ndarray, draws: int, seed: int) -> np.ndarray:
    """Rows x draws resampling weights that depend on the row key, the draw and the seed only.

    So a weight is the same in whatever partition, batch or attempt its row is read.
    """
    step = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64)[:, None] * np.uint64(0xD1342543DE82EF95) \
            + (np.arange(1, draws + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1_000_003))[None, :] * step
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    weights = np.zeros(z.shape, dtype=np.float64)
    for end in POISSON_ENDS:
        weights += z >= end
    return weights


_DRAW_SUMS = ["sw", "sx", "sm", "sy", "sxx", "smm", "syy", "sxm", "sxy", "smy"]


def mediation_sums(df: DataFrame, paths: list[tuple[str, str, str]], row_id: str, draws: int, seed: int,
                   stats: dict[str, ColumnProfile] | None = None) -> DataFrame:
    """``(path, draw, sw, sx, ..., smy)``: draw 0 is the sample itself.

    One pass for all paths and draws. A task sends ``paths * (draws + 1)`` rows, whatever its size.
    """
    names = list(dict.fromkeys(c for p in paths for c in p))
    stats = profiles_of(df, names, stats)
    at = {c: k for k, c in enumerate(names)}
    index = [[at[c] for c in p] for p in paths]
    width = len(names)

    def reduce_rows(batches):
        total = np.zeros((draws + 1, 10 * len(index)))
        for batch in batches:
            values = batch_matrix(batch, width)
            keys = batch.column(width).to_numpy(zero_copy_only=False)
            for start in range(0, len(values), 4096):
                x = values[start:start + 4096]
                blocks = []
                for path in index:
                    p = x[:, path]
                    ok = np.isfinite(p).all(axis=1)
                    p = np.where(ok[:, None], p, 0.0)
                    a, m, y = p.T
                    blocks.append(np.column_stack([ok.astype(float), a, m, y, a * a, m * m, y * y, a * m, a * y, m * y]))
                table = np.hstack(blocks)
                weights = poisson_weights(keys[start:start + 4096], draws, seed)
                total[0] += table.sum(axis=0)
                total[1:] += weights.T @ table
        paths_out = np.tile(np.arange(len(index)), draws + 1)
        draws_out = np.repeat(np.arange(draws + 1), len(index))
        flat = total.reshape(-1, 10)
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths_out, pa.int32()), pa.array(draws_out, pa.int32())]
            + [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(10)],
            names=["path", "draw", *_DRAW_SUMS])

    columns = [zscore_column(finite(number(df, c)), stats[c].mean, stats[c].std_pop or 1.0).alias(c) for c in names]
    # A whole number is its own key; any other row id is hashed.
    whole = isinstance(df.schema[row_id].dataType, T.IntegralType)
    rows = df.select(*columns, (F.col(row_id).cast("long") if whole else F.xxhash64(F.col(row_id))).alias("_key"))
    schema = "path int, draw int, " + ", ".join(f"{c} double" for c in _DRAW_SUMS)
    return rows.mapInArrow(reduce_rows, schema).groupBy("path", "draw").agg(*[F.sum(c).alias(c) for c in _DRAW_SUMS])


def mediation_effects(sums: DataFrame) -> DataFrame:
    """Standardised a path, b path, direct and indirect effect per ``(path, draw)``."""
    n = F.col("sw")

    def cov(ab, a, b):
        return n * F.col(ab) - F.col(a) * F.col(b)

    vx, vm, vy = cov("sxx", "sx", "sx"), cov("smm", "sm", "sm"), cov("syy", "sy", "sy")
    flat = (vx <= 1e-12 * n * F.col("sxx")) | (vm <= 1e-12 * n * F.col("smm")) | (vy <= 1e-12 * n * F.col("syy"))
    rows = sums.select(
        "path", "draw", "sw",
        F.when(~flat, F.try_divide(cov("sxm", "sx", "sm"), F.sqrt(vx * vm))).alias("r_xm"),
        F.when(~flat, F.try_divide(cov("sxy", "sx", "sy"), F.sqrt(vx * vy))).alias("r_xy"),
        F.when(~flat, F.try_divide(cov("smy", "sm", "sy"), F.sqrt(vm * vy))).alias("r_my"),
    )
    free = 1 - F.col("r_xm") * F.col("r_xm")
    free = F.when(free > 1e-12, free)
    b = (F.col("r_my") - F.col("r_xm") * F.col("r_xy")) / free
    direct = (F.col("r_xy") - F.col("r_xm") * F.col("r_my")) / free
    return rows.select("path", "draw", "sw", F.col("r_xm").alias("a_path"), b.alias("b_path"),
                       direct.alias("direct_effect"), (F.col("r_xm") * b).alias("indirect_effect"))


def mediation_paths(df: DataFrame, outcome: str, predictors: list[str], mediators: list[str],
                    max_predictors: int | None = None, max_mediators: int | None = None,
                    stats: dict[str, ColumnProfile] | None = None) -> list[tuple[str, str, str]]:
    stats = profiles_of(df, [c for c in dict.fromkeys([*predictors, *mediators]) if c in df.columns], stats)
    mediators = [m for m in mediators if m not in predictors and m in stats and stats[m].numeric]
    return [(x, m, outcome) for x in predictors[:max_predictors] for m in mediators[:max_mediators]
            if x in stats and stats[x].numeric]


def run_mediation(df: DataFrame, paths: list[tuple[str, str, str]], row_id: str,
                  draws: int = 300, seed: int = 42, stats: dict[str, ColumnProfile] | None = None) -> DataFrame:
    """Indirect effects with percentile intervals from a Poisson bootstrap."""
    if not paths:
        return df.sparkSession.createDataFrame([], MEDIATION_SCHEMA)
    effects = mediation_effects(mediation_sums(df, paths, row_id, draws, seed, stats))
    is_draw = F.col("draw") > 0
    drawn = F.when(is_draw, F.col("indirect_effect"))

    def point(name):
        return F.max(F.when(~is_draw, F.col(name)))

    # At most ``draws`` values per path enter the percentile.
    per_path = effects.groupBy("path").agg(
        point("sw").cast("bigint").alias("n"), point("a_path").alias("a_path"),
        point("indirect_effect").alias("indirect_effect"), point("direct_effect").alias("direct_effect"),
        F.count(drawn).alias("_valid"), F.percentile(drawn, F.array(F.lit(0.025), F.lit(0.975))).alias("_ci"),
    ).where((F.col("n") >= 30) & (F.col("_valid") >= max(20, draws // 5)))
    named = text_structs(paths, ["predictor", "mediator", "outcome"])
    low, high = F.col("_ci")[0], F.col("_ci")[1]
    return per_path.withColumn("_p", F.get(named, F.col("path"))).select(
        "_p.predictor", "_p.mediator", "_p.outcome", "n", "a_path", "indirect_effect", "direct_effect",
        low.alias("boot_ci_low"), high.alias("boot_ci_high"), ((low > 0) | (high < 0)).alias("supported"))


def top_drivers(coefficients: DataFrame, n: int = 5, coefficient: str = "standardized_beta") -> DataFrame:
    """Strongest terms with the direction of their effect."""
    strength = F.abs(F.col(coefficient))
    w = Window.partitionBy("outcome").orderBy(F.desc(strength), "term")
    return (coefficients.where(F.col("term") != "intercept")
            .withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)
            .withColumn("direction", F.when(F.col(coefficient) > 0, "positive").otherwise("negative")))
