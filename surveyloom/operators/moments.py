"""Cross-product sums: the one pass that correlations and all linear models share.

Each task reduces its rows to a few small matrices with BLAS; Spark adds them up. What leaves a
task depends on the number of columns only.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import finite_sql, sql_name, text_array
from .profile import number_text

_PAIR_SCHEMA = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
_GRAM_SCHEMA = "spec int, cell int, value double"
_FLAT = 1e-12  # relative spread below which a column counts as constant


def batch_matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Rows x columns with NaN for NULL."""
    return np.column_stack([
        batch.column(k).to_numpy(zero_copy_only=False).astype(np.float64) for k in range(width)
    ]) if width else np.empty((batch.num_rows, 0))


def centred(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns shifted and scaled by their own mean and deviation: keeps the sums well conditioned."""
    values = {c: finite_sql(number_text(df, c)) for c in columns}
    stats = df.agg(F.expr("array(" + ", ".join(
        f"named_struct('m', avg({v}), 's', stddev_pop({v}))" for v in values.values()) + ") as s")).first()["s"]
    return df.selectExpr(*[f"({v} - ({s['m'] or 0.0!r}D)) / {s['s'] or 1.0!r}D as {sql_name(c)}"
                           for (c, v), s in zip(values.items(), stats)])


def pairwise_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(a, b, n, sx, sy, sxx, syy, sxy)`` over the rows where both columns are present."""
    width = len(columns)

    def reduce_rows(batches):
        n = np.zeros((width, width))
        s, ss, p = np.zeros_like(n), np.zeros_like(n), np.zeros_like(n)
        for batch in batches:
            x = batch_matrix(batch, width)
            mask = ~np.isnan(x)
            x = np.where(mask, x, 0.0)
            mask = mask.astype(np.float64)
            n += mask.T @ mask
            s += x.T @ mask
            ss += (x * x).T @ mask
            p += x.T @ x
        i, j = np.triu_indices(width, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32())]
            + [pa.array(v) for v in (n[i, j], s[i, j], s[j, i], ss[i, j], ss[j, i], p[i, j])],
            names=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    partial = centred(df, columns).mapInArrow(reduce_rows, _PAIR_SCHEMA)
    names = text_array(columns)
    sums = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    total = partial.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in sums])
    return total.select("i", "j", F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), *sums)


def pearson(moments: DataFrame) -> DataFrame:
    """Add ``r``; NULL where a column does not vary on the shared rows."""
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    vx = n * F.col("sxx") - sx * sx
    vy = n * F.col("syy") - sy * sy
    flat = (vx <= _FLAT * n * F.col("sxx")) | (vy <= _FLAT * n * F.col("syy"))
    r = F.try_divide(n * F.col("sxy") - sx * sy, F.sqrt(vx * vy))
    return moments.withColumn("r", F.when(~flat, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Long form ``(i, j, a, b, n, r)`` with ``a`` before ``b`` in column order."""
    return pearson(pairwise_moments(df, columns)).select(
        "i", "j", "a", "b", F.col("n").cast("bigint").alias("n"), "r")


def correlation_square(long: DataFrame, columns: list[str]) -> DataFrame:
    """Square matrix as a table: ``variable`` and one column per variable."""
    upper = long.select(F.col("a").alias("__row"), F.col("b").alias("__column"), F.col("r").alias("__r"))
    both = upper.unionByName(upper.select(F.col("__column").alias("__row"), F.col("__row").alias("__column"), "__r"))
    # A column without spread correlates with nothing, itself included.
    own = both.groupBy("__row").agg(F.when(F.count("__r") > 0, F.lit(1.0)).alias("__own"))
    wide = both.groupBy("__row").pivot("__column", columns).agg(F.first("__r")).join(own, "__row")
    cells = [F.when(F.col("__row") == c, F.col("__own")).otherwise(F.col(f"`{c}`")).alias(c) for c in columns]
    return wide.select(F.col("__row").alias("variable"), *cells)


def gram_matrices(df: DataFrame, columns: dict[str, Column], specs: list[list[tuple[str, ...]]]) -> list[np.ndarray]:
    """Listwise Gram matrix of ``[1, term, term, ...]`` for every spec, all specs in one pass.

    A term is a tuple of column names whose product it is. A row counts for a spec only if all
    its terms are finite.
    """
    names = list(columns)
    at = {c: k for k, c in enumerate(names)}
    plan = [[[at[c] for c in term] for term in spec] for spec in specs]

    def reduce_rows(batches):
        grams = [np.zeros((len(spec) + 1, len(spec) + 1)) for spec in plan]
        for batch in batches:
            x = batch_matrix(batch, len(names))
            for k, spec in enumerate(plan):
                a = np.column_stack([np.ones(len(x))] + [np.prod(x[:, term], axis=1) for term in spec])
                a = a[np.isfinite(a).all(axis=1)]
                grams[k] += a.T @ a
        spec_ids = np.concatenate([np.full(g.size, k) for k, g in enumerate(grams)])
        cells = np.concatenate([np.arange(g.size) for g in grams])
        yield pa.RecordBatch.from_arrays(
            [pa.array(spec_ids, pa.int32()), pa.array(cells, pa.int32()),
             pa.array(np.concatenate([g.ravel() for g in grams]))],
            names=["spec", "cell", "value"])

    projected = df.select(*[c.cast("double").alias(f"c{k}") for k, c in enumerate(columns.values())])
    sums = projected.mapInArrow(reduce_rows, _GRAM_SCHEMA).groupBy("spec", "cell").agg(F.sum("value").alias("value"))
    grams = [np.zeros((len(spec) + 1, len(spec) + 1)) for spec in specs]
    for row in sums.collect():
        grams[row["spec"]].flat[row["cell"]] = row["value"]
    return grams
