"""Choice and rating conjoint on counted attribute profiles."""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed_values as fv
from ..functions.scalars import finite
from ..plans.holding import hold
from .clean import dummy_columns, sorted_levels, zscore_column
from .models import fit_ols
from .profile import ColumnProfile, all_levels, is_id_like, number, profile
from .rounds import TASK_CELLS, Exchange, iterated

CHOICE_SCHEMA = "term string, utility double, attribute string"
RATING_SCHEMA = "term string, utility double, std_error double, t_or_z double, approx_p double, attribute string"


def detect_structure(stats: dict[str, ColumnProfile], chosen: str | None = None, rating: str | None = None,
                     attributes=(), exclude=(), id_columns=(), max_attributes: int | None = 10) -> tuple[str | None, str | None, list[str]]:
    """``(chosen, rating, attributes)`` as configured or by column name; of unnamed attributes the first ``max_attributes`` (None: all)."""
    chosen = chosen or next((c for c in fv.CHOSEN_COLUMNS if c in stats), None)
    rating = rating or next((c for c in fv.RATING_COLUMNS if c in stats), None)
    attributes = [a for a in attributes if a]
    if not attributes and (chosen or rating):
        left_out = {chosen, rating, *exclude}
        attributes = [p.name for p in stats.values() if p.name not in left_out
                      and 2 <= p.distinct <= 20 and not is_id_like(p, id_columns)][:max_attributes]
    return chosen, rating, attributes


def choice_profile_counts(df: DataFrame, chosen: str, attributes: list[str]) -> DataFrame:
    """``(attributes, n, n_chosen)``: all that a choice model needs to know of the rows."""
    y = finite(number(df, chosen))
    return df.where(y.isNotNull()).groupBy(*attributes).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("n_chosen"))


def attribute_design(df: DataFrame, attributes: list[str], stats: dict[str, ColumnProfile],
                     levels: dict[str, list[str]] | None = None) -> tuple[dict[str, Column], dict[str, list[str]]]:
    """All dummies per attribute; a number with more than eight values is one z-scored term."""
    design: dict[str, Column] = {}
    groups: dict[str, list[str]] = {}
    for a in attributes:
        p = stats[a]
        if p.numeric and p.distinct > 8:
            terms = {a: zscore_column(finite(number(df, a)), p.mean, p.std_pop)}
        else:
            names = (levels or {}).get(a) or all_levels(df, p)
            terms = dummy_columns(df, a, sorted_levels(df, a, names), drop_first=False)
        design.update(terms)
        groups[a] = list(terms)
    return design, groups


def fit_choice(profiles: DataFrame, design: dict[str, Column], rate: float = 0.08, steps: int = 2500,
               l2: float = 0.001, task_cells: int = TASK_CELLS) -> np.ndarray:
    """L2-penalised logistic utilities (intercept free) by full-batch steps from zero.

    The counted profiles are the sufficient statistic; all steps run in one job over them.
    """
    table = profiles.select(*[c.cast("double").alias(f"x{k}") for k, c in enumerate(design.values())],
                            F.col("n").cast("double").alias("n"), F.col("n_chosen").cast("double").alias("y"))
    width = len(design)
    table = hold(table.dropna().groupBy(*[f"x{k}" for k in range(width)]).agg(F.sum("n").alias("n"), F.sum("y").alias("y")))
    size, total = table.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not size:
        return np.array([])

    def descend(rows: np.ndarray, exchange: Exchange) -> np.ndarray:
        x = np.column_stack([np.ones(len(rows)), rows[:, :width]])
        n, chosen, beta = rows[:, width], rows[:, width + 1], np.zeros(width + 1)
        for _ in range(steps):
            expected = n / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            gradient = exchange.total(x.T @ (expected - chosen)) / total
            gradient[1:] += l2 * beta[1:]
            beta = beta - rate * gradient
        return beta

    return iterated(table, size, descend, task_cells)


def attribute_importance(utilities: DataFrame) -> DataFrame:
    """Utility range per attribute and its share of all ranges."""
    ranges = utilities.where(F.col("attribute") != "model").groupBy("attribute").agg(
        (F.max("utility") - F.min("utility")).alias("utility_range"))
    # One row per attribute.
    total = F.sum("utility_range").over(Window.partitionBy(F.lit(1)))
    return ranges.withColumn("relative_importance", F.try_divide(F.col("utility_range"), total))


def run_conjoint(df: DataFrame, chosen: str | None = None, rating: str | None = None, attributes=(), exclude=(),
                 id_columns=(), stats: dict[str, ColumnProfile] | None = None, steps: int = 2500,
                 max_attributes: int | None = 10) -> tuple[DataFrame, DataFrame, str]:
    """``(utilities, importance, kind)``; kind is choice, rating or none."""
    spark = df.sparkSession
    stats = stats or profile(df)
    chosen, rating, attributes = detect_structure(stats, chosen, rating, attributes, exclude, id_columns, max_attributes)
    attributes = [a for a in attributes if a in stats]
    nothing = spark.createDataFrame([], CHOICE_SCHEMA)
    target = chosen if chosen in stats else rating if rating in stats else None
    if not target or not attributes:
        return nothing, attribute_importance(nothing), "none"
    if target == chosen:
        if stats[chosen].distinct < 2:
            return nothing, attribute_importance(nothing), "none"
        profiles = hold(choice_profile_counts(df, chosen, attributes))
        design, groups = attribute_design(profiles, attributes, stats)
        beta = fit_choice(profiles, design, steps=steps)
        if not len(beta):
            return nothing, attribute_importance(nothing), "none"
        rows = [(term, float(b)) for term, b in zip(["intercept", *design], beta)]
        schema, kind = CHOICE_SCHEMA, "choice"
    else:
        design, groups = attribute_design(df, attributes, stats)
        rows, _ = fit_ols(df, rating, design)
        schema, kind = RATING_SCHEMA, "rating"
    owner = {t: a for a, terms in groups.items() for t in terms}
    utilities = spark.createDataFrame([(*r, owner.get(r[0], "model")) for r in rows], schema)
    return utilities, attribute_importance(utilities), kind if rows else "none"
