"""Outcome and predictors of the models."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from .models import named_or_scored
from .moments import correlations
from .profile import ColumnProfile


def choose_outcome(columns: list[str], configured: str | None = None) -> str | None:
    for name in ([f"{configured}_score", configured] if configured else []) + ["purchase_intention_score"]:
        if name in columns:
            return name
    for hints in (("purchase_intention",), fv.OUTCOME_HINTS):
        for c in columns:
            if any(h in c.lower() for h in hints):
                return c
    return None


def predictor_candidates(columns: list[str], outcome: str, constructs: dict[str, list[str]],
                         stats: dict[str, ColumnProfile]) -> list[str]:
    """Product-related constructs, topped up by product-related columns that are no items."""
    def product(c):
        return c != outcome and stats[c].numeric and any(h in c.lower() for h in fv.PRODUCT_HINTS)
    items = {i for group in constructs.values() for i in group}
    found = [c for c in constructs if c in stats and product(c)]
    if len(found) < 2:
        found += [c for c in columns if c in stats and c not in items and c not in found and product(c)]
    return found or [c for c in constructs if c != outcome]


def rank_predictors(df: DataFrame, outcome: str, candidates: list[str], n: int = 12) -> DataFrame:
    """``(variable, n, abs_r)`` of the strongest candidates with at least eight shared rows."""
    pairs = correlations(df, [outcome, *candidates]).where(F.col("a") == outcome)
    return (pairs.where((F.col("n") >= 8) & F.col("r").isNotNull())
            .select(F.col("b").alias("variable"), "n", F.abs("r").alias("abs_r"), F.col("j").alias("position"))
            .orderBy(F.desc("abs_r"), "position").limit(n))


def choose_predictors(df: DataFrame, outcome: str | None, constructs: dict[str, list[str]],
                      stats: dict[str, ColumnProfile], configured=()) -> list[str]:
    fixed = named_or_scored(configured, df.columns)
    if fixed or not outcome:
        return fixed
    candidates = predictor_candidates(df.columns, outcome, constructs, stats)
    if not candidates:
        return []
    return [r["variable"] for r in rank_predictors(df, outcome, candidates).collect()]
