"""Tail probabilities for the (small) test-result tables."""

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def erfc(x: pd.Series) -> pd.Series:
    # Spark has no erf/erfc. Only result tables pass through here: one row per test.
    return x.map(math.erfc, na_action="ignore").astype("float64")


def normal_p(z: Column) -> Column:
    """Two-sided normal p value."""
    return erfc(F.abs(z) / math.sqrt(2.0))


def chi_square_p(statistic: Column, df: Column) -> Column:
    """Upper chi-square tail by the Wilson-Hilferty normal approximation."""
    inv = F.try_divide(F.lit(2.0), 9.0 * df)
    z = (F.pow(F.try_divide(statistic, df), 1.0 / 3.0) - (1.0 - inv)) / F.sqrt(inv)
    tail = 0.5 * erfc(F.when((statistic > 0) & (df > 0), z / math.sqrt(2.0)))
    return F.when((df > 0) & (statistic <= 0), F.lit(1.0)).otherwise(tail)


def verdict(p: Column, yes: str, no: str) -> Column:
    return F.when(p < 0.05, F.lit(yes)).otherwise(F.lit(no))
