"""Question headers to variable names."""

import functools
import operator
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import fixed_values as fv
from ..functions.scalars import _ASCII_DIGITS, _FOREIGN_DIGITS, any_contains, has_east_asian
from ..plans.holding import hold
from .ordered import MAX_ROWS_PER_TASK, running_totals

MAX_SLUG = 64


def semantic_name(lowered: Column, east_asian: Column) -> Column:
    """Name of the first pattern with a hit in the lower-cased header, NULL if none.

    A projection: no join with the patterns. Both arguments should be plain columns, they are used
    for every pattern.
    """
    return F.coalesce(*[F.when(any_contains(lowered, needles, east_asian), F.lit(name))
                        for name, needles in fv.SEMANTIC_PATTERNS])


def with_semantic_names(df: DataFrame, header: str, name: str) -> DataFrame:
    staged = df.withColumn("_low", F.lower(header)).withColumn("_east", has_east_asian(F.col("_low")))
    return staged.withColumn(name, semantic_name(F.col("_low"), F.col("_east"))).drop("_low", "_east")


def question_number_name(header: Column) -> Column:
    """``q07`` for headers such as ``Q7`` or ``第 7``, NULL otherwise."""
    marks = "|".join(fv.QUESTION_NUMBER_MARKS)
    digits = F.regexp_extract(header, rf"(?iU)\b({marks})\s*0*(\d{{1,3}})\b", 2)
    value = F.translate(digits, _FOREIGN_DIGITS, _ASCII_DIGITS).try_cast("int")
    return F.when(digits != "", F.format_string("q%02d", value))


@F.pandas_udf(StringType())
def _fold_to_ascii(text: pd.Series) -> pd.Series:
    # NFKD has no Spark built-in.
    def fold(value):
        return unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode("ascii")
    return text.map(fold, na_action="ignore")


def with_slugs(df: DataFrame, header: str, fallback: Column, name: str) -> DataFrame:
    """Add the lower-case ASCII name of at most 64 characters of every header, or the fallback.

    The whole text is folded once; the later steps read the staged columns.
    """
    text = F.coalesce(F.col(header), F.lit(""))
    foreign = _fold_to_ascii(F.when(text.rlike(r"[^\x00-\x7F]"), text))  # plain texts go as nulls
    staged = df.withColumn("_slug", F.coalesce(foreign, text)).withColumn(
        "_slug", F.lower(F.regexp_replace("_slug", "[^0-9a-zA-Z]+", "_"))).withColumn("_slug", F.trim("_slug", F.lit("_")))
    slug = F.col("_slug")
    prefixed = F.when(slug.rlike("^[0-9]"), F.concat(F.lit("v_"), slug)).otherwise(slug)
    usable = (F.length(slug) >= 2) & ~slug.startswith("unnamed")
    cut = F.trim(F.substring(prefixed, 1, MAX_SLUG), F.lit("_"))
    return staged.withColumn(name, F.when(usable, cut).otherwise(fallback)).drop("_slug")


def position_name(position: Column) -> Column:
    return F.format_string("q%02d", position.cast("int"))


def with_base_names(df: DataFrame, header: str, position: str, name: str = "base") -> DataFrame:
    """Add the semantic name, else the question number, else the slug of every header."""
    slugged = with_slugs(df, header, position_name(F.col(position)), "_fallback")
    return with_semantic_names(slugged, header, name).withColumn(
        name, F.coalesce(F.col(name), question_number_name(F.col(header)), F.col("_fallback"))).drop("_fallback")


def unique_names(bases: list[str]) -> list[str]:
    """The base, then ``base_2``, ``base_3``, ... in order; numbers whose name is itself a base are left out."""
    bases = list(bases)
    own, last, names = set(bases), {}, []
    for base in bases:
        n = last.get(base, 0) + 1
        while n > 1 and f"{base}_{n}" in own:
            n += 1
        last[base] = n
        names.append(base if n == 1 else f"{base}_{n}")
    return names


def dedupe_names(headers: DataFrame, survey: list[str], base: str, position: str,
                 max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Add ``variable_name``: the base, then ``base_2``, ``base_3``, ... in header order; all names of a survey differ.

    ``position`` is unique within a survey. A base that fills most of a survey is counted in ranges. A number whose
    name is itself a base of the survey is left out: of the sorted taken numbers t0 < t1 < ... those come before the
    r-th use for which t_i - i <= r, so the use is moved on by as many.
    """
    headers = hold(headers)
    counted = running_totals(headers.withColumn("_one", F.lit(1).cast("bigint")), [*survey, base], position, ["_one"], max_rows)
    bases = headers.groupBy(*survey, base).agg(F.lit(1).alias("_used"))
    parts = [F.regexp_extract(F.col(base), r"(?s)^(.*)_([1-9][0-9]{0,17})$", k) for k in (1, 2)]
    taken = bases.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(survey)], parts[0].alias("_stem"), parts[1].alias("_number")).where("_number <> ''")
    taken = taken.groupBy(*[f"_k{i}" for i in range(len(survey))], "_stem").agg(F.sort_array(F.collect_list(F.col("_number").cast("bigint"))).alias("_taken"))
    same = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(survey)], F.col(base) == F.col("_stem"))
    use = F.col("cum__one")
    gaps = F.filter(F.transform(F.filter("_taken", lambda t: t > 1), lambda t, i: t - i), lambda t: t <= use)
    number = use + F.coalesce(F.size(gaps), F.lit(0))
    name = F.when(use == 1, F.col(base)).otherwise(F.concat(F.col(base), F.lit("_"), number.cast("string")))
    return counted.join(taken, same, "left").select(*headers.columns, name.alias("variable_name"))


def rename_columns(df: DataFrame, rename: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """Rename the columns of one survey; returns ``(renamed, variable_map, original -> new)``.

    A suffix that would repeat an existing name moves on to the next free one.
    """
    rename = rename or {}
    spark = df.sparkSession
    rows = [(i, c, rename.get(c)) for i, c in enumerate(df.columns, start=1)]
    table = spark.createDataFrame(rows, "position int, original_question string, requested string")
    asked = with_slugs(table, "requested", position_name(F.col("position")), "_asked")
    based = with_base_names(asked, "original_question", "position").withColumn(
        "base", F.when(F.col("requested").isNotNull(), F.col("_asked")).otherwise(F.col("base")))
    bases = [r["base"] for r in based.orderBy("position").collect()]
    names = unique_names(bases)
    mapping = dict(zip(df.columns, names))
    variable_map = spark.createDataFrame(list(zip(df.columns, names)), "original_question string, variable_name string")
    return df.toDF(*names), variable_map, mapping


def slug_names(spark, names: list[str]) -> dict[str, str]:
    """Configured names as variable names, by the same rule as headers."""
    if not names:
        return {}
    table = spark.createDataFrame(list(enumerate(names, start=1)), "position int, name string")
    return {r["name"]: r["slug"] for r in with_slugs(table, "name", position_name(F.col("position")), "slug").collect()}


def resolve_table(names: DataFrame, name: str, variable_map: DataFrame) -> DataFrame:
    """``names`` with ``resolved``: the variable name where ``name`` is a question of the map, else the name itself.

    Of several rows of one question the smallest variable name holds; a missing name stays missing. Questions meet by
    their SHA-256: the map's texts stay where they are, and names that are missing go after the grouping, where they are
    values. Before it the optimizer would move their filter to the scan and work out every name there twice, its steps anew at each use.
    """
    known = variable_map.where("original_question is not null").groupBy(F.sha2("original_question", 256).alias("_question")).agg(
        F.min("variable_name").alias("_variable")).where("_variable is not null")
    return names.join(known, F.sha2(F.col(name), 256) == F.col("_question"), "left").select(
        *names.columns, F.coalesce("_variable", F.col(name)).alias("resolved"))


def resolve_names(names, mapping: dict[str, str]) -> list[str]:
    """Names from a configuration may be question texts or variable names."""
    return [mapping.get(n, n) for n in names]
