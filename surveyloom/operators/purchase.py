"""Purchase questions: selection, multi-select groups, single-question distributions."""

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed_values as fv
from ..functions.scalars import any_contains, strip
from .describe import MAX_LEVELS, quantile_bins, top_levels_per_key
from .headers import resolve_names
from .profile import (ColumnProfile, is_binary_selection, is_id_like, label, level_frequencies,
                      number, profile)

DISTRIBUTION_SCHEMA = ("variable string, original_question string, level_order int, level string, count bigint, "
                       "percent double, chart_type string, source_variable string, respondent_n bigint, "
                       "respondent_percent double")


def mentions_purchase(variable: Column, question: Column) -> Column:
    return any_contains(F.lower(F.concat_ws(" ", variable, question)), fv.PURCHASE_QUESTION_HINTS)


def purchase_questions(variable_map: DataFrame, stats: dict[str, ColumnProfile], configured=(),
                       outcome: str | None = None, mapping: dict[str, str] | None = None, id_columns=(),
                       max_questions: int | None = None) -> list[tuple[str, str]]:
    """``(variable, question)`` in header order up to ``max_questions`` (None: all), then all configured ones, then the outcome."""
    rows = variable_map.withColumn("hit", mentions_purchase(F.col("variable_name"), F.col("original_question"))).collect()
    named = [name for name in resolve_names(configured, mapping or {}) if name in stats]
    if outcome in stats and outcome in {r["variable_name"] for r in rows}:
        named.append(outcome)

    def asked(v):
        return not is_id_like(stats[v], id_columns) and stats[v].count >= 5 and stats[v].distinct >= 2

    found = {r["variable_name"]: r["original_question"] for r in rows if r["hit"] and r["variable_name"] in stats and asked(r["variable_name"])}
    kept = dict(list(found.items())[:max_questions])
    for name in named:
        if asked(name):
            kept.setdefault(name, found.get(name, name))
    return list(kept.items())


def split_stem(question: Column) -> tuple[Column, Column]:
    """``(stem, option)`` at the last occurrence of the first separator that leaves both sides non-empty."""
    text = strip(question)
    stem, option = text, F.lit("")
    for separator in reversed(fv.STEM_SEPARATORS):
        last = F.substring_index(text, separator, -1)
        left, right = strip(F.substring(text, F.lit(1), F.length(text) - F.length(last) - len(separator))), strip(last)
        fits = F.contains(text, F.lit(separator)) & (left != "") & (right != "")
        stem = F.when(fits, left).otherwise(stem)
        option = F.when(fits, right).otherwise(option)
    return stem, option


def stems(variable_map: DataFrame) -> DataFrame:
    stem, option = split_stem(F.col("original_question"))
    return variable_map.withColumn("stem", stem).withColumn("option", option)


def common_prefix(variables: list[str], fallback: str) -> str:
    # Whole snake parts: the shared characters, cut at an underscore.
    return os.path.commonprefix([f"{v}_" for v in variables]).rpartition("_")[0] or fallback


def multi_select(df: DataFrame, groups: dict[str, tuple[str, list[tuple[str, str]]]]) -> DataFrame:
    """Distribution of multi-select groups: ``group id -> (stem, [(variable, option), ...])``.

    One aggregation for all groups. Options nobody chose are dropped.
    """
    structs = []
    for group, (stem, items) in groups.items():
        answered = F.lit(False)
        for v, _ in items:
            answered = answered | label(df, v).isNotNull()
        for order, (v, option) in enumerate(items):
            selected = F.lower(strip(label(df, v))).isin(*fv.SELECTED_VALUES)
            structs.append(F.struct(
                F.lit(group).alias("variable"), F.lit(stem).alias("original_question"), F.lit(order).alias("item"),
                F.lit(option).alias("level"), F.count(F.when(selected, 1)).alias("count"), F.lit(v).alias("source_variable"),
                F.count(F.when(answered, 1)).alias("respondent_n")))
    t = df.agg(F.array(*structs).alias("s")).select(F.inline("s")).where(F.col("count") > 0)
    w = Window.partitionBy("variable")  # one row per option
    return t.select(
        "variable", "original_question", F.row_number().over(w.orderBy("item")).alias("level_order"), "level", "count",
        (F.col("count") / F.sum("count").over(w)).alias("percent"), F.lit("multi_select_group").alias("chart_type"),
        "source_variable", "respondent_n", F.try_divide(F.col("count"), F.col("respondent_n")).alias("respondent_percent"))


def single_questions(df: DataFrame, questions: list[tuple[str, str]], stats: dict[str, ColumnProfile]) -> DataFrame:
    """Distribution of the other questions: quantile bins above 12 values, else the top 20 levels."""
    if not questions:
        return df.sparkSession.createDataFrame([], DISTRIBUTION_SCHEMA)
    wide = [v for v, _ in questions if stats[v].numeric and stats[v].distinct > 12]
    plain = [v for v, _ in questions if v not in wide]
    parts = []
    if plain:
        parts.append(top_levels_per_key(level_frequencies(df, plain), ["variable"], MAX_LEVELS).select(
            "variable", "level_order", "level", "count", "percent"))
    if wide:
        bins = quantile_bins(df, wide, 6)
        text = F.concat(F.lit("("), F.col("bin_lo").cast("string"), F.lit(", "), F.col("bin_hi").cast("string"), F.lit("]"))
        parts.append(bins.select("variable", F.col("bin").alias("level_order"), text.alias("level"), "count", "percent"))
    t = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    asked = F.create_map(*[F.lit(x) for v, q in questions for x in (v, q)])
    answers = F.create_map(*[x for v, _ in questions for x in (F.lit(v), F.lit(stats[v].count).cast("bigint"))])
    return t.select(
        "variable", F.element_at(asked, F.col("variable")).alias("original_question"), "level_order", "level", "count",
        "percent", F.lit("single_question").alias("chart_type"), F.col("variable").alias("source_variable"),
        F.element_at(answers, F.col("variable")).alias("respondent_n"), F.col("percent").alias("respondent_percent"))


def question_distributions(df: DataFrame, variable_map: DataFrame, questions: list[tuple[str, str]],
                           stats: dict[str, ColumnProfile]) -> DataFrame:
    """Multi-select groups (options with one stem) and single questions in one table."""
    split = {r["variable_name"]: r for r in stems(variable_map).collect()}
    by_stem: dict[str, list[tuple[str, str]]] = {}
    for v, r in split.items():
        if v in stats and r["option"] and is_binary_selection(stats[v]):
            by_stem.setdefault(r["stem"], []).append((v, r["option"]))
    groups: dict[str, tuple[str, list[tuple[str, str]]]] = {}
    grouped: set[str] = set()
    for stem in dict.fromkeys(split[v]["stem"] for v, _ in questions if v in split):
        items = by_stem.get(stem, [])
        if len(items) < 2:
            continue
        index = len(groups) + 1
        group = common_prefix([v for v, _ in items], f"multi_select_{index}")
        if group in groups or group in grouped:
            group = f"{group}_{index}"
        groups[group] = (stem, items)
        grouped.update(v for v, _ in items)
    singles = single_questions(df, [(v, q) for v, q in questions if v not in grouped], stats)
    return multi_select(df, groups).unionByName(singles) if groups else singles


def pie_stops(distributions: DataFrame) -> DataFrame:
    """Start and end of every slice in percent. A variable has at most 20 levels."""
    w = Window.partitionBy("variable").orderBy("level_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("percent") * 100).over(w)
    return distributions.select("variable", "level_order", "level", (end - F.col("percent") * 100).alias("start"), end.alias("end"))


def top_levels(distributions: DataFrame, n: int = 3) -> DataFrame:
    w = Window.partitionBy("variable").orderBy(F.desc("percent"), "level_order")
    return distributions.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n).select(
        "variable", "place", "level", "percent")
