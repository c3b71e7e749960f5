"""The figures a report quotes, as one long table ``(section, fact, place, name, value)``."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .describe import ranking_top


def _facts(t: DataFrame, section: str, fact: str, value: Column, place=None, name=None) -> DataFrame:
    return t.select(
        F.lit(section).alias("section"), F.lit(fact).alias("fact"),
        (F.lit(1) if place is None else place).cast("int").alias("place"),
        (F.lit("") if name is None else name).cast("string").alias("name"), value.cast("double").alias("value"))


def _ranked(t: DataFrame, section: str, fact: str, by: Column, value: Column, name: Column, n: int) -> DataFrame:
    """Top ``n`` by a total order: a bounded top-k, then numbered."""
    top = t.select(by.alias("_by"), value.alias("_v"), name.alias("_n")).orderBy(F.desc_nulls_last("_by"), "_n").limit(n)
    rows = top.agg(F.sort_array(F.collect_list(F.struct((-F.col("_by")).alias("o"), F.col("_n").alias("n"), F.col("_v").alias("v")))).alias("r"))
    numbered = rows.select(F.posexplode("r").alias("p", "r"))
    return _facts(numbered, section, fact, F.col("r.v"), F.col("p") + 1, F.col("r.n"))


def sample_facts(raw_rows: int, valid_rows: int, df: DataFrame) -> DataFrame:
    one = df.sparkSession.createDataFrame([(raw_rows, valid_rows)], "raw bigint, valid bigint")
    return (_facts(one, "sample", "raw_rows", F.col("raw")).unionByName(_facts(one, "sample", "valid_rows", F.col("valid")))
            .unionByName(_facts(one, "sample", "valid_rate", F.try_divide(F.col("valid"), F.col("raw")))))


def count_facts(t: DataFrame, section: str, p: str | None = "approx_p") -> DataFrame:
    """Number of results and of those below p = 0.05."""
    flagged = F.count(F.when(F.col(p) < 0.05, 1)) if p else F.lit(0)
    c = t.agg(F.count(F.lit(1)).alias("c"), flagged.alias("f"))
    out = _facts(c, section, "results", F.col("c"))
    return out.unionByName(_facts(c, section, "significant", F.col("f"))) if p else out


def strongest_associations(independence: DataFrame, n: int = 3) -> DataFrame:
    return _ranked(independence, "independence", "strongest", F.abs("effect_size"), F.col("effect_size"),
                   F.concat_ws(" vs ", "variable_a", "variable_b"), n)


def strongest_terms(coefficients: DataFrame, section: str = "regression", n: int = 5) -> DataFrame:
    t = coefficients.where(F.col("term") != "intercept")
    return _ranked(t, section, "strongest", F.abs("standardized_beta"), F.col("standardized_beta"), F.col("term"), n)


def report_facts(tables: dict[str, DataFrame], raw_rows: int, valid_rows: int, scored: DataFrame) -> DataFrame:
    """Facts of whichever result tables are given."""
    parts = [sample_facts(raw_rows, valid_rows, scored)]

    def has(name):
        return name in tables

    for name in ("randomness_tests", "independence_tests"):
        if has(name):
            parts.append(count_facts(tables[name], name.removesuffix("_tests")))
    if has("independence_tests"):
        t = tables["independence_tests"]
        parts.append(strongest_associations(t))
        parts.append(count_facts(t.where((F.col("variable_a") == "segment") | (F.col("variable_b") == "segment")), "segment_tests"))
    for name, section in (("construct_summary", "constructs"), ("descriptives", "descriptives"), ("variable_map", "variables"),
                          ("mediation", "mediation"), ("moderation", "moderation")):
        if has(name):
            parts.append(count_facts(tables[name], section, None))
    if has("purchase_question_distributions"):
        c = tables["purchase_question_distributions"].groupBy("chart_type").agg(F.countDistinct("variable").alias("c"))
        parts.append(_facts(c, "purchase", "questions", F.col("c"), name=F.col("chart_type")))
    if has("mediation"):
        c = tables["mediation"].agg(F.count(F.when(F.col("supported"), 1)).alias("c"))
        parts.append(_facts(c, "mediation", "supported", F.col("c")))
    if has("regression_coefficients"):
        parts.append(strongest_terms(tables["regression_coefficients"]))
    if has("regression_fit"):
        for fact in ("n", "r2", "adj_r2"):
            parts.append(_facts(tables["regression_fit"], "regression", fact, F.col(fact), name=F.col("outcome")))
    if has("moderation"):
        parts.append(strongest_terms(tables["moderation"], "moderation"))
    if has("segment_profiles"):
        t = tables["segment_profiles"]
        parts.append(_ranked(t, "segments", "largest", F.col("share"), F.col("share"), F.col("persona"), 2))
    if has("conjoint_importance"):
        t = tables["conjoint_importance"]
        parts.append(_ranked(t, "conjoint", "importance", F.col("relative_importance"), F.col("relative_importance"), F.col("attribute"), 10))
    if has("psm_summary"):
        parts.append(_facts(tables["psm_summary"], "pricing", "metric", F.col("value"), name=F.col("metric")))
    if has("ranking_summary"):
        top = ranking_top(tables["ranking_summary"])
        parts.append(_facts(top, "ranking", "top_brand", F.col("mean_rank"), F.col("place"), F.concat_ws(":", "dimension", "brand")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
