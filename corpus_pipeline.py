"""The training-data pipeline: five stages over ``documents``, each written and read again before the next."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm import bpe, decontaminate, langid, repeats, simhash
from surveyloom.llm.common import settle, table

#: A text whose shortest code is no shorter than plain bytes is in none of the languages.
MOST_BITS = 8.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter or in none of the learned languages go; ``lang`` becomes the predicted language."""
    return langid.relabel(docs, langid.training_rows(docs), MOST_BITS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_first(docs)


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes go, at whole characters; ``n_chars`` follows."""
    return repeats.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items go, and documents that are half of them or more; ``n_chars`` follows."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).withColumn("n_chars", F.length("text").cast("long"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, and digests of ids and decoded bytes."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).drop("tag")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeat_dedup),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: one row per kept document with its ids and digests.

    Null, empty, blank and letterless texts go with the first stage. Of repeated rows and of near-duplicates the first stays (the
    smallest id, missing ids before all). Long texts are processed whole. Other columns travel along up to the last stage, also
    where operators use their names. An empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
