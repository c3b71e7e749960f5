import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i} of{i % 7}" for i in range(30000))
SENTENCES = ["The quick brown fox jumps over the lazy dog near the old river bank today.", "Nobody knows why the seven ships left the harbour before the storm came in."]

#: Nulls, empty and blank texts, letterless ones, a very long one, repeated rows, equal ids with other texts, missing ids, line and control characters.
AWKWARD = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "12 34 !!", "en", None, 8), (5, LONG, "en", "a", len(LONG)),
    (6, SENTENCES[0], None, "a", 70), (6, SENTENCES[0], None, "a", 70), (7, SENTENCES[0], "en", "b", 70), (7, SENTENCES[1] + "\n" + SENTENCES[1], "en", "b", 140),
    (None, SENTENCES[1] + " É漢字😀\x00\x1c\u2028.", "fr", "b", 80), (None, None, None, None, None), (8, "é" * 260, "fr", "b", 260), (9, "x" * 500 + " y", "de", "b", 502), (10, "x" * 500, "de", "b", 500),
]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(awkward):
    """Extra columns with names that operators use themselves."""
    from pyspark.sql import functions as F
    for name in ("tag", "n_words", "kept", "score", "fp", "root", "starts", "ids", "row", "part", "words", "lines", "good", "hashes", "held_out", "block", "at", "key"):
        awkward = awkward.withColumn(name, F.lit(7))
    return awkward


@pytest.fixture(scope="session")
def benchmark_rows(spark):
    schema = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
    return spark.createDataFrame([(2, SENTENCES[0]), (10, "seven ships left"), (1, SENTENCES[0]), (3, None), (4, "--"), (None, "the harbour"), (10, "seven ships left")], schema)
