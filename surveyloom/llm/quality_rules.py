"""Line-first quality rules, in DataFrame functions only.

Every line with a word is judged by punctuation, navigation and boilerplate rules; failing lines are
removed, and a document that loses too much of its text so is rejected. The base figures (word
characters, symbols, repeated lines, repeated word windows) are counted beside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
LEAST_WORDS = 20
#: Percent of the words in repeated windows, and share of the characters in removed lines, beyond which a document goes.
MOST_REPEATED, MOST_LOST = 30, 0.4
SYMBOLS = "#*$%&|<>"
#: Punctuation rule: share of marks among a line's characters, and words below which a line has to end like a sentence.
MARKS, MOST_MARKS, SHORT_WORDS = SYMBOLS + "!~^_=+{}[]@\\", 0.08, 4
#: Navigation rule: this many separators between short entries.
SEPARATORS = 3

SENTENCE_END = r"""[.!?…。！？:;,"'”’»)\]]\s*$"""
SHORT = r"^\s*(\S+\s+){0,%d}\S+\s*$" % (SHORT_WORDS - 2)
NAVIGATION = r"^\s*([^|›»·•]{0,60}[|›»·•]){%d,}" % SEPARATORS
# Phrases of notices, consent banners, page furniture and filler text.
BOILERPLATE = (
    r"(?i)licensed under the|all rights reserved|copyright (©|\(c\)|\d{4})|©\s*\d{4}|terms (of (use|service)|and conditions)|privacy policy|cookie (policy|settings|consent)"
    r"|(use|uses|accept) (of )?cookies|enable javascript|javascript is (disabled|required)|subscribe to our newsletter|sign up for our|click here to"
    r"|skip to (main )?content|back to top|powered by wordpress|lorem ipsum|share (this )?on (facebook|twitter)|all trademarks"
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def line_fails(line: Column) -> Column:
    """Whether a line with a word breaks a rule."""
    marks = (F.char_length(line) - F.char_length(F.translate(line, MARKS, ""))) > MOST_MARKS * F.char_length(line)
    unfinished = line.rlike(SHORT) & ~line.rlike(SENTENCE_END)
    return marks | unfinished | line.rlike(NAVIGATION) | line.rlike(BOILERPLATE)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_lost: float = MOST_LOST) -> DataFrame:
    """One row per document: doc_id, tag, cleaned text, n_lines, n_removed_lines, lost (share of the characters), the base figures and the verdicts.

    Null and empty texts have no words and fail the base rule of least words. Repeated windows are told by
    64-bit hashes of their words. Repeated rows all appear; no row is compared with another.
    """
    rows = keyed(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    step = rows.select("doc_id", "tag", "text", words_of(F.col("text")).alias("words"), lines.alias("lines"))
    windows = F.when(F.size("words") >= WINDOW, F.transform(F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    step = step.select(
        "doc_id", "tag", F.size("words").cast("long").alias("n_words"), F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "lines", F.filter("lines", lambda line: ~line_fails(line)).alias("good"), windows.alias("hashes"))
    chars = lambda name: F.char_length(F.array_join(name, ""))
    step = step.select(
        "doc_id", "tag", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.array_join("good", "\n").alias("cleaned"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("good")).cast("long").alias("n_removed_lines"),
        F.when(F.size("lines") > 0, 1 - chars("good") / chars("lines")).otherwise(F.lit(0.0)).alias("lost"),
        # Most texts have no window twice; only the others sort their windows.
        F.when(F.size("hashes") > F.size(F.array_distinct("hashes")), F.col("hashes")).alias("hashes"))
    kept = [c for c in step.columns if c != "hashes"]
    step = step.select(*kept, F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))).alias("places"))
    step = step.select(*kept, F.expr(
        "array_sort(transform(filter(places, (x, k) -> coalesce(get(places, k - 1).h = x.h, false) or coalesce(get(places, k + 1).h = x.h, false)), x -> x.i))").alias("at"))
    step = step.select(*kept, F.coalesce(F.expr(
        f"aggregate(transform(at, (p, k) -> least({WINDOW}, coalesce(get(at, k + 1) - p, {WINDOW}))), 0L, (s, n) -> s + n)"), F.lit(0).cast("long")).alias("n_repeat_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    step = step.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("lost") <= most_lost))
    # A caller's filter on a verdict must not be pushed below the staged columns, where every use would compute them anew.
    return step.select(F.inline(F.array(F.struct(*step.columns))))


def digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_removed_lines")
