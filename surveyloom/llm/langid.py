"""Language identification by partial matching: per-language byte context trees, exact code lengths, frozen statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, keyed, pieces, texts_of

ORDER = 4
#: Bytes of training text per language, drawn by hash as pieces of PIECE characters from all labelled rows.
SAMPLE_BYTES = 1 << 20
PIECE = 2000
#: A context is kept if the sample shows it so often, all languages together.
LEAST = 3
SEGMENT = 512
#: Bytes of text that a task reads at once.
CUT_BYTES = 2 << 20
UNDETERMINED = "und"


class ContextTrees:
    """The union of the languages' context trees as one automaton.

    A state is the longest kept context; ``step[state, symbol]`` is the next state and
    ``bits[state, symbol, language]`` the code length. In a context that a language has seen, a seen
    symbol costs -log2(count / (total + distinct)); an unseen one costs the escape
    -log2(distinct / (total + distinct)) and is coded in the next shorter context. A context that a
    language has not seen passes on for nothing; below the root every byte costs 8 bits.
    """

    def __init__(self, samples: dict[str, bytes], order: int = ORDER, least: int = LEAST):
        self.languages, self.order = sorted(samples), order
        texts = [np.frombuffer(samples[k], np.uint8) for k in self.languages]
        seen = np.unique(np.concatenate([np.unique(t) for t in texts])) if texts else np.zeros(0, np.uint8)
        k = len(seen) + 1  # the last symbol stands for all bytes that the sample lacks
        self.symbol = np.full(256, k - 1, np.int64)
        self.symbol[seen] = np.arange(len(seen))
        self.symbols, coded = k, [self.symbol[t] for t in texts]
        grams = []  # by depth and language: codes of context + symbol, and counts
        for d in range(order + 1):
            at = []
            for s in coded:
                n = max(0, len(s) - d)
                code = np.zeros(n, np.int64)
                for j in range(d + 1):
                    code = code * k + s[j:j + n]
                at.append(np.unique(code, return_counts=True))
            grams.append(at)
        contexts, first = [], [0]
        for d, at in enumerate(grams):
            code = np.concatenate([c // k for c, _ in at]) if at else np.zeros(0, np.int64)
            count = np.concatenate([n for _, n in at]) if at else np.zeros(0, np.int64)
            values, where = np.unique(code, return_inverse=True)
            kept = values[np.bincount(where, count, len(values)) >= least] if d else np.zeros(1, np.int64)
            contexts.append(kept)
            first.append(first[-1] + len(kept))
        states, languages = first[-1], len(self.languages)
        self.bits = np.full((states, k, languages), 8.0, np.float32)
        self.step = np.zeros((states, k), np.int32)

        def number(d: int, code: np.ndarray) -> np.ndarray:
            """State of each context of depth ``d``, -1 where it is not kept."""
            at = np.minimum(np.searchsorted(contexts[d], code), max(0, len(contexts[d]) - 1))
            return np.where(contexts[d][at] == code, at + first[d], -1) if len(contexts[d]) else np.full(len(code), -1)

        for d in range(order + 1):
            own = slice(first[d], first[d + 1])
            if d:
                shorter = number(d - 1, contexts[d] % k ** (d - 1))
                self.bits[own], self.step[own] = self.bits[shorter], self.step[shorter]
            for x, (code, count) in enumerate(grams[d]):
                at = number(d, code // k)
                code, count, at = code[at >= 0], count[at >= 0], at[at >= 0] - first[d]
                total = np.bincount(at, count, first[d + 1] - first[d])
                distinct = np.bincount(at, minlength=first[d + 1] - first[d]).astype(float)
                known = total > 0
                self.bits[own, :, x][known] += -np.log2(distinct[known] / (total + distinct)[known])[:, None].astype(np.float32)
                self.bits[at + first[d], code % k, x] = -np.log2(count / (total + distinct)[at])
            if d < order and len(contexts[d + 1]):
                longer = contexts[d + 1]
                self.step[number(d, longer // k), longer % k] = np.arange(first[d + 1], first[d + 2])
        self.bits, self.step = self.bits.reshape(states * k, languages), self.step.reshape(-1)

    def code_lengths(self, texts: list[bytes], segment: int = SEGMENT) -> np.ndarray:
        """Bits of every whole text under every language; long texts run as segments that first read the bytes before them."""
        out = np.zeros((len(texts), len(self.languages)))
        size = np.array([len(t) for t in texts], np.int64)
        if not size.sum():
            return out
        data = self.symbol.astype(np.uint16)[np.frombuffer(b"".join(texts), np.uint8)]
        begin = np.cumsum(size) - size
        parts = -(-size // segment)
        owner = np.repeat(np.arange(len(texts)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = begin[owner] + nth * segment
        length = np.minimum(segment, begin[owner] + size[owner] - start)
        by = np.argsort(-length, kind="stable")
        owner, start, length, nth = owner[by], start[by], length[by], nth[by]
        state = np.zeros(len(by), np.int32)
        for t in range(-self.order, 0):
            inner = np.flatnonzero(nth > 0)
            state[inner] = self.step[state[inner] * self.symbols + data[start[inner] + t]]
        total = np.zeros((len(by), len(self.languages)))
        alive = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")
        for t, n in enumerate(alive):
            cell = state[:n] * self.symbols + data[start[:n] + t]
            total[:n] += self.bits[cell]
            state[:n] = self.step[cell]
        np.add.at(out, owner, total)
        return out


def training_sample(docs: DataFrame, lang_col: str, text_col: str, id_col: str, sample_bytes: int) -> dict[str, bytes]:
    """About ``sample_bytes`` per language: pieces whose hash of (id, piece number) falls below the language's share."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("id"))
    sizes = {r.lang: r.size for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("size")).collect()}
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, int(min(1.0, sample_bytes / max(1, v)) * (1 << 30)))])
    numbers = F.sequence(F.lit(0), F.floor((F.greatest(F.length("text"), F.lit(1)) - 1) / PIECE).cast("int"))
    chosen = F.filter(numbers, lambda i: F.pmod(F.xxhash64(F.col("id"), i), F.lit(1 << 30)) < share[F.col("lang")])
    pieces = rows.select("lang", F.explode(F.transform(chosen, lambda i: F.substring(F.col("text"), i * PIECE + 1, F.lit(PIECE)))).alias("piece"))
    found: dict[str, list[bytes]] = {k: [] for k in sizes}
    for r in pieces.collect():
        found[r.lang].append(r.piece.encode())
    return {k: b"\n".join(sorted(v)) for k, v in found.items() if v}


def trained(spark, train: DataFrame, lang_col: str, text_col: str, id_col: str, sample_bytes: int, order: int):
    """The model as a broadcast; its size follows the bounded sample. None without labelled text."""
    samples = training_sample(train, lang_col, text_col, id_col, sample_bytes)
    return spark.sparkContext.broadcast(ContextTrees(samples, order) if samples else None)


def judged(model: ContextTrees | None, texts: list[bytes], letters: list[bool]):
    """(language, score, bits per byte) of each text; ``und``, 0 and None where there is no letter or no model."""
    names, scores, rates = [UNDETERMINED] * len(texts), [0.0] * len(texts), [None] * len(texts)
    for first in range(0, len(texts) if model is not None else 0, 2000):
        bits = model.code_lengths(texts[first:first + 2000])
        for i, b in enumerate(bits.argmin(1).tolist()):
            if letters[first + i]:
                names[first + i] = model.languages[b]
                scores[first + i] = float(1 / np.exp2(np.maximum(bits[i, b] - bits[i], -1000)).sum())
                rates[first + i] = float(bits[i, b] / len(texts[first + i]))
    return names, scores, rates


def identify(docs: DataFrame, train: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
             sample_bytes: int = SAMPLE_BYTES, order: int = ORDER) -> DataFrame:
    """One row per document: doc_id, tag, lang_pred, score, bits_per_byte.

    The language with the shortest code for the whole text wins, ties go to the first name; ``score``
    is its posterior under equal priors. Null, empty and letterless texts are ``und`` with score 0, as
    is every text if ``train`` has no labelled text. Only texts and languages of ``train`` are learned,
    only the text is looked at.
    """
    shared = trained(docs.sparkSession, train, lang_col, text_col, id_col, sample_bytes, order)
    rows = keyed(docs, id_col, text_col).withColumn("letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def run(batches):
        for batch in (cut for whole in batches for cut in pieces(whole, CUT_BYTES)):
            names, scores, rates = judged(shared.value, texts_of(batch.column("text")), batch.column("letters").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tag"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())],
                ["doc_id", "tag", "lang_pred", "score", "bits_per_byte"])

    return rows.mapInArrow(run, "doc_id long, tag long, lang_pred string, score double, bits_per_byte double")


def relabel(docs: DataFrame, train: DataFrame, most_bits: float, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
            sample_bytes: int = SAMPLE_BYTES, order: int = ORDER) -> DataFrame:
    """``docs`` with all columns and the predicted language in ``lang_col``; undetermined texts and those of ``most_bits`` per byte or more go."""
    shared = trained(docs.sparkSession, train, lang_col, text_col, id_col, sample_bytes, order)
    names, text, lang = docs.columns, docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches):
        for batch in (cut for whole in batches for cut in pieces(whole, CUT_BYTES, text)):
            found, _, rates = judged(shared.value, texts_of(batch.column(text)), batch.column(len(names)).to_pylist())
            columns = [pa.array(found, pa.string()) if k == lang else batch.column(k) for k in range(len(names))]
            keep = [n != UNDETERMINED and r < most_bits for n, r in zip(found, rates)]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep, pa.bool_()))

    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("__letters")
    return docs.select("*", letters).mapInArrow(run, docs.schema)


def training_rows(docs: DataFrame, id_col: str = "doc_id", modulus: int = 4, remainder: int = 2) -> DataFrame:
    return docs.where(~held_out(F.col(id_col), modulus, remainder))
