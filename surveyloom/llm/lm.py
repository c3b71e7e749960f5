"""Language-model scores of documents: a word unigram base and a subword lattice likelihood.

The pieces are those of an existing subword vocabulary. Their stored scores give the first weights; one
step of expectation over the lattices of all training words adapts them to the corpus. A text is its
words, each with the word-start mark, and an end; its probability is the sum over all segmentations into
pieces, which factors over the words because no piece crosses a word start. So every distinct word's
lattice is summed once, by a forward recursion in log space, and reaches the documents through numbered
words, as in ``bpe``: words meet by hash, replies go back to the blocks.
"""

from __future__ import annotations

import zlib
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _Chunks, packed, unpacked
from .common import held_out, keyed, settle, texts_of

BLOCK_BYTES = 16 << 20
WORD_START = "▁"
#: Words whose lattices are summed in one go, and the weight of the stored scores in pseudo-counts of all pieces together.
AT_ONCE, PRIOR = 20_000, 10_000.0
LOG10 = float(np.log(10))


class Pieces:
    """Pieces as bytes in a prefix table; weights in natural logs, the end last. Bytes 0-255 spell characters that no piece has."""

    def __init__(self, rows: list[tuple[bytes, float]], byte_scores: list[float]):
        self.table: dict[bytes, int] = {}
        for i, (piece, _) in enumerate(rows):
            for n in range(1, len(piece)):
                self.table.setdefault(piece[:n], -1)
            self.table[piece] = i
        self.bytes_at = len(rows)
        # Stored scores order the pieces (the higher the more frequent); their ranks give weights by Zipf's law.
        scores = np.array([s for _, s in rows] + byte_scores)
        rank = np.empty(len(scores))
        rank[np.argsort(-scores, kind="stable")] = np.arange(len(scores))
        weight = np.append(1 / (rank + 2.7), 0.0)
        weight[-1] = weight.sum() / 100
        self.weights = np.log(weight / weight.sum())

    @classmethod
    def read(cls, path: str) -> "Pieces":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        rows, spelled = [], {}
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                spelled[int(model.id_to_piece(i)[3:5], 16)] = model.get_score(i)
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                rows.append((model.id_to_piece(i).encode(), model.get_score(i)))
        lowest = min((s for _, s in rows), default=0.0) - 1
        return cls(rows, [min(spelled.get(b, lowest), lowest) for b in range(256)])

    def adapted(self, expected: np.ndarray, prior: float = PRIOR) -> np.ndarray:
        weight = expected + prior * np.exp(self.weights)
        return np.log(weight / weight.sum())

    def edges(self, words: list[bytes]):
        """(from, to, piece) over the byte positions of all words, and each word's first and last position."""
        table, start = self.table.get, WORD_START.encode()
        source, target, which, first, last = [], [], [], [], []
        base = 0
        for word in words:
            text = start + word
            n = len(text)
            first.append(base)
            last.append(base + n)
            for i in range(n):
                if text[i] & 0xC0 == 0x80:
                    continue
                spelled = True
                size = 1 if text[i] < 0x80 else 2 if text[i] < 0xE0 else 3 if text[i] < 0xF0 else 4
                for j in range(i + 1, n + 1):
                    piece = table(text[i:j])
                    if piece is None:
                        break
                    if piece >= 0:
                        source.append(base + i)
                        target.append(base + j)
                        which.append(piece)
                        if j == i + size:
                            spelled = False
                if spelled:
                    for j in range(i, i + size):
                        source.append(base + j)
                        target.append(base + j + 1)
                        which.append(self.bytes_at + text[j])
            base += n + 1
        return (np.array(x, np.int64) for x in (source, target, which, first, last))


def _sums(into: np.ndarray, source, target, weight, level) -> np.ndarray:
    """Log-space recursion: into[target] = log sum exp(into[source] + weight), positions level by level."""
    by = np.lexsort((target, level))
    source, target, weight, level = source[by], target[by], weight[by], level[by]
    new = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
    edges = np.searchsorted(level, np.arange(level[-1] + 2)) if len(level) else np.zeros(1, np.int64)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if a < b:
            starts = new[np.searchsorted(new, a):np.searchsorted(new, b)]
            into[target[starts]] = np.logaddexp.reduceat(into[source[a:b]] + weight[a:b], starts - a)
    return into


def forward(pieces: Pieces, weights: np.ndarray, words: list[bytes], counts: np.ndarray | None = None):
    """Natural log of each word's probability over all segmentations; with ``counts`` the expected counts of the pieces."""
    totals, expected = [], np.zeros(len(weights))
    for at in range(0, len(words), AT_ONCE):
        source, target, which, first, last = pieces.edges(words[at:at + AT_ONCE])
        word = np.searchsorted(first, source, side="right") - 1
        weight = weights[which]
        alpha = np.full(last[-1] + 1, -np.inf)
        alpha[first] = 0.0
        alpha = _sums(alpha, source, target, weight, target - first[word])
        totals.append(alpha[last])
        if counts is not None:
            beta = np.full(len(alpha), -np.inf)
            beta[last] = 0.0
            beta = _sums(beta, target, source, weight, last[word] - source)
            share = np.exp(alpha[source] + weight + beta[target] - alpha[last][word])
            expected += np.bincount(which, share * counts[at:at + AT_ONCE][word], len(weights))
    return np.concatenate(totals) if totals else np.zeros(0), expected


def score(docs: DataFrame, vocabulary: str, train_modulus: int = 7, train_remainder: int = 2, id_col: str = "doc_id", text_col: str = "text",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, tag, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts are lower-cased (A-Z) and cut at ASCII white space; every text ends with one end token. Null
    and empty texts are the end alone. Rows with crc32(doc_id) modulo ``train_modulus`` equal to
    ``train_remainder`` are scored but not learned; rows without id are learned. Repeated rows count as
    often as they are. Scores are base-10 logs. Word counts and expected piece counts cover all training
    rows; only the counts of the pieces, as many as the vocabulary has, reach the driver.
    """
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    rows = rows.select("doc_id", "tag", "text", held_out(F.col("doc_id"), train_modulus, train_remainder).alias("held_out"), F.spark_partition_id().alias("part"))
    shared = spark.sparkContext.broadcast(Pieces.read(vocabulary))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ends = rows.where("not held_out").count()

    def blocks(batches):
        """(number, checksum, ids, tags, held_out, numbers per document, words, training counts)."""
        part, k = 0, 0
        ids, tags, out, numbers, words, size = [], [], [], [], _Chunks(), 0

        def block():
            train = [x for x, h in zip(numbers, out) if not h]
            counts = np.bincount(np.concatenate(train) if train else np.zeros(0, np.int64), minlength=len(words))
            listed = list(words)
            return (part << 32) + k, zlib.crc32(b"\n".join(listed)), ids, tags, out, numbers, listed, counts

        for batch in batches:
            for doc, tag, text, held, part in zip(batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(), texts_of(batch.column("text")),
                                                  batch.column("held_out").to_pylist(), batch.column("part").to_pylist()):
                found = text.lower().split()
                numbers.append(np.fromiter(map(words.__getitem__, found), np.int64, len(found)))
                ids.append(doc)
                tags.append(tag)
                out.append(held)
                size += len(text)
                if size >= block_bytes:
                    yield block()
                    k += 1
                    ids, tags, out, numbers, words, size = [], [], [], [], _Chunks(), 0
        if ids:
            yield block()

    asked = "bucket long, kind int, block long, check long, numbers binary, words binary"

    def requests(batches):
        for number, check, _, _, _, _, words, counts in blocks(batches):
            bucket = np.array([zlib.crc32(w) % n for w in words], np.int64)
            by = np.argsort(bucket, kind="stable")
            there, first = np.unique(bucket[by], return_index=True)
            out = list(zip(there.tolist(), np.split(by, first[1:])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in out], pa.int64()), pa.array([1] * len(out), pa.int32()), pa.array([number] * len(out), pa.int64()), pa.array([check] * len(out), pa.int64()),
                 pa.array([packed(at, counts[at]) for _, at in out], pa.binary()), pa.array([zstandard.compress(b"\n".join([words[i] for i in at.tolist()]), 3) for _, at in out], pa.binary())],
                ["bucket", "kind", "block", "check", "numbers", "words"])

    def split(blob):
        return zstandard.decompress(blob).split(b"\n")  # words have no line break

    def by_bucket(batches):
        return groupby((r for batch in batches for r in batch.to_pylist()), key=lambda r: r["bucket"])

    def counted(batches):
        """One row per bucket: its words with their training counts (those that have one); one row per task: tokens, words, expected piece counts."""
        pieces = shared.value
        tokens, distinct, expected = 0, 0, np.zeros(len(pieces.weights))
        for bucket, group in by_bucket(batches):
            total: dict[bytes, int] = {}
            for row in group:
                _, counts = unpacked(row["numbers"])
                for word, c in zip(split(row["words"]), counts.tolist()):
                    if c:
                        total[word] = total.get(word, 0) + c
            words, counts = list(total), np.array(list(total.values()), np.int64)
            expected += forward(pieces, pieces.weights, words, counts)[1]
            tokens += int(counts.sum())
            distinct += len(words)
            if words:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int64()), pa.array([0], pa.int32()), pa.array([0], pa.int64()), pa.array([0], pa.int64()),
                     pa.array([zstandard.compress(counts.tobytes(), 3)], pa.binary()), pa.array([zstandard.compress(b"\n".join(words), 3)], pa.binary())],
                    ["bucket", "kind", "block", "check", "numbers", "words"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int64()), pa.array([2], pa.int32()), pa.array([tokens], pa.int64()), pa.array([distinct], pa.int64()), pa.array([expected.tobytes()], pa.binary()), pa.array([b""], pa.binary())],
            ["bucket", "kind", "block", "check", "numbers", "words"])

    requested = settle(rows.mapInArrow(requests, asked))
    table = settle(requested.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(counted, asked))
    summed = table.where("kind = 2").agg(F.sum("block"), F.sum("check")).first()
    tokens, distinct = (summed[0] or 0) + ends, (summed[1] or 0) + (ends > 0)
    weights = shared.value.adapted(_expected(table.where("kind = 2"), len(shared.value.weights), ends))
    final = spark.sparkContext.broadcast(weights)

    def replies(batches):
        pieces, weights = shared.value, final.value
        for _, group in by_bucket(batches):
            known: dict[bytes, int] = {}
            scored: dict[bytes, float] = {}
            for row in group:
                if row["kind"] == 0:
                    known = dict(zip(split(row["words"]), np.frombuffer(zstandard.decompress(row["numbers"]), np.int64).tolist()))
                    continue
                words = split(row["words"])
                new = [w for w in words if w not in scored]
                scored.update(zip(new, forward(pieces, weights, new)[0].tolist()))
                numbers, _ = unpacked(row["numbers"])
                counts = np.fromiter((known.get(w, 0) for w in words), np.int64, len(words))
                logs = np.fromiter(map(scored.__getitem__, words), np.float64, len(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]], pa.int64()), pa.array([0], pa.int32()), pa.array([row["check"]], pa.int64()),
                     pa.array([packed(numbers)], pa.binary()), pa.array([zstandard.compress(counts.tobytes() + logs.tobytes(), 1)], pa.binary())],
                    ["block", "kind", "check", "numbers", "rest"])

    def positions(batches):
        for number, check, ids, tags, out, numbers, words, _ in blocks(batches):
            head = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(tags, pa.int64()), pa.array(out, pa.bool_())], ["doc_id", "tag", "held_out"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, head.schema) as stream:
                stream.write_batch(head)
            blob = packed(np.array([len(words)]), np.array([len(x) for x in numbers]), np.concatenate(numbers))
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([1], pa.int32()), pa.array([check], pa.int64()), pa.array([blob], pa.binary()),
                                              pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "kind", "check", "numbers", "rest"])

    scale, end_known = float(np.log10(tokens + distinct + 1)), int(ends > 0)
    end_base, end_log = float(np.log10(ends + 1)), float(weights[-1]) / LOG10
    names = ["doc_id", "tag", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def together(batches):
        rows_in = (r for batch in batches for r in batch.to_pylist())
        for number, group in groupby(rows_in, key=lambda r: r["block"]):
            found = []
            for row in group:  # the replies come first
                if row["kind"] == 0:
                    at, = unpacked(row["numbers"])
                    raw = zstandard.decompress(row["rest"])
                    found.append((row["check"], at, np.frombuffer(raw, np.int64, len(at)), np.frombuffer(raw, np.float64, len(at), 8 * len(at))))
                    continue
                (n_words,), per_doc, where = unpacked(row["numbers"])
                if any(f[0] != row["check"] for f in found) or sum(len(f[1]) for f in found) != n_words:
                    raise RuntimeError(f"block {number} was cut differently when it was read again; write the input to a table first")
                count, logs = np.zeros(n_words + 1, np.int64), np.zeros(n_words + 1)
                for _, at, c, x in found:
                    count[at], logs[at] = c, x
                edges = np.cumsum(np.append(0, per_doc.astype(np.int64)))
                per_word = lambda values: np.diff(np.concatenate(([0], np.cumsum(values[where])))[edges])
                # Sums of floats by document, so that no document's rounding depends on its neighbours.
                owner = np.repeat(np.arange(len(per_doc)), per_doc)
                per_doc_sum = lambda values: np.bincount(owner, values[where], len(per_doc))
                head = pa.ipc.open_stream(row["rest"]).read_next_batch()
                length = per_doc.astype(np.int64) + 1
                base = per_doc_sum(np.log10(count + 1.0)) + end_base - length * scale
                yield pa.RecordBatch.from_arrays(
                    [*head.columns, pa.array(length), pa.array(per_word((count > 0).astype(np.int64)) + end_known), pa.array(np.full(len(length), tokens)),
                     pa.array(base), pa.array(per_doc_sum(logs / LOG10) + end_log)], names)

    answered = table.where("kind = 0").unionByName(requested).repartition(n, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(
        replies, "block long, kind int, check long, numbers binary, rest binary")
    placed = rows.mapInArrow(positions, "block long, kind int, check long, numbers binary, rest binary")
    met = answered.unionByName(placed).repartition(n, "block").sortWithinPartitions("block", "kind")
    return met.mapInArrow(together, "doc_id long, tag long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _expected(partial: DataFrame, size: int, ends: int) -> np.ndarray:
    """Expected piece counts summed in one level of tasks, then over those few rows."""
    def add(batches):
        total = np.zeros(size)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                total += np.frombuffer(blob)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["numbers"])

    total = np.zeros(size)
    for row in partial.select("numbers").coalesce(8).mapInArrow(add, "numbers binary").toLocalIterator():
        total += np.frombuffer(row.numbers)
    total[-1] += ends
    return total
