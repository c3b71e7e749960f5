"""Byte-level BPE over a global shuffle of distinct words.

1. Every partition splits its documents into pre-tokens and numbers the distinct ones of a block; a
   document becomes the sequence of their numbers, its positions.
2. The distinct words of all blocks meet by hash; each is merged once, whatever number of blocks has it.
3. Its ids go back to the blocks that asked, join the positions there, and the documents are put together
   again. Decoding joins the ids with the token-byte table, which is as large as the vocabulary.

Only distinct words and packed positions are shuffled. The blocks are cut from the partitions of the
input, which is therefore read twice (words, positions); a checksum of each block's words fails the job
if an input that is not stable gave two different blocks.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import zlib
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, keyed, texts_of

#: Text bytes of a block; a longer document makes a block of its own.
BLOCK_BYTES = 16 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Joins the pair of lowest rank, leftmost first, until no pair has a rank."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 48:
        return _merge_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    none = len(ranks) + 1
    pairs = [ranks.get(word[i:i + 2], none) for i in range(len(word) - 1)]
    while pairs:
        low = min(pairs)
        if low == none:
            break
        i = pairs.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap and a linked list, n log n for words of any length."""
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            stop = end[after[i]]
            rank = ranks.get(word[i:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, i, stop))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != stop:
            continue
        gone = after[i]
        alive[gone], end[i], after[i] = False, stop, after[gone]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = after[i]
    return out


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... count[0] of them, then those of the next."""
    ends = np.cumsum(count)
    return np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


class _Chunks(dict):
    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class Splitter:
    """Pre-tokens by the pattern. A single space before a non-space always starts a match, so texts are cut there
    and every distinct cut piece is matched once per block."""

    def __init__(self, pattern: str):
        self.match = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.uneven = regex.compile(r" (?=\s|$)")

    def cut(self, text: str) -> list:
        head, *parts = text.split(" ")
        if self.uneven.search(text):
            joined = [head]
            for p in parts:
                if not p or p[0].isspace():
                    joined[-1] += " " + p
                else:
                    joined.append(p)
            head, *parts = joined
        return [(head,), *parts]

    def words(self, chunk) -> list[str]:
        return self.match.findall(chunk[0] if isinstance(chunk, tuple) else " " + chunk)


def blocks(batches, splitter: Splitter, block_bytes: int):
    """(ids, tags, word counts, word numbers, words) of each block of the partition."""
    def flush():
        words: dict[str, int] = {}
        numbers, counts = [], np.empty(len(chunks), np.int64)
        for i, chunk in enumerate(chunks):
            found = splitter.words(chunk)
            counts[i] = len(found)
            for w in found:
                numbers.append(words.setdefault(w, len(words)))
        numbers = np.array(numbers, np.uint32)
        start = np.cumsum(counts) - counts
        flat = np.concatenate(docs) if docs else np.zeros(0, np.int32)
        per_doc = np.add.reduceat(np.append(counts[flat], 0), np.cumsum([0, *map(len, docs)])[:-1]) if docs else np.zeros(0, np.int64)
        return ids, tags, per_doc, numbers[ranges(start[flat], counts[flat])], [w.encode() for w in words]

    ids, tags, docs, chunks, size = [], [], [], _Chunks(), 0
    for batch in batches:
        for doc, tag, text in zip(batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(), batch.column("text").to_pylist()):
            text = text or ""
            cut = splitter.cut(text)
            docs.append(np.fromiter(map(chunks.__getitem__, cut), np.int32, len(cut)))
            ids.append(doc)
            tags.append(tag)
            size += len(text)
            if size >= block_bytes:
                yield flush()
                ids, tags, docs, chunks, size = [], [], [], _Chunks(), 0
    if ids:
        yield flush()
    del ids, tags, docs, chunks
    give_back()


def packed(*arrays: np.ndarray) -> bytes:
    """Unsigned 32-bit arrays by byte planes, compressed."""
    head = np.array([len(arrays), *map(len, arrays)], "<u4").tobytes()
    planes = [np.ascontiguousarray(np.asarray(a, "<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for a in arrays]
    return zstandard.compress(head + b"".join(planes), 3)


def unpacked(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    sizes, at, out = np.frombuffer(raw, "<u4", n, 4), 4 + 4 * n, []
    for size in sizes.tolist():
        planes = np.frombuffer(raw, np.uint8, 4 * size, at).reshape(4, size)
        out.append(np.ascontiguousarray(planes.T).view("<u4").reshape(-1))
        at += 4 * size
    return out


class TokenBytes:
    """The token-byte table as arrays: id to bytes, many at once."""

    def __init__(self, ranks: dict[bytes, int]):
        table = {i: b for b, i in ranks.items()}
        sizes = np.array([len(table.get(i, b"")) for i in range(max(table) + 1)], np.int64)
        self.size, self.start = sizes, np.cumsum(sizes) - sizes
        self.data = np.frombuffer(b"".join(table.get(i, b"") for i in range(max(table) + 1)), np.uint8)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ranges(self.start[ids], self.size[ids])]


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES, with_ids: bool = True, partitions: int | None = None) -> DataFrame:
    """One row per document: doc_id, tag, n_tokens, ids_sha256, decoded_sha256 and, unless ``with_ids`` is off, ids.

    Null texts count as empty; empty texts have no ids. Repeated rows and rows without id all appear.
    ``vocabulary`` is the path of a rank file on the driver; executors get it by broadcast.
    """
    spark, rows = docs.sparkSession, keyed(docs, id_col, text_col).withColumn("part", F.spark_partition_id())
    ranks = read_ranks(vocabulary)
    shared_ranks = spark.sparkContext.broadcast(ranks)
    shared_table = spark.sparkContext.broadcast(TokenBytes(ranks))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def numbered(batches):
        filled = (b for b in batches if b.num_rows)
        first = next(filled, None)
        if first is not None:
            part = first.column("part")[0].as_py()
            for k, block in enumerate(blocks(chain([first], filled), Splitter(pattern), block_bytes)):
                yield (part << 32) + k, zlib.crc32(b"\n".join(block[4])), block

    def word_rows(batches):
        for number, check, (_, _, _, _, words) in numbered(batches):
            bucket = np.array([zlib.crc32(w) % n for w in words], np.int64)
            by = np.argsort(bucket, kind="stable")
            there, first = np.unique(bucket[by], return_index=True)
            out = list(zip(there.tolist(), np.split(by, first[1:])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in out], pa.int64()), pa.array([number] * len(out), pa.int64()), pa.array([check] * len(out), pa.int64()),
                 pa.array([packed(at, [len(words[i]) for i in at.tolist()]) for _, at in out], pa.binary()),
                 pa.array([zstandard.compress(b"".join([words[i] for i in at.tolist()]), 3) for _, at in out], pa.binary())],
                ["bucket", "block", "check", "places", "words"])

    def merged(batches):
        table = shared_ranks.value
        bucket, known = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    bucket, known = row["bucket"], {}
                places, sizes = unpacked(row["places"])
                raw = zstandard.decompress(row["words"])
                counts, ids, at = [], [], 0
                for size in sizes.tolist():
                    word = raw[at:at + size]
                    at += size
                    found = known.get(word)
                    if found is None:
                        found = known[word] = merge(word, table)
                    counts.append(len(found))
                    ids += found
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]], pa.int64()), pa.array([row["check"]], pa.int64()), pa.array([0], pa.int32()), pa.array([packed(places, counts, ids)], pa.binary())],
                    ["block", "check", "kind", "blob"])
        known.clear()
        give_back()

    def position_rows(batches):
        for number, check, (ids, tags, per_doc, positions, words) in numbered(batches):
            head = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(tags, pa.int64())], ["doc_id", "tag"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, head.schema) as out:
                out.write_batch(head)
            blob = packed(np.array([len(words)]), per_doc, positions)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([check], pa.int64()), pa.array([1], pa.int32()), pa.array([np.array([len(blob)], "<u8").tobytes() + blob + sink.getvalue().to_pybytes()], pa.binary())],
                ["block", "check", "kind", "blob"])

    names = ["doc_id", "tag", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def together(batches):
        table = shared_table.value
        rows_in = (r for batch in batches for r in batch.to_pylist())
        for number, group in groupby(rows_in, key=lambda r: r["block"]):
            replies = []
            for row in group:  # the replies come first
                if row["kind"] == 0:
                    replies.append((row["check"], unpacked(row["blob"])))
                    continue
                size = int(np.frombuffer(row["blob"], "<u8", 1)[0])
                (n_words,), per_doc, positions = unpacked(row["blob"][8:8 + size])
                if any(c != row["check"] for c, _ in replies) or sum(len(r[0]) for _, r in replies) != n_words:
                    raise RuntimeError(f"block {number} was cut differently when it was read again; write the input to a table first")
                count, start = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64)
                base = 0
                for _, (places, counts, ids) in replies:
                    count[places] = counts
                    start[places] = base + np.cumsum(counts, dtype=np.int64) - counts
                    base += len(ids)
                ids = np.concatenate([r[2] for _, r in replies]) if replies else np.zeros(0, "<u4")
                head = pa.ipc.open_stream(row["blob"][8 + size:]).read_next_batch()
                yield from assembled(head, per_doc.astype(np.int64), positions, start, count, ids, table, with_ids, names)
        give_back()

    words = rows.mapInArrow(word_rows, "bucket long, block long, check long, places binary, words binary")
    replies = words.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(merged, "block long, check long, kind int, blob binary")
    positions = rows.mapInArrow(position_rows, "block long, check long, kind int, blob binary")
    met = replies.unionByName(positions).repartition(n, "block").sortWithinPartitions("block", "kind")
    return met.mapInArrow(together, "doc_id long, tag long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def assembled(head, per_doc, positions, start, count, ids, table: TokenBytes, with_ids: bool, names, at_once: int = 1 << 18):
    """Rows of the documents of a block, a few hundred thousand words at a time (at least one document)."""
    edges = np.concatenate(([0], np.cumsum(per_doc)))
    first = 0
    while first < len(per_doc):
        last = max(first + 1, int(np.searchsorted(edges, edges[first] + at_once, side="right")) - 1)
        at = positions[edges[first]:edges[last]]
        tokens = ids[ranges(start[at], count[at])]
        token_edges = np.concatenate(([0], np.cumsum(count[at])))[edges[first:last + 1] - edges[first]]
        text = table.decode(tokens)
        byte_edges = np.concatenate(([0], np.cumsum(table.size[tokens])))[token_edges]
        raw, out = memoryview(tokens.astype("<u4").tobytes()), memoryview(text.tobytes())
        k = range(last - first)
        columns = [
            head.column(0).slice(first, last - first), head.column(1).slice(first, last - first), pa.array(np.diff(token_edges), pa.int64()),
            pa.array([hashlib.sha256(raw[4 * token_edges[i]:4 * token_edges[i + 1]]).hexdigest() for i in k], pa.string()),
            pa.array([hashlib.sha256(out[byte_edges[i]:byte_edges[i + 1]]).hexdigest() for i in k], pa.string())]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(token_edges, pa.int32()), pa.array(tokens.astype(np.int32), pa.int32())))
        yield pa.RecordBatch.from_arrays(columns, names)
        first = last


def decode(tokens: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """``tokens`` with a column ``decoded`` (binary): the bytes of its ids, null for null. Unknown ids fail the job."""
    spark: SparkSession = tokens.sparkSession
    shared = spark.sparkContext.broadcast(TokenBytes(read_ranks(vocabulary)))

    @F.pandas_udf("binary")
    def joined(rows):
        return rows.map(lambda ids: None if ids is None else shared.value.decode(np.asarray(ids, np.int64)).tobytes())

    return tokens.withColumn("decoded", joined(F.col(ids_col)))


def digest(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
