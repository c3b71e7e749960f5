"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each read as a 23-bit word of the
perfect binary Golay code. A word within 2 bits of a codeword has that codeword's index as its only key;
one at 3 bits has the indices of all six codewords within 4 bits. Two words at 2 or fewer differing bits
always share a key (``tests/llm`` goes through all cases). Of 4 or fewer errors in three segments at most
one segment has more than 2, so two segments agree on a key: fingerprints are joined on the pairs of
segment keys, 24 bits each, and verified.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, pieces, settle, texts_of
from .components import components

SHINGLE, SEED, DISTANCE = 4, 42, 4
SEGMENTS = ((42, 22), (21, 21), (0, 21))
#: Fingerprints of one key that are compared in one piece; larger groups are compared piece by piece in other tasks.
PIECE = 1024
#: Bytes of text that a task reads at once.
CUT_BYTES = 2 << 20

# Fixed value: generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """Bitwise majority of the XXH64 of the word shingles; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return digest(line, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.append(0, ends[:-1])[:len(words) - size + 1].tolist()
    h = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts, (ends[size - 1:] - 1).tolist())), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)].astype(">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, tag, fp): the fingerprint as a signed long; null and wordless texts have 0."""
    def run(batches):
        for batch in (cut for whole in batches for cut in pieces(whole, CUT_BYTES)):
            fps = np.array([fingerprint(t, size, seed) for t in texts_of(batch.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), pa.array(fps, pa.int64())], ["doc_id", "tag", "fp"])
    return keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, tag long, fp long")


class Golay:
    """Syndromes of 23-bit words and what they say: the error of the nearest codeword, the keys around."""

    def __init__(self):
        self.rest = np.array([self._remainder(1 << i) for i in range(23)], np.int64)
        self.leader = np.zeros(2048, np.int64)
        for weight in range(1, 4):
            for bits in combinations(range(23), weight):
                self.leader[self._remainder(sum(1 << b for b in bits))] = sum(1 << b for b in bits)
        by_rest: dict[int, list[int]] = {}
        for bits in combinations(range(23), 4):
            error = sum(1 << b for b in bits)
            by_rest.setdefault(self._remainder(error), []).append(error)
        #: Errors of weight 3 and 4 that lead from a word to the codewords around; -1 beyond the first for words nearer to one.
        self.errors = np.full((2048, 6), -1, np.int64)
        for s in range(2048):
            self.errors[s, 0] = self.leader[s]
            if bin(self.leader[s]).count("1") == 3:
                self.errors[s, 1:] = by_rest[s]

    @staticmethod
    def _remainder(word: int) -> int:
        for i in range(22, 10, -1):
            if word >> i & 1:
                word ^= GENERATOR << (i - 11)
        return word

    def keys(self, words: np.ndarray) -> np.ndarray:
        """Six 12-bit codeword indices per word, -1 where there are fewer. The code is systematic: the index is the upper bits."""
        syndrome = np.zeros(len(words), np.int64)
        for i in range(23):
            syndrome ^= np.where(words >> i & 1, self.rest[i], 0)
        errors = self.errors[syndrome]
        return np.where(errors >= 0, (words[:, None] ^ errors) >> 11, -1)


def key_rows(fps: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) for every pair of segments and pair of their keys."""
    raw = fps.view(np.uint64)
    segments = [code.keys((raw >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64)) for at, width in SEGMENTS]
    keys, owners = [], []
    for which, (a, b) in enumerate(combinations(segments, 2)):
        pair = (which << 24) + (a[:, :, None] << 12) + b[:, None, :]
        there = (a[:, :, None] >= 0) & (b[:, None, :] >= 0)
        keys.append(pair[there])
        owners.append(np.repeat(fps, there.reshape(len(fps), -1).sum(1)))
    return np.concatenate(keys), np.concatenate(owners)


def close(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= distance


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links (a, b) as stars: every node but the smallest of its component with that smallest one."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        low = np.minimum(rx, ry)
        new = root.copy()
        np.minimum.at(new, rx, low)
        np.minimum.at(new, ry, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def verified(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal, sorted keys, contracted to stars as they come; a run is compared lag by lag."""
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    new_a, new_b, size, lag = [], [], 0, 1
    at = np.arange(len(keys))
    while True:
        at = at[:np.searchsorted(at, len(keys) - lag)]
        at = at[keys[at] == keys[at + lag]]
        if not len(at):
            break
        hit = at[close(fps[at], fps[at + lag], distance)]
        new_a.append(fps[hit])
        new_b.append(fps[hit + lag])
        size += len(hit)
        if size > 1 << 20:
            a, b = forest(np.concatenate((a, *new_a)), np.concatenate((b, *new_b)))
            new_a, new_b, size = [], [], 0
        lag += 1
    return forest(np.concatenate((a, *new_a)), np.concatenate((b, *new_b))) if size or len(a) else (a, b)


def links(fps: DataFrame, distance: int = DISTANCE, piece: int = PIECE) -> DataFrame:
    """Edges (a, b) over distinct fingerprints ``fp`` that connect exactly those within ``distance`` (4 or fewer) bits, transitively.

    Tasks compare the fingerprints of a key and return a spanning star of each connected part, never all
    pairs. Of a key with more than ``piece`` fingerprints a task compares piece by piece only within the
    pieces and passes their members on; a second shuffle compares every two pieces in a task of its own.
    """
    assert distance <= DISTANCE
    schema = "kind int, key long, piece int, a long, b long"

    def keyed_rows(batches):
        code = Golay()
        for batch in batches:
            values = np.asarray(batch.column("fp"))
            for i in range(0, len(values), 20000):
                keys, owners = key_rows(np.ascontiguousarray(values[i:i + 20000]), code)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(owners, pa.int64())], ["key", "fp"])

    def rows(kind, key, part, a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(x, len(a)), t) for x, t in (
            (kind, pa.int32()), (key, pa.int64()), (part, pa.int32()), (a, pa.int64()), (b, pa.int64()))], ["kind", "key", "piece", "a", "b"])

    def compare(batches):
        """Sorted by key. The last key of a batch waits for the next; a long one leaves piece by piece."""
        keys, fps, part, open_key = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, None
        for batch in batches:
            keys = np.concatenate((keys, np.asarray(batch.column("key"))))
            fps = np.concatenate((fps, np.asarray(batch.column("fp"))))
            ends = np.flatnonzero(np.append(keys[1:] != keys[:-1], True)) + 1
            starts = np.append(0, ends[:-1])
            done = starts[-1]
            yield from settled(keys[:done], fps[:done], starts[:-1], ends[:-1], open_key, part)
            if done or keys[-1] != open_key:
                open_key, part = keys[-1], 0
            keys, fps = keys[done:], fps[done:]
            while len(keys) > piece:
                yield from leave(keys[:piece], fps[:piece], part)
                keys, fps, part = keys[piece:], fps[piece:], part + 1
        if len(keys):
            yield from settled(keys, fps, np.array([0]), np.array([len(keys)]), open_key, part)

    def leave(keys, fps, part):
        yield rows(0, 0, 0, *verified(keys, fps, distance))
        yield rows(1, keys[0], part, fps, fps)

    def settled(keys, fps, starts, ends, open_key, part):
        """Whole keys; those longer than a piece, or whose first pieces have left, leave in pieces."""
        light = np.ones(len(keys), bool)
        for s, e in zip(starts, ends):
            first = part if keys[s] == open_key else 0
            if first or e - s > piece:
                light[s:e] = False
                for i in range(s, e, piece):
                    yield from leave(keys[i:min(e, i + piece)], fps[i:min(e, i + piece)], first)
                    first += 1
        yield rows(0, 0, 0, *verified(keys[light], fps[light], distance))

    found = fps.select("fp").mapInArrow(keyed_rows, "key long, fp long").repartition("key").sortWithinPartitions("key").mapInArrow(compare, schema)
    found = settle(found)
    edges = found.where("kind = 0").select("a", "b")
    pieces = found.where("kind = 1").groupBy("key", "piece").agg(F.count(F.lit(1)).alias("n"))
    if pieces.limit(1).count():
        many = found.where("kind = 1").join(pieces.groupBy("key").agg(F.max("piece").alias("last")), "key")
        # Every piece meets every other: the pair (x, y), x < y, gets the members of both.
        met = many.withColumn("other", F.explode(F.sequence(F.lit(0), "last"))).where("other <> piece").select(
            F.xxhash64("key", F.least("piece", "other"), F.greatest("piece", "other")).alias("pair"), (F.col("piece") < F.col("other")).alias("left"), F.col("a").alias("fp"))

        def across(batches):
            pair, sides = None, ([], [])

            def verdict():
                x, y = (np.array(s, np.int64) for s in sides)
                for fp in x.reshape(-1, 1):
                    hit = y[close(np.broadcast_to(fp, len(y)), y, distance)]
                    if len(hit):
                        yield np.broadcast_to(fp, len(hit)), hit

            def star():
                got = list(verdict())
                if got:
                    yield rows(0, 0, 0, *forest(np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])))

            for batch in batches:
                for p, left, fp in zip(batch.column("pair").to_pylist(), batch.column("left").to_pylist(), batch.column("fp").to_pylist()):
                    if p != pair:
                        yield from star()
                        pair, sides = p, ([], [])
                    sides[not left].append(fp)
            yield from star()

        edges = edges.unionByName(met.repartition("pair").sortWithinPartitions("pair").mapInArrow(across, schema).select("a", "b"))
    return edges


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, tag, fp, root (the smallest fingerprint reachable over links) and component_id (the smallest doc_id).

    Equal fingerprints are one class from the start, so copies never meet as pairs; wordless and null
    texts share the fingerprint 0 and are linked like any other. A component without any id has a null
    component_id. Repeated rows all appear.
    """
    rows = settle(fingerprints(docs, id_col, text_col))
    classes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = components(links(classes, distance))
    first = linked.join(classes, linked["node"] == classes["fp"]).groupBy("root").agg(F.min("first").alias("lowest"))
    named = linked.join(first, "root").select(F.col("node").alias("fp"), "root", "lowest")
    final = classes.join(named, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("lowest", "first").alias("component_id"))
    return rows.join(final, "fp").select("doc_id", "tag", "fp", "root", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest doc_id, rows without id last.

    Of rows with that same id the one with the smallest text hash stays, of equal rows one.
    """
    found = near_duplicates(docs, id_col, text_col, distance)
    stay = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("row"))
    stay = stay.select("root", "row.doc_id", "row.tag")
    again = found.groupBy("root", "doc_id", "tag").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("root", "doc_id", "tag", F.lit(True).alias("more"))
    chosen = stay.join(again, (stay["root"] == again["root"]) & stay["doc_id"].eqNullSafe(again["doc_id"]) & (stay["tag"] == again["tag"]), "left")
    chosen = settle(chosen.select(stay["doc_id"].alias("__id"), stay["tag"].alias("__tag"), F.coalesce("more", F.lit(False)).alias("__more")))
    joined = docs.join(chosen, F.col(id_col).cast("long").eqNullSafe(chosen["__id"]) & (F.xxhash64(F.col(text_col).cast("string")) == chosen["__tag"]))
    once = joined.where("__more").dropDuplicates(["__id", "__tag"]) if chosen.where("__more").limit(1).count() else None
    kept = joined.where("not __more")
    return (kept.unionByName(once) if once is not None else kept).select(*docs.columns)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
