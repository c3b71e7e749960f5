"""Exact removal of repeated byte strings with suffix arrays in shards.

Every string of ``LENGTH`` bytes has an anchor: the place of the smallest hash among its GRAM-byte grams,
leftmost of equals. The anchor depends on the string's bytes alone, so equal strings have equal anchors
at equal offsets, and the strings of a document fall into runs of one anchor each, its passages.

1. Passages meet by anchor hash. Anchors that occur once hold no repeated string and are done. Copies of
   one passage are a class of which the earliest stands for all; the others go whole. A task sends each
   distinct passage once, so a passage that a third of the documents share costs one row per task.
2. Where an anchor has different passages, their bytes are fetched and laid side by side, a megabyte or
   two to a shard; the shard's suffix array groups the equal strings and all but the earliest go. An anchor
   with more passages than a shard takes is widened: a string holds half of what it lacks of the anchor's
   surroundings either before or after it, so its strings fall to wider anchors, with shards of their own.
   Passages of such anchors come from a second scan, so the texts are shuffled once, with or without them.
3. The runs are united per document and cut.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import ranges
from .common import pieces, settle, sha256_hex, texts_of
from .suffixes import permuted_prefixes, suffix_array

LENGTH = 100
GRAM = 37
#: Bytes that are scanned in one piece, of texts that a task turns into rows at once, and of passages that make a shard.
SCAN_BYTES, CUT_BYTES, SHARD_BYTES = 1 << 19, 4 << 20, 1 << 20
#: Passages of one anchor that still go into one shard, and passages that a task fetches at once.
HOT_PASSAGES, FETCHED = 8_000, 8_192

_LOW = np.int64(-(1 << 63))


def _gram_table() -> np.ndarray:
    return np.random.default_rng(1).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def _grams(data: np.ndarray, table: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes at every position but the last ones."""
    with np.errstate(over="ignore"):
        base, power = np.uint64(0x9E3779B97F4A7C15), {1: np.uint64(0x9E3779B97F4A7C15)}
        block = {1: table[data]}
        n = 1
        while 2 * n <= size:
            block[2 * n] = block[n][:-n] * power[n] + block[n][n:]
            power[2 * n] = power[n] * power[n]
            n *= 2
        out, done = block[n], n
        while done < size:
            n = 1 << ((size - done).bit_length() - 1)
            keep = len(data) - done - n + 1
            out, done = out[:keep] * power[n] + block[n][done:done + keep], done + n
        out ^= out >> np.uint64(32)
        out *= base | np.uint64(1)
        out ^= out >> np.uint64(29)
        return out


def passages(texts: list[bytes], length: int = LENGTH, gram: int = GRAM, wanted: np.ndarray | None = None):
    """(owner, start, strings, anchor hash, passage hash) of every passage, or of those whose anchor is ``wanted`` (sorted); long texts in overlapping pieces."""
    table, window = _gram_table(), length - gram + 1
    found = []

    def scan(group):
        """group: (owner, offset, bytes) with fewer than 2**24 bytes in all."""
        data = np.frombuffer(b"".join(b for _, _, b in group), np.uint8)
        size = np.array([len(b) for _, _, b in group], np.int64)
        begin = np.cumsum(size) - size
        hashes = _grams(data, table, gram)
        key = (hashes & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(hashes), dtype=np.uint64)
        low, n = key, 1
        while 2 * n <= window:
            low = np.minimum(low[:-n], low[n:])
            n *= 2
        if n < window:
            low = np.minimum(low[:len(low) - (window - n)], low[window - n:])
        starts = ranges(begin, size - length + 1)
        anchor = (low[starts] & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        count = np.diff(np.append(first, len(starts)))
        at, mark = starts[first], hashes[anchor[first]].view(np.int64)
        if wanted is not None:
            some = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, mark), len(wanted) - 1)] == mark)
            at, count, mark = at[some], count[some], mark[some]
        piece = np.searchsorted(begin, at, side="right") - 1
        owner = np.array([o for o, _, _ in group], np.int64)[piece]
        offset = np.array([o for _, o, _ in group], np.int64)[piece]
        view, digest = memoryview(data), xxhash.xxh3_64_intdigest
        content = np.fromiter((digest(view[a:b]) for a, b in zip(at.tolist(), (at + count + length - 1).tolist())), np.uint64, len(at))
        found.append((owner, at - begin[piece] + offset, count, mark, content.view(np.int64)))

    group, size = [], 0
    for k, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - length + 1), SCAN_BYTES):
            part = text[offset:offset + SCAN_BYTES + length - 1]
            if len(part) >= length:
                group.append((k, offset, part))
                size += len(part)
                if size >= SCAN_BYTES:
                    scan(group)
                    group, size = [], 0
    if group:
        scan(group)
    if not found:
        return [np.zeros(0, np.int64)] * 5
    return [np.concatenate(x) for x in zip(*found)]


def _earliest(group: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by group, then (doc, start); and for each place in it whether an earlier (doc, start) is in the group."""
    by = np.lexsort((start, doc, group))
    g, d, s = group[by], doc[by], start[by]
    place = np.arange(len(by))
    first = np.maximum.accumulate(np.where(np.append(True, g[1:] != g[:-1]), place, 0)) if len(by) else place
    return by, (d > d[first]) | (s > s[first])


def _later(anchor: np.ndarray, content: np.ndarray, row: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether the passage has an earlier copy among these."""
    with np.errstate(over="ignore"):
        by, later = _earliest(anchor ^ (content * np.int64(-7046029254386353131)), row, start)
    gone = np.zeros(len(by), bool)
    gone[by] = later
    return gone


def marked(base: DataFrame, length: int) -> DataFrame:
    """The passages that need a decision or have one: anchor (null if gone), row, tag, at (start << 6 | strings - 1), kind (``gone``, ``compare``, ``hot``)."""
    def run(batches):
        names = ["anchor", "content", "gone", "row", "tag", "at"]
        for batch in (cut for whole in batches for cut in pieces(whole, CUT_BYTES, "__text")):
            texts = [t or b"" for t in batch.column("__text").cast(pa.binary()).to_pylist()]
            owner, start, count, anchor, content = passages(texts, length)
            row, tag = np.asarray(batch.column("__row"))[owner], np.asarray(batch.column("__tag"))[owner]
            gone = _later(anchor, content, row, start)
            # Decided rows only travel along: a key of their own spreads them.
            key = np.where(gone, content ^ np.arange(len(gone)) ^ row ^ start, anchor)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, np.where(gone, 0, content), gone, row, tag, start << 6 | count - 1)], names)

    found = base.select("__row", "__tag", "__text").mapInArrow(run, "anchor long, content long, gone boolean, row long, tag long, at long")
    ordered = "partition by anchor, gone order by content, row, at"
    found = found.select(
        "*", F.expr(f"coalesce(lag(content) over ({ordered}) <> content, true)").alias("lone"),
        F.expr("first(row) over (partition by anchor, gone, content order by row, at)").alias("first_row"),
        F.expr("first(at) over (partition by anchor, gone, content order by row, at)").alias("first_at"))
    classes = F.expr("sum(int(lone)) over (partition by anchor, gone)")
    later = F.col("gone") | (F.col("row") > F.col("first_row")) | (F.col("at") > F.col("first_at"))
    kind = F.when(later, "gone").when(F.col("lone") & (classes > HOT_PASSAGES), "hot").when(F.col("lone") & (classes > 1), "compare")
    found = found.select("anchor", "row", "tag", "at", kind.alias("kind")).where("kind is not null")
    return settle(found.withColumn("anchor", F.expr("if(kind = 'gone', null, anchor)")))


def bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary or string column side by side, and where each value begins in them, the end of the last included."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    every = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
    return every, offsets - offsets[0]


def cut_out(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    """The slices of ``data`` as a binary column."""
    offsets = np.append(0, np.cumsum(size)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data[ranges(begin, size)])])


def shard_runs(data: np.ndarray, begin: np.ndarray, doc: np.ndarray, start: np.ndarray, length: int):
    """For passages side by side: (passage, first string, strings) of runs of strings that occur earlier in the shard."""
    size = np.diff(begin)
    begin = (begin[:-1] + np.arange(len(size))).astype(np.int32)
    # A zero ends each passage; the bytes of UTF-8 are all below 255.
    text = np.zeros(len(data) + len(size), np.uint8)
    text[ranges(begin.astype(np.int64), size)] = data + np.uint8(1)
    sa = suffix_array(text, length)
    group = np.cumsum(permuted_prefixes(text, sa, length) < length, dtype=np.int32)
    piece = np.searchsorted(begin, sa, side="right").astype(np.int32) - np.int32(1)
    inside = sa - begin[piece] + length <= size[piece]
    sa, group, piece = sa[inside], group[inside], piece[inside]
    # Strings that are alone need no order.
    several = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
    sa, group, piece = sa[several], group[several], piece[several]
    by, later = _earliest(group, doc[piece], start[piece] + (sa - begin[piece]))
    at = np.sort(sa[by][later])
    if not len(at):
        return np.zeros((3, 0), np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1] + 1))
    which = np.searchsorted(begin, at[first], side="right") - 1
    return np.array([which, at[first] - begin[which], np.diff(np.append(first, len(at)))], np.int64)


_PASSAGES = "anchor long, row long, tag long, start long, bytes binary"
_RUNS = "row long, tag long, start long, size long"


def in_shards(rows: DataFrame, length: int) -> DataFrame:
    """Runs (row, tag, start, size) that occur earlier among the passages of their anchor; whole anchors share a suffix array."""
    def verdict(held):
        shard = pa.Table.from_batches(held)
        row, tag, start = (shard.column(c).to_numpy() for c in ("row", "tag", "start"))
        which, first, count = shard_runs(*bytes_of(shard.column("bytes")), row, start, length)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (row[which], tag[which], start[which] + first, count + length - 1)], ["row", "tag", "start", "size"])

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor = batch.column(0).to_numpy()
            width = pc.binary_length(batch.column("bytes")).to_numpy(zero_copy_only=False).astype(np.int64)
            new = np.flatnonzero(np.append(last is not None and anchor[0] != last, anchor[1:] != anchor[:-1]))
            begin, last = 0, anchor[-1]
            while begin < len(anchor):
                full = begin + np.searchsorted(np.cumsum(width[begin:]), SHARD_BYTES - size)
                k = np.searchsorted(new, begin if size >= SHARD_BYTES else full + 1)
                end = new[k] if k < len(new) else len(anchor)
                held.append(batch.slice(begin, end - begin))
                size += int(width[begin:end].sum())
                if k < len(new):
                    yield verdict(held)
                    held, size = [], 0
                begin = end
        if held:
            yield verdict(held)

    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _RUNS)


def placed(rows: DataFrame, length: int) -> DataFrame:
    """``rows`` with place, where the anchor begins in the passage: the first gram of its hash."""
    def run(batches):
        table = _gram_table()
        for batch in (cut for whole in batches for cut in pieces(whole, SHARD_BYTES, "bytes")):
            data, begin = bytes_of(batch.column("bytes"))
            grams = _grams(data, table, GRAM).view(np.int64)
            window = length - GRAM + 1
            same = grams[begin[:-1, None] + np.arange(window)] == batch.column("anchor").to_numpy()[:, None]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(same.argmax(axis=1))], [*batch.schema.names, "place"])

    return rows.mapInArrow(run, _PASSAGES + ", place long")


def widened(rows: DataFrame, length: int, width: int, more: int) -> DataFrame:
    """Passages by anchors of ``more`` further bytes: strings with that many bytes before the old anchor, and the others with as many behind it."""
    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in (cut for whole in batches for cut in pieces(whole, SHARD_BYTES, "bytes")):
            data, begin = bytes_of(batch.column("bytes"))
            place, start = batch.column("place").to_numpy(), batch.column("start").to_numpy()
            strings = np.diff(begin) - length + 1
            # String s has place - s bytes before the anchor.
            split = np.clip(place - more + 1, 0, strings)
            for low, high, front in ((np.zeros_like(split), split, more), (split, strings, 0)):
                some = np.flatnonzero(low < high)
                at, low, high = begin[some] + place[some] - front, low[some], high[some]
                key = np.fromiter((digest(data[a:a + width + more].tobytes(), seed=front + 1) for a in at.tolist()), np.uint64, len(some))
                same = [batch.column(c).take(pa.array(some)) for c in ("row", "tag")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), *same, pa.array(start[some] + low), cut_out(data, begin[some] + low, high - low + length - 1),
                     pa.array(place[some] - front - low)], ["anchor", "row", "tag", "start", "bytes", "place"])

    return rows.mapInArrow(run, _PASSAGES + ", place long")


def in_wider_shards(rows: DataFrame, length: int) -> DataFrame:
    """Runs (row, tag, start, size) of hot anchors, whose anchors grow until their passages fit into shards.

    On the way, of equal passages of an anchor the earliest stands for all. An anchor as wide as a string has one passage.
    """
    width, rows, runs = GRAM, placed(rows, length), None
    while width < length:
        more = (length - width + 1) // 2
        wide = settle(widened(rows, length, width, more))
        width += more
        place = F.struct("row", "start")
        known = wide.join(wide.groupBy("anchor", "bytes").agg(F.min(place).alias("first")), ["anchor", "bytes"])
        gone = known.where(place > F.col("first")).select("row", "tag", "start", F.length("bytes").cast("long").alias("size"))
        left = known.where(place <= F.col("first")).select("anchor", "row", "tag", "start", "bytes", "place")
        left = settle(left.join(left.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")), "anchor").where("n > 1"))
        rows = left.where(F.col("n") > HOT_PASSAGES).select(*wide.columns)
        fit = left.where(F.col("n") <= HOT_PASSAGES).select(*wide.columns[:-1])
        runs = [*(runs or ()), gone, in_shards(fit, length)]
        if rows.isEmpty():
            break
    return reduce(DataFrame.unionByName, runs)


def fetched(base: DataFrame, asked: DataFrame, text_col: str, length: int) -> DataFrame:
    """The ``asked`` passages (row, tag, anchor, at) with their bytes."""
    lists = asked.groupBy(F.col("row").alias("__row"), F.col("tag").alias("__tag")).agg(F.collect_set(F.struct("anchor", "at")).alias("__asked"))

    def run(batches):
        for batch in (cut for whole in batches for cut in pieces(whole, CUT_BYTES, text_col)):
            asked = batch.column("__asked")
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(asked).to_numpy(zero_copy_only=False))
            asked = asked.flatten()
            at = asked.field("at").to_numpy()
            yield from _with_bytes(batch, text_col, owner, asked.field("anchor").to_numpy(), at >> 6, (at & 63) + length)

    # Repeated rows share their lists and verdicts, so one of them is read.
    return base.join(lists, ["__row", "__tag"]).dropDuplicates(["__row", "__tag"]).mapInArrow(run, _PASSAGES)


def _with_bytes(batch: pa.RecordBatch, text_col: str, owner: np.ndarray, anchor: np.ndarray, start: np.ndarray, size: np.ndarray):
    data, begin = bytes_of(batch.column(text_col))
    row, tag = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("__row", "__tag"))
    for some in np.split(np.arange(len(owner)), range(FETCHED, len(owner), FETCHED)):
        who = owner[some]
        columns = [pa.array(x) for x in (anchor[some], row[who], tag[who], start[some])]
        yield pa.RecordBatch.from_arrays([*columns, cut_out(data, begin[who] + start[some], size[some])], ["anchor", "row", "tag", "start", "bytes"])


def of_anchors(base: DataFrame, wanted: np.ndarray, text_col: str, length: int) -> DataFrame:
    """The passages of the ``wanted`` anchors (sorted) with their bytes, but those with an earlier copy in the same piece: these are gone already."""
    def run(batches):
        for batch in (cut for whole in batches for cut in pieces(whole, CUT_BYTES, text_col)):
            owner, start, count, anchor, content = passages(texts_of(batch.column(text_col)), length, wanted=wanted)
            row, tag = np.asarray(batch.column("__row")), np.asarray(batch.column("__tag"))
            # Repeated rows share their verdicts, so one of them is read.
            first = np.unique(np.stack([row, tag], axis=1), axis=0, return_index=True)[1]
            some = np.flatnonzero(np.isin(owner, first) & ~_later(anchor, content, row[owner], start))
            yield from _with_bytes(batch, text_col, owner[some], anchor[some], start[some], count[some] + length - 1)

    return base.mapInArrow(run, _PASSAGES)


def compared(base: DataFrame, found: DataFrame, text_col: str, length: int) -> DataFrame:
    """Runs (row, tag, start, size) that the suffix arrays find repeated.

    The driver hands the hot anchors on, eight bytes for every HOT_PASSAGES different passages.
    """
    runs = in_shards(fetched(base, found.where("kind = 'compare'"), text_col, length), length)
    hot = np.sort(np.array([r["anchor"] for r in found.where("kind = 'hot'").select("anchor").distinct().collect()], np.int64))
    if len(hot):
        texts = base.select("__row", "__tag", F.col(f"`{text_col}`").alias("__text"))
        runs = runs.unionByName(in_wider_shards(of_anchors(texts, hot, "__text", length), length))
    return runs


def with_runs(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """``docs``, its text a string, with __runs, the (start, size) of the repeated runs, not united, null where there are none; and what it is joined by."""
    text = F.col(f"`{text_col}`").cast("string")
    base = docs.withColumn(text_col, text).select(
        "*", F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(int(_LOW))).alias("__row"), F.xxhash64(F.col(f"`{text_col}`")).alias("__tag"),
        F.col(f"`{id_col}`").cast("long").alias("__doc"))
    found = marked(base.select("__row", "__tag", F.col(f"`{text_col}`").alias("__text")), length)
    gone = found.where("kind = 'gone'").select("row", "tag", F.shiftright("at", 6).alias("start"), ((F.col("at").bitwiseAND(63)) + length).alias("size"))
    runs = gone.unionByName(compared(base, found, text_col, length)).groupBy(F.col("row").alias("__row"), F.col("tag").alias("__tag")).agg(
        F.collect_set(F.struct("start", "size")).alias("__runs"))
    return base.join(runs, ["__row", "__tag"], "left")


def united(runs) -> list[tuple[int, int]]:
    """Maximal runs (start, end)."""
    out: list[list[int]] = []
    for a, b in sorted((r["start"], r["start"] + r["size"]) for r in runs or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def without(raw: bytes, runs) -> bytes:
    parts, end = [], 0
    for a, b in runs:
        parts.append(raw[end:a])
        end = b
    return b"".join([*parts, raw[end:]])


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, starts and ends of the maximal removed runs, kept (binary), kept_sha256.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document of
    smaller doc_id, or earlier in a document of the same doc_id. Documents without id come before all
    others. Null texts are empty; repeated rows share their id and start, so neither is earlier.
    """
    def run(batches):
        for batch in (cut for whole in batches for cut in pieces(whole, CUT_BYTES)):
            raws = texts_of(batch.column("text"))
            spans = [united(r) for r in batch.column("__runs").to_pylist()]
            kept = [without(raw, s) for raw, s in zip(raws, spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__doc"), pa.array([len(r) for r in raws], pa.int64()), pa.array([[a for a, _ in s] for s in spans], pa.list_(pa.int64())),
                 pa.array([[b for _, b in s] for s in spans], pa.list_(pa.int64())), pa.array(kept, pa.binary()), pa.array([sha256_hex(k) for k in kept], pa.string())],
                ["doc_id", "n_bytes", "starts", "ends", "kept", "kept_sha256"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_runs(slim, "doc_id", "text", length).mapInArrow(
        run, "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary, kept_sha256 string")


def whole_characters(raw: bytes, runs):
    """The runs, each narrowed to characters that lie in it completely."""
    for a, b in runs:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            yield a, b


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with all columns, repeated runs cut from the texts at whole characters; documents of which nothing but white space is left go.

    Null and untouched texts stay as they are.
    """
    place, names = docs.columns.index(text_col), docs.columns
    schema = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string")).schema

    def run(batches):
        for batch in (cut for whole in batches for cut in pieces(whole, CUT_BYTES, text_col)):
            texts, keep = batch.column(place).to_pylist(), []
            for i, runs in enumerate(batch.column("__runs").to_pylist()):
                if runs:
                    raw = texts[i].encode()
                    texts[i] = without(raw, whole_characters(raw, united(runs))).decode()
                keep.append(not runs or not not texts[i].strip())
            columns = [pa.array(texts, pa.string()) if k == place else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep, pa.bool_()))

    joined = with_runs(docs, id_col, text_col, length)
    return joined.select(*[F.col(f"`{c}`") for c in names], "__runs").mapInArrow(run, schema)


def digest(found: DataFrame) -> DataFrame:
    removed = F.expr("aggregate(zip_with(ends, starts, (b, a) -> b - a), 0L, (s, x) -> s + x)")
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), "kept_sha256")
