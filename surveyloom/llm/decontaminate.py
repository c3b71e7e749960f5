"""Benchmark decontamination: a broadcast set of normalised test n-grams, scanned over all word windows."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keyed, settle, texts_of, word_bytes

WINDOW = 10
#: One broadcast slice of the benchmark, as it lies in memory; a larger benchmark is scanned slice by slice.
SLICE_BYTES = 64 << 20
#: Bytes a window takes (hash, place, word number, owner, edge) and a word beside its letters (object, number, table slot).
WINDOW_COST, WORD_COST = 32, 170

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
NORMALISE = word_bytes(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(ids: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` ids."""
    n = len(ids) - length + 1
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for k in range(length):
            h = (h ^ ids[k:k + n].astype(np.uint64)) * _ODD
            h ^= h >> np.uint64(29)
    return h


class Grams:
    """Windows of the benchmark items as arrays.

    ``words`` numbers the words, ``flat`` holds the items' numbers one after the other. For every window
    length there are the sorted hashes of the windows, a place in ``flat`` where each begins, and the
    items of each (``owners`` between two ``edges``). Equal windows are one entry.
    """

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.words: dict[bytes, int] = {}
        self.items = [i for i, _ in items]
        ids = [np.array([self.words.setdefault(w, len(self.words)) for w in text.translate(NORMALISE).split()], np.int32) for _, text in items]
        size = np.array([len(x) for x in ids], np.int64)
        begin = np.cumsum(size) - size
        self.flat = np.concatenate([*ids, np.zeros(0, np.int32)])
        self.by_length = {}
        for length in sorted({min(window, n) for n in size.tolist() if n}):
            those = np.flatnonzero(np.minimum(size, window) == length)
            count = size[those] - length + 1
            place = np.repeat(begin[those] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            owner = np.repeat(those, count).astype(np.int32)
            hashes = mixed(self.flat, length)[place]
            order = np.argsort(hashes, kind="stable")
            hashes, place, owner = hashes[order], place[order], owner[order]
            new = np.ones(len(place), bool)  # a window that differs from the one before in hash or words
            new[1:] = (hashes[1:] != hashes[:-1]) | ~self._alike(place[1:], self.flat, place[:-1], length)
            again = ~new
            again[1:] &= owner[1:] == owner[:-1]
            edges = np.append(np.cumsum(~again)[new] - 1, np.count_nonzero(~again))
            self.by_length[length] = hashes[new], place[new], owner[~again], edges

    def _alike(self, place: np.ndarray, other: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        alike = np.ones(len(place), bool)
        for k in range(length):
            alike &= self.flat[place + k] == other[at + k]
        return alike

    def scan(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged runs [start, end) of hit words, and the items whose windows occur. ``ids``: -1 for words no item has."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for length, (hashes, place, owners, edges) in self.by_length.items():
            if len(ids) < length:
                continue
            known = np.concatenate(([0], np.cumsum(ids >= 0)))
            at = np.flatnonzero(known[length:] - known[:-length] == length)
            if not len(at):
                continue
            h = mixed(ids, length)[at]
            low = np.searchsorted(hashes, h)
            high = np.searchsorted(hashes, h, side="right")
            while len(at):  # windows of one hash in turn; the words themselves decide, not their hash
                there = low < high
                at, low, high = at[there], low[there], high[there]
                same = self._alike(place[low], ids, at, length)
                spans += [(i, i + length) for i in at[same].tolist()]
                for entry in np.unique(low[same]).tolist():
                    items.update(owners[edges[entry]:edges[entry + 1]].tolist())
                low = low + 1
        return merged(spans), items


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def slices(benchmark: DataFrame, id_col: str, text_col: str, limit: int):
    """The benchmark's rows in lists whose ``Grams`` take about ``limit`` bytes (one longer item makes a list of its own)."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("binary").alias("t")).where("t is not null").distinct()
    part, size, seen = [], 0, set()
    for r in rows.toLocalIterator():
        words = bytes(r.t).translate(NORMALISE).split()
        new = set(words) - seen
        cost = WINDOW_COST * (len(words) + 1) + sum(WORD_COST + len(w) for w in new)
        if part and size + cost > limit:
            yield part
            part, size, seen = [], 0, set()
            cost, new = WINDOW_COST * (len(words) + 1) + sum(WORD_COST + len(w) for w in set(words)), set(words)
        part.append((r.i, bytes(r.t)))
        size += cost
        seen |= new
    yield part


FOUND = [("n_words", T.LongType(), pa.int64()), ("starts", T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
         ("ends", T.ArrayType(T.IntegerType()), pa.list_(pa.int32())), ("items", T.ArrayType(T.StringType()), pa.list_(pa.string()))]


def swept(rows: DataFrame, text_col: str, benchmark: DataFrame, finish, schema, window: int, item_col: str, item_text: str, slice_bytes: int) -> DataFrame:
    """``rows`` scanned for every slice of the benchmark, then given to ``finish(batch, found)``.

    ``found`` has n_words, starts, ends and items of each row. One slice is broadcast at a time: between
    two of them the rows go to a table of the shared folder with what was found so far, and the slice
    before is dropped.
    """
    width, place = len(rows.columns), rows.columns.index(text_col)
    mark = "_"
    while any(c.lower().startswith(mark) for c in rows.columns):
        mark += "_"
    between = T.StructType([*rows.schema.fields, *[T.StructField(mark + n, kind) for n, kind, _ in FOUND]])

    def carried(batch, found):
        columns = [pa.array(c, kind) for c, (_, _, kind) in zip(found, FOUND)]
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], between.names)

    def one(shared, last):
        def run(batches):
            grams = shared.value
            number = grams.words.get
            for batch in batches:
                before = [c.to_pylist() for c in batch.columns[width:]] if batch.num_columns > width else None
                found = [[], [], [], []]
                for k, text in enumerate(texts_of(batch.column(place))):
                    words = text.translate(NORMALISE).split()
                    spans, items = grams.scan(np.array([number(w, -1) for w in words], np.int32)) if words else ([], set())
                    names = {grams.items[i] for i in items} - {None}
                    if before:
                        spans = merged([*spans, *zip(before[1][k], before[2][k])])
                        names.update(before[3][k])
                    for column, value in zip(found, (len(words), [a for a, _ in spans], [b for _, b in spans], sorted(names))):
                        column.append(value)
                plain = pa.RecordBatch.from_arrays(batch.columns[:width], batch.schema.names[:width])
                yield finish(plain, found) if last else carried(plain, found)
        return run

    part, shared = None, None
    for after in slices(benchmark, item_col, item_text, slice_bytes):
        if part is not None:
            shared = rows.sparkSession.sparkContext.broadcast(Grams(part, window))
            rows = settle(rows.mapInArrow(one(shared, False), between))
            shared.destroy()
        part = after
    return rows.mapInArrow(one(rows.sparkSession.sparkContext.broadcast(Grams(part, window)), True), schema)


SCANNED = "doc_id long, tag long, n_words long, starts array<int>, ends array<int>, items array<string>"


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document: doc_id, tag, n_words, hit word runs [starts, ends) and the ids of the items found.

    The broadcast is bounded by ``slice_bytes``; beyond that the slices of the benchmark are scanned for
    one after the other. Hash hits are verified on the words. Null and empty texts have no words; an item
    without words finds nothing; repeated items count once by their id; windows of items without id hit,
    but name no item. Repeated document rows all appear.
    """
    def finish(batch, found):
        columns = [pa.array(c, kind) for c, (_, _, kind) in zip(found, FOUND)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "tag", *[n for n, _, _ in FOUND]])

    return swept(keyed(docs, id_col, text_col), "text", benchmark, finish, SCANNED, window, item_col, item_text, slice_bytes)


def cut(text: bytes, spans) -> bytes:
    """``text`` without the word runs, each from its first word's first byte to its last word's last."""
    at = [m.span() for m in WORD.finditer(text.lower())]
    parts, end = [], 0
    for a, b in spans:
        parts.append(text[end:at[a][0]])
        end = at[b - 1][1]
    return b"".join([*parts, text[end:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, drop_share: float = 0.5, window: int = WINDOW, text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with all columns, hit word runs cut from the text; rows with ``drop_share`` of their words hit go whole.

    Rows without a hit, null texts included, stay as they are. Windows that the cut brings together are
    not judged: all slices of a benchmark are scanned for before anything is cut.
    """
    place = docs.columns.index(text_col)

    def finish(batch, found):
        texts, keep = batch.column(place).to_pylist(), []
        for i, (n, starts, ends, _) in enumerate(zip(*found)):
            if starts:
                texts[i] = cut(texts[i].encode(), zip(starts, ends)).decode()
            keep.append(not starts or sum(ends) - sum(starts) < drop_share * n)
        columns = [pa.array(texts, pa.string()) if k == place else c for k, c in enumerate(batch.columns)]
        return pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array(keep, pa.bool_()))

    return swept(docs, text_col, benchmark, finish, docs.schema, window, item_col, item_text, slice_bytes)


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.expr("aggregate(zip_with(ends, starts, (b, a) -> b - a), 0, (s, x) -> s + x)").cast("long")
    return scanned.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                          F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
