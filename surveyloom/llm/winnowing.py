"""Document fingerprints by winnowing, and how alike neighbouring documents and edited copies are by them."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed, parts_for, pieces, settle

#: Characters of a hashed gram, and grams of a window: a passage of GRAM + WINDOW - 1 = 32 shared characters is always noticed.
GRAM, WINDOW = 16, 17

#: Grams hashed at once, which bounds the arrays of a long text.
STRETCH = 1 << 20
#: Text bytes of one range of documents.
RANGE_BYTES = 32 << 20

_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


class Winnower:
    """Selected gram hashes of a text.

    Whitespace is left out and A-Z folded. Grams are hashed by a rolling polynomial: sums of character times power, of which a
    gram is the difference of two, divided by the power of its start. Of every window the smallest hash is selected, the rightmost
    of equal ones, so a hash selected by several windows in a row counts once. Fewer characters than a gram are one gram; fewer
    grams than a window are one window.
    """

    def __init__(self, gram: int = GRAM, window: int = WINDOW):
        if gram < 1 or window < 1:
            raise ValueError("gram and window are at least 1")
        self.gram, self.window = gram, window
        self.power = self.inverse = np.ones(1, _U)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 2 * len(self.power))
            grow = lambda x: np.cumprod(np.concatenate([np.ones(1, _U), np.full(n - 1, x, _U)]))
            self.power, self.inverse = grow(_BASE), grow(pow(_BASE, -1, 1 << 64))

    def _hashes(self, codes: np.ndarray, gram: int) -> np.ndarray:
        """32-bit hashes of all grams."""
        n = len(codes)
        self._powers(n)
        sums = np.zeros(n + 1, _U)
        np.cumsum((codes.astype(_U) + _U(1)) * self.power[:n], out=sums[1:])
        h = (sums[gram:] - sums[:-gram]) * self.inverse[: n - gram + 1]
        h ^= h >> _U(33)
        h *= _U(0xFF51AFD7ED558CCD)
        h ^= h >> _U(29)
        h *= _U(0xC4CEB9FE1A85EC53)
        return h >> _U(32)

    def fingerprint(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(hashes as uint32, positions in code points of the text), in the order of the text."""
        codes = np.frombuffer((text or "").encode("utf-32-le"), np.uint32)
        codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
        at = np.flatnonzero((codes != 32) & ((codes < 9) | (codes > 13)))
        codes = codes[at]
        if not len(codes):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        gram = min(self.gram, len(codes))
        n = len(codes) - gram + 1
        window = min(self.window, n)
        found = []
        for a in range(0, n - window + 1, STRETCH):
            b = min(n, a + STRETCH + window - 1)
            # Smallest hash first, then the rightmost start.
            key = (self._hashes(codes[a: b + gram - 1], gram) << _U(32)) | (_U(0xFFFFFFFF) - np.arange(a, b, dtype=_U))
            span = 1
            while 2 * span <= window:
                key = np.minimum(key[:-span], key[span:])
                span *= 2
            if span < window:
                key = np.minimum(key[: len(key) - (window - span)], key[window - span:])
            found.append(key)
        key = np.concatenate(found)
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        return (key >> _U(32)).astype(np.uint32), at[(1 << 32) - 1 - (key & _U(0xFFFFFFFF)).astype(np.int64)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared share of two sets of distinct hashes; two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the beginning of the other."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(doc_id, tag, n_chars, hashes, positions) of every row; no shuffle.

    Null and blank texts select nothing. Repeated rows stay rows of their own; other columns are not read.
    """
    def run(batches):
        winnow = Winnower(gram, window)
        for batch in batches:
            for piece in pieces(batch, 1 << 21):
                texts = piece.column("text").to_pylist()
                found = [winnow.fingerprint(t) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), piece.column("tag"), pa.array([len(t or "") for t in texts], pa.int64()),
                    pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())), pa.array([p for _, p in found], pa.list_(pa.int64()))],
                    ["doc_id", "tag", "n_chars", "hashes", "positions"])
    return keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, tag long, n_chars long, hashes array<long>, positions array<long>")


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ROWS = _RESULT + ", part int, head boolean, text string"
_FIELDS = [f.split()[0] for f in _ROWS.split(", ")]
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
_ARROW = pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in _ROWS.split(", ")])


def _sign(hashes: np.ndarray) -> str:
    return hashlib.sha256(hashes.astype("<u4").tobytes()).hexdigest()


def _compared(winnow: Winnower, doc_id, text: str, following: str, own: np.ndarray, next_own: np.ndarray) -> dict:
    changed = edited(text, following)
    other = winnow.fingerprint(changed)[0]
    mine = np.unique(own)
    return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(), "fingerprint": _sign(own),
            "edited_fingerprint": _sign(other), "near_edited": likeness(mine, np.unique(other)), "near_next": likeness(mine, np.unique(next_own))}


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one row per row of ``docs``.

    A document is compared with the one after it and with its own edited text (``edited``). The order is that of the ids, missing
    ids first; rows of equal id follow in the order of their texts' hashes, and the first row of all follows the last, so a single
    row is its own neighbour. A null text is empty. Fingerprints are digests of the selected hashes in order; likeness is the
    shared share of the distinct hashes. Other columns are not read.

    Texts travel once, into sorted ranges. A task keeps two neighbouring texts; only the first and the last text of a range
    go on, to meet the ranges beside.
    """
    rows = keyed(docs, id_col, text_col)
    ranges = parts_for(rows.agg(F.sum(F.octet_length("text"))).first()[0], RANGE_BYTES, docs.sparkSession)

    def run(batches):
        winnow, part = Winnower(gram, window), TaskContext.get().partitionId()
        last = None
        for batch in batches:
            for piece in pieces(batch, 1 << 21):
                out = []
                for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                    text = text or ""
                    own = winnow.fingerprint(text)[0]
                    if last is None:
                        out.append({"doc_id": doc_id, "part": part, "head": True, "text": text})
                    else:
                        out.append(_compared(winnow, last[0], last[1], text, last[2], own))
                    last = doc_id, text, own
                yield pa.RecordBatch.from_pylist(out, _ARROW)
        if last is not None:
            yield pa.RecordBatch.from_pylist([{"doc_id": last[0], "part": part, "head": False, "text": last[1]}], _ARROW)

    def meet(batches):
        winnow = Winnower(gram, window)
        for batch in batches:
            for doc_id, text, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following"))):
                row = _compared(winnow, doc_id, text, following, winnow.fingerprint(text)[0], winnow.fingerprint(following)[0])
                yield pa.RecordBatch.from_pylist([row], pa.schema(list(_ARROW)[:7]))

    found = settle(rows.repartitionByRange(ranges, "doc_id", "tag").sortWithinPartitions("doc_id", "tag").mapInArrow(run, _ROWS))
    heads = found.where("head").select("part", F.col("text").alias("following"))
    # One narrow row per range.
    order = Window.orderBy("part")
    after = found.where("head").select("part").select(F.col("part").alias("before"), F.coalesce(F.lead("part").over(order), F.min("part").over(Window.partitionBy(F.lit(0)))).alias("part"))
    ends = found.where("not head").select("doc_id", "text", F.col("part").alias("before"))
    met = ends.join(after, "before").join(heads, "part").select("doc_id", "text", "following").mapInArrow(meet, _RESULT)
    return found.where("part is null").select(*_FIELDS[:7]).unionByName(met)
