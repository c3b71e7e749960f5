"""Spelling variants: words one edit apart, and the commoner form that each follows."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts_for, pieces, settle

RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2

#: Distinct words that a counting task holds before it passes them on.
HELD_WORDS = 200_000
#: Words on a side of a tile; groups above GROUP words leave their task as blocks.
TILE, GROUP = 128, 2048
#: Code points compared at once in a tile, however long the words.
TILE_CELLS = 1 << 18
#: Groups of so few words, each this short at most, are compared together.
FEW, SHORT = 24, 64
#: A word is cut into so many pieces; an edit touches one of them, the others agree.
PIECES = 3
#: Group rows of one task.
TASK_ROWS = 200_000


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: str = RUN, damage: int | None = 97) -> DataFrame:
    """(word, n): runs of the whole texts, A-Z lower-cased, with their occurrences.

    With ``damage``, a run loses its code point number h modulo its length wherever ``damage`` divides h, the crc32 of
    ``<doc_id>:<run>`` (a missing id is empty); the same run of a document always fares alike. A null text has no runs.
    """
    pattern = re.compile(run)

    def count(batches):
        held: dict[str, int] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        for batch in batches:
            for piece in pieces(batch, 1 << 21):
                for name, text in zip(piece.column("id").to_pylist(), piece.column("text").to_pylist()):
                    if not text:
                        continue
                    here: dict[str, int] = {}
                    for word in pattern.findall(text.encode().lower().decode()):
                        here[word] = here.get(word, 0) + 1
                    start = zlib.crc32(f"{name or ''}:".encode())
                    for word, n in here.items():
                        if damage:
                            h = zlib.crc32(word.encode(), start)
                            if h % damage == 0:
                                cut = h % len(word)
                                word = word[:cut] + word[cut + 1:]
                        held[word] = held.get(word, 0) + n
                    if len(held) > HELD_WORDS:
                        yield out()
                        held.clear()
        if held:
            yield out()

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _keyed(words: DataFrame) -> DataFrame:
    """(key, piece, base, longer, word, n): a word once per piece that an edit may touch, as the shorter and as the longer of a pair.

    ``base`` is the length of the shorter word and sets where pieces begin. What lies before and after the piece is the key, so
    words that differ by one edit meet under the piece that holds the edit. Words shorter than their pieces are no exception:
    an empty piece only has insertions.
    """
    length = F.length("word")

    def key(longer: int, piece: int) -> Column:
        base = length - longer
        first, then = F.floor(base * piece / PIECES).cast("int"), F.floor(base * (piece + 1) / PIECES).cast("int")
        tail = base - then
        return F.struct(
            F.concat_ws(":", base.cast("string"), F.lit(str(piece)), F.substring(F.col("word"), F.lit(1), first), F.substring(F.col("word"), length - tail + 1, tail)).alias("key"),
            F.lit(piece).alias("piece"), base.alias("base"), F.lit(bool(longer)).alias("longer"))
    keys = F.explode(F.array(*[key(longer, piece) for longer in (0, 1) for piece in range(PIECES)]))
    return words.select("word", "n", keys.alias("k")).select("k.*", "word", "n").where("base >= 0")


class Matrix:
    """Words as padded rows of code points, forwards and backwards."""

    def __init__(self, words: list[str], width: int):
        size = np.array([len(w) for w in words], np.int32)
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        row, start = np.repeat(np.arange(len(words)), size), np.cumsum(size) - size
        column = np.arange(len(flat)) - np.repeat(start, size)
        # The column after the longest word stays padding, at which every comparison ends.
        self.size, self.forth, self.back = size, np.zeros((len(words), width + 1), np.uint32), np.zeros((len(words), width + 1), np.uint32)
        self.forth[row, column] = flat
        self.back[row, np.repeat(size, size) - 1 - column] = flat


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common leading code points along the last axis; padding counts for none."""
    return np.argmin((a == b) & (a != 0), -1)


def _edits(prefix, suffix, size_a, size_b, longer_a, longer_b, base, piece):
    """Pairs one edit apart whose first agreeing piece is this one, so that every pair is found once."""
    longest = np.maximum(size_a, size_b)
    near = (prefix + suffix >= longest - 1) & ~(longer_a & longer_b)
    first = np.full(near.shape, PIECES)
    for i in range(PIECES - 1, -1, -1):
        fits = (prefix >= base * i // PIECES) & (suffix >= base - base * (i + 1) // PIECES)
        first = np.where(fits, i, first)
    return near & (first == piece)


def _tile(a: Matrix, b: Matrix, rows: slice, others: slice, longer_a, longer_b, base: int, piece: int):
    """Row pairs of one tile that are one edit apart."""
    prefix = _shared(a.forth[rows, None, :], b.forth[None, others, :])
    suffix = _shared(a.back[rows, None, :], b.back[None, others, :])
    near = _edits(prefix, suffix, a.size[rows, None], b.size[None, others], longer_a[rows, None], longer_b[None, others], base, piece)
    i, j = np.nonzero(near)
    return i + rows.start, j + others.start


def _tiles(a: Matrix, b: Matrix, longer_a, longer_b, base: int, piece: int, same: bool):
    """All tiles of two blocks; of a block with itself only the pairs above the diagonal. Tiles of very long words are smaller."""
    side = max(1, min(TILE, int((TILE_CELLS / a.forth.shape[1]) ** 0.5)))
    left, right = [], []
    for r in range(0, len(a.size), side):
        for c in range(r if same else 0, len(b.size), side):
            i, j = _tile(a, b, slice(r, r + side), slice(c, c + side), longer_a, longer_b, base, piece)
            if same and r == c:
                i, j = i[i < j], j[i < j]
            left.append(i)
            right.append(j)
    return np.concatenate(left), np.concatenate(right)


def _small_groups(m: Matrix, sizes: np.ndarray, longer, base, piece):
    """Pairs inside many small groups, one after the other in ``m``: every row against the row d places on."""
    at, end = np.arange(len(m.size)), np.repeat(np.cumsum(sizes), sizes)
    left, right = [], []
    for d in range(1, int(sizes.max())):
        i = at[at + d < end]
        near = _edits(_shared(m.forth[i], m.forth[i + d]), _shared(m.back[i], m.back[i + d]), m.size[i], m.size[i + d], longer[i], longer[i + d], base[i], piece[i])
        left.append(i[near])
        right.append(i[near] + d)
    return np.concatenate(left), np.concatenate(right)


_FOUND = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64()), ("key", pa.string()), ("piece", pa.int32()),
                    ("base", pa.int32()), ("block", pa.int32()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("longer", pa.list_(pa.bool_()))])
_FOUND_DDL = ("word string, n long, near string, near_n long, key string, piece int, base int, block int, "
              "words array<string>, counts array<long>, longer array<boolean>")


def _links(words, counts, i, j, other=None, other_counts=None) -> pa.RecordBatch:
    """Both directions of the found pairs."""
    other, other_counts = (words, counts) if other is None else (other, other_counts)
    a, b, na, nb = words.take(pa.array(i)), other.take(pa.array(j)), counts.take(pa.array(i)), other_counts.take(pa.array(j))
    both = [pa.concat_arrays(x) for x in ([a, b], [na, nb], [b, a], [nb, na])]
    return pa.RecordBatch.from_arrays(both + [pa.nulls(len(both[0]), f.type) for f in list(_FOUND)[4:]], schema=_FOUND)


def _compare_groups(batches):
    """Sorted group rows to links; a group above GROUP words to blocks of as many.

    Complete small groups are compared together; a larger one tile by tile. What is kept between batches is the last,
    perhaps unfinished, group, and of that at most GROUP words.
    """
    rest, spilled = None, None  # rows of the unfinished group; (key, blocks so far) once it overflowed

    def block(rows, number):
        k = rows.slice(0, 1).to_pylist()[0]
        return {"key": k["key"], "piece": k["piece"], "base": k["base"], "block": number, "words": rows.column("word").to_pylist(),
                "counts": rows.column("n").to_pylist(), "longer": rows.column("longer").to_pylist()}

    def compare(rows):
        if rows.num_rows < 2:
            return
        key = np.asarray(rows.column("key").to_pylist(), object)
        starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
        sizes = np.diff(np.concatenate([starts, [len(key)]]))
        texts, counts = rows.column("word"), rows.column("n")
        words = texts.to_pylist()
        longer, base, piece = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("longer", "base", "piece"))
        few = (sizes > 1) & (sizes <= FEW) & (base[starts] <= SHORT)
        if few.any():
            at = np.concatenate([np.arange(s, s + n) for s, n in zip(starts[few], sizes[few])])
            m = Matrix([words[i] for i in at], int(base[at].max()) + 1)
            i, j = _small_groups(m, sizes[few], longer[at], base[at], piece[at])
            if len(i):
                yield _links(texts, counts, at[i], at[j])
        alone = (sizes > 1) & ~few
        for s, n in zip(starts[alone], sizes[alone]):
            part = Matrix(words[s:s + n], int(base[s]) + 1)
            i, j = _tiles(part, part, longer[s:s + n], longer[s:s + n], int(base[s]), int(piece[s]), True)
            if len(i):
                yield _links(texts, counts, i + s, j + s)

    for batch in batches:
        rows = batch if rest is None else pa.concat_batches([rest, batch])
        key = rows.column("key")
        final = key[rows.num_rows - 1].as_py()
        cut = rows.num_rows - 1
        while cut and key[cut - 1].as_py() == final:
            cut -= 1
        done, rest = rows.slice(0, cut), rows.slice(cut)
        if spilled and (cut or spilled[0] != final):
            # The overflowed group ends in this batch.
            first = 0
            while first < cut and key[first].as_py() == spilled[0]:
                first += 1
            if first:
                yield pa.RecordBatch.from_pylist([block(done.slice(0, first), spilled[1])], _FOUND)
            done, spilled = done.slice(first), None
        large = []
        if done.num_rows:
            # A group above the bound may also begin and end inside one batch.
            names = np.asarray(done.column("key").to_pylist(), object)
            starts = np.concatenate([[0], np.flatnonzero(names[1:] != names[:-1]) + 1, [len(names)]])
            begin = 0
            for s, e in zip(starts[:-1], starts[1:]):
                if e - s > GROUP:
                    yield from compare(done.slice(begin, s - begin))
                    large += [block(done.slice(x, min(GROUP, e - x)), number) for number, x in enumerate(range(s, e, GROUP))]
                    begin = e
            yield from compare(done.slice(begin))
        while rest.num_rows >= GROUP + 1:
            number = spilled[1] if spilled else 0
            large.append(block(rest.slice(0, GROUP), number))
            spilled, rest = (final, number + 1), rest.slice(GROUP)
        if large:
            yield pa.RecordBatch.from_pylist(large, _FOUND)
    if rest is not None and rest.num_rows:
        if spilled:
            yield pa.RecordBatch.from_pylist([block(rest, spilled[1])], _FOUND)
        else:
            yield from compare(rest)


def _compare_blocks(batches):
    for batch in batches:
        for row in batch.to_pylist():
            same = row["block"] == row["other_block"]
            words, others = row["words"], row["other_words"]
            width = max(map(len, words + others))
            a, b = Matrix(words, width), Matrix(others, width)
            i, j = _tiles(a, b, np.array(row["longer"]), np.array(row["other_longer"]), row["base"], row["piece"], same)
            if len(i):
                yield _links(pa.array(words), pa.array(row["counts"], pa.int64()), i, j, pa.array(others), pa.array(row["other_counts"], pa.int64())).select([0, 1, 2, 3])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): for distinct (word, n) every pair that differs by one inserted, deleted or replaced code point, both ways.

    Words meet under what surrounds a third of them (``_keyed``). Inside such a group blocks of words are padded code-point
    matrices, compared tile by tile: common prefix plus common suffix reaching the longer length less one tells a single edit.
    A group above GROUP words is cut into blocks, and every pair of its blocks is a row of its own, so tasks stay bounded and
    only found pairs leave them. Both the empty and the one-letter word may be among the words.
    """
    spark = words.sparkSession
    rows = words.count() * 2 * PIECES
    found = settle(_keyed(words).repartition(parts_for(rows, TASK_ROWS, spark), "key").sortWithinPartitions("key", "longer", "word")
                   .select("key", "piece", "base", "longer", "word", "n").mapInArrow(_compare_groups, _FOUND_DDL))
    blocks = found.where("word is null").select("key", "piece", "base", "block", "words", "counts", "longer")
    others = blocks.select("key", *[F.col(c).alias("other_" + c) for c in ("block", "words", "counts", "longer")])
    # Blocks meet block by block: the narrow list of pairs first, then the words of either side.
    numbers = blocks.select("key", "block")
    pairs = numbers.join(numbers.select("key", F.col("block").alias("other_block")), "key").where("block <= other_block")
    pairs = pairs.join(blocks, ["key", "block"]).join(others, ["key", "other_block"])
    across = pairs.select("piece", "base", "block", "other_block", "words", "counts", "longer", "other_words", "other_counts", "other_longer")
    across = across.repartition(parts_for(None, 1, spark)).mapInArrow(_compare_blocks, "word string, n long, near string, near_n long")
    return found.where("word is not null").select("word", "n", "near", "near_n").unionByName(across)


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct (word, n).

    ``form`` is the near word of largest n (of equal ones the smallest in code-point order) if that is at least ``times`` the
    word's; ``root`` is where following forms ends. As n grows with every step by ``times`` (2 or more), paths are short and
    settle after a few doublings. No words, no rows.
    """
    if times < 2:
        raise ValueError("a form has at least twice the occurrences")
    words = settle(words.select("word", "n"))
    best = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    takes = -F.col("best.less") >= times * F.col("n")
    known = settle(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(takes, F.col("best.near")).alias("form"), F.when(takes, -F.col("best.less")).alias("form_n")))
    steps = known.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        steps = settle(steps.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")))
        if steps.where("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return known.join(steps.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int | None = 97) -> DataFrame:
    """``variants`` of the corpus' words of at least ``least_length`` code points and ``least_count`` occurrences.

    Null, empty and letterless texts have no words; repeated rows count each time; other columns are not read.
    """
    counts = word_counts(docs, id_col, text_col, damage=damage)
    return variants(counts.where((F.length("word") >= least_length) & (F.col("n") >= least_count)))
