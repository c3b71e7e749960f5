"""Suffix arrays by induced sorting, in whole numpy arrays.

Suffixes are classified (S: smaller than the next, L: larger), the leftmost S suffixes of every run (LMS)
are sorted by their substrings, and the order of all others is induced from them. Where the sequential
algorithm moves one suffix at a time, a bucket is taken here generation by generation: the suffixes that
are final in it, then those of the same first byte that these induced, and so on. Each generation is
appended to the buckets of the preceding bytes by one stable sort, which keeps the order of the scan.
"""

from __future__ import annotations

import numpy as np


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True for S; the end of the text is smaller than any byte, so the last suffix is L."""
    n = len(text)
    if n < 2:
        return np.zeros(n, bool)
    at = np.where(text[:-1] != text[1:], np.arange(n - 1), n - 1)
    after = np.minimum.accumulate(at[::-1])[::-1]
    rises = np.append(text[:-1] < text[1:], False)
    return np.append(rises[after], False)


def induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, given the LMS suffixes in order (or in any order, to sort their substrings)."""
    n = len(text)
    size = np.bincount(text, minlength=256)
    start = np.cumsum(size) - size
    end = start + size
    large = np.bincount(text[~small], minlength=256)
    sa = np.empty(n, np.int32)

    def append(at: np.ndarray, place: np.ndarray, down: bool) -> None:
        if not len(at):
            return
        first = text[at]
        by = np.argsort(first, kind="stable")
        first = first[by]
        count = np.bincount(first, minlength=256)
        rank = np.arange(len(at)) - (np.cumsum(count) - count)[first]
        if down:
            sa[place[first] - 1 - rank] = at[by]
            place -= count
        else:
            sa[place[first] + rank] = at[by]
            place += count

    seeds = lms[np.argsort(text[lms], kind="stable")]
    seed_end = np.cumsum(np.bincount(text[lms], minlength=256))
    head = start.copy()
    append(np.array([n - 1]), head, False)
    for c in np.flatnonzero(size):
        low = start[c]
        while low < head[c]:
            generation, low = sa[low:head[c]], head[c]
            before = generation[generation > 0] - 1
            append(before[~small[before]], head, False)
        append(seeds[seed_end[c - 1] if c else 0:seed_end[c]] - 1, head, False)
    tail = end.copy()
    for c in np.flatnonzero(size)[::-1]:
        high = end[c]
        while tail[c] < high:
            generation, high = sa[tail[c]:high][::-1], tail[c]
            before = generation[generation > 0] - 1
            append(before[small[before]], tail, True)
        generation = sa[start[c]:start[c] + large[c]][::-1]
        before = generation[generation > 0] - 1
        append(before[small[before]], tail, True)
    return sa


def words_of(text: np.ndarray) -> np.ndarray:
    """The eight bytes at every position as one integer; zeros after the end."""
    padded = np.concatenate((text, np.zeros(160, np.uint8)))
    return np.ndarray((len(padded) - 8,), "<u8", padded, strides=(1,))


def same_bytes(words: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether length[i] bytes at a[i] and b[i] are equal."""
    same = np.ones(len(a), bool)
    left, offset = np.arange(len(a)), 0
    while len(left):
        rest = np.minimum(length[left] - offset, 8).astype(np.uint64)
        mask = np.where(rest == 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (rest * np.uint64(8))) - np.uint64(1))
        equal = (words[np.minimum(a[left] + offset, len(words) - 1)] ^ words[np.minimum(b[left] + offset, len(words) - 1)]) & mask == 0
        same[left[~equal]] = False
        offset += 8
        left = left[equal]
        left = left[length[left] > offset]
    return same


def sorted_names(names: np.ndarray, depth: int | None) -> np.ndarray:
    """Suffix order of a string of names by doubling the compared length; names that are alone are done.

    Stops once ``depth`` names are compared (None: never early).
    """
    n = len(names)
    count = np.bincount(names)
    rank = (np.cumsum(count) - count)[names].astype(np.int64)
    open_ = np.flatnonzero(count[names] > 1)
    step = 1
    while len(open_) and (depth is None or step < depth):
        ahead = open_ + step
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + second
        by = np.argsort(key)
        at, key, group = open_[by], key[by], rank[open_][by]
        place = np.arange(len(at))
        new_group = np.append(True, group[1:] != group[:-1])
        new_key = np.append(True, key[1:] != key[:-1])
        first = np.maximum.accumulate(np.where(new_key, place, 0))
        rank[at] = group + first - np.maximum.accumulate(np.where(new_group, place, 0))
        alone = new_key & np.append(new_key[1:], True)
        open_, step = np.sort(at[~alone]), step * 2
    return np.argsort(rank, kind="stable")


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffixes of a uint8 array in order. With ``depth``, suffixes that agree on that many bytes may come in any order."""
    text = np.ascontiguousarray(text, np.uint8)
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    small = suffix_types(text)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    sa = induce(text, small, lms)
    if len(lms) < 2:
        return sa
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = sa[is_lms[sa]]
    number = np.zeros(n, np.int32)
    number[lms] = np.arange(len(lms))
    length = np.append(np.diff(lms) + 1, n - lms[-1])
    one, two = ordered[:-1], ordered[1:]
    size = length[number[two]]
    equal = (length[number[one]] == size) & (one != lms[-1]) & (two != lms[-1])
    at = np.flatnonzero(equal)
    equal[at] = same_bytes(words_of(text), one[at].astype(np.int64), two[at].astype(np.int64), size[at])
    name = np.append(0, np.cumsum(~equal))
    if name[-1] + 1 == len(lms):
        return induce(text, small, ordered)
    reduced = np.empty(len(lms), np.int64)
    reduced[number[ordered]] = name
    # An LMS substring moves on by two bytes at least.
    order = sorted_names(reduced, None if depth is None else depth // 2 + 1)
    return induce(text, small, lms[order])


def common_prefix(words: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Equal bytes at the front of a[i] and b[i], at most ``limit``; zeros follow the text."""
    out = np.full(len(a), limit, np.int32)
    left, offset = np.arange(len(a), dtype=np.int32), 0
    while len(left) and offset < limit:
        differ = words[np.minimum(a[left] + offset, len(words) - 1)] ^ words[np.minimum(b[left] + offset, len(words) - 1)]
        low = differ & (~differ + np.uint64(1))
        ends = differ != 0
        # The lowest set bit lies in the first byte that differs.
        out[left[ends]] = np.minimum(offset + np.log2(low[ends].astype(np.float64)).astype(np.int32) // 8, limit)
        left, offset = left[~ends], offset + 8
    return out


def permuted_prefixes(text: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """In suffix order: bytes in common with the suffix before, at most ``limit``.

    Compared in text order (the permuted common-prefix array), so that reads of one side run through the text.
    """
    n = len(sa)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    at = np.flatnonzero(before >= 0).astype(np.int32)
    long = np.zeros(n, np.int32)
    found = common_prefix(words_of(text), at, before[at], limit)
    long[at] = np.minimum(found, n - np.maximum(at, before[at]))
    return long[sa]
