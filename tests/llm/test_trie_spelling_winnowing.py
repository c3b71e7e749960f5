"""Conversation tries, spelling variants and fingerprints against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from surveyloom.llm import catalog, prefix_trie, spelling, winnowing

TURNS = "conv_id long, turn long, role string, text string"


def plain_trie(convs):
    """The definition: every prefix of every (conv_id, [(role, text)])."""
    members, chars = defaultdict(list), {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in m if tuple(convs[c]) == p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], sum(not children[q] for q in below),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_turns(seed, n, words=3, deep=7):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant"]), "x" * r.randrange(1, words + 1)) for c in range(n) for t in range(r.randrange(1, deep))]


def grouped(turns):
    convs = defaultdict(list)
    for c, t, role, text in sorted(turns, key=lambda x: (x[0], x[1])):
        convs[c].append((role, text))
    return convs


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_trie_over_any_number_of_shards(spark, monkeypatch, shards):
    """Shards that cut through shared prefixes merge to the same nodes."""
    turns = random_turns(5, 120) + [(c, t, "user", "same") for c in range(500, 560) for t in range(3)] + [(900, t, "user", str(t)) for t in range(100)]
    monkeypatch.setattr(prefix_trie, "parts_for", lambda *a: shards)
    found = prefix_trie.prefix_trie(spark.createDataFrame(turns, TURNS))
    assert found.columns == prefix_trie.RESULT and rows(found) == plain_trie(grouped(turns))


def test_trie_ends_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ID_PIECE", 7)
    turns = [(c, 0, "user", "same") for c in range(100)] + [(-3, 0, "user", "same"), (-3, 1, "a", "")]
    assert rows(prefix_trie.prefix_trie(spark.createDataFrame(turns, TURNS))) == plain_trie(grouped(turns))


def test_trie_of_awkward_rows(spark):
    turns = [(1, None, "u", "a"), (1, 0, None, "b"), (2, None, "u", "a"), (2, 0, "", "b"), (2, 0, "", "b"), (None, 1, "u", "lost"), (3, 1, "u", None), (4, 1, "u", ""), (5, 1, "u", "é😀" * 20000), (6, 1, "u", "é😀" * 20000)]
    extra = spark.createDataFrame([(*t, 1, 2, 3) for t in turns], TURNS + ", seq long, path long, name long")
    convs = {1: [("u", "a"), ("", "b")], 2: [("u", "a"), ("", "b"), ("", "b")], 3: [("u", "")], 4: [("u", "")], 5: [("u", "é😀" * 20000)], 6: [("u", "é😀" * 20000)]}
    assert rows(prefix_trie.prefix_trie(extra)) == plain_trie(convs)
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_turnless_conversations_end_at_the_root(spark):
    from pyspark.sql import functions as F
    turns = [(c, t, "u", f"{t}") for c in (0, 1, 7, 203) for t in range(c % 3 + 1)]
    seqs = prefix_trie.branched(prefix_trie.sequences(spark.createDataFrame(turns, TURNS)), F.col("conv_id") - F.col("conv_id") % 100, F.lit(2), 5)
    own = grouped(turns)
    convs = {c: list(own.get(c - c % 100, [])[:2]) + own[c][2:] for c in list(own)}
    assert convs[203] == [("u", "2")] or convs[203] == []
    assert rows(prefix_trie.prefix_nodes(seqs)) == plain_trie(convs)


def test_double_array_holds_every_transition():
    r = np.random.default_rng(2)
    trie, edges, frontier = prefix_trie.DoubleArray(4), {}, [0]
    for _ in range(4):
        new = []
        pairs = sorted({(s, int(c)) for s in frontier for c in r.integers(0, 200, r.integers(1, 5))})
        s, c = (np.array(x, np.int64) for x in zip(*pairs))
        trie.add(s, c)
        to = trie.step(s, c)
        assert len(set(to.tolist())) == len(to) and (to > 0).all()
        edges |= {p: int(t) for p, t in zip(pairs, to)}
        frontier = to.tolist()
    states = sorted({0, *edges.values()})
    assert len(states) == len(edges) + 1
    for s in states:
        got = trie.step(np.full(200, s), np.arange(200))
        assert got.tolist() == [edges.get((s, c), -1) for c in range(200)]


def plain_words(docs):
    import re
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = run.encode().lower().decode()
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            counts[low[:h % len(low)] + low[h % len(low) + 1:] if h % 97 == 0 else low] += 1
    return counts


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(n):
    by_shape = defaultdict(set)
    for w in n:
        for i in range(len(w) + 1):
            by_shape[w[:i] + "*" + w[i:]].add(w)
            if i < len(w):
                by_shape[w[:i] + "*" + w[i + 1:]].add(w)
    near = defaultdict(set)
    for group in by_shape.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] is not None else None))
    return sorted(out, key=str)


def test_variants_of_the_corpus(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    n = plain_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    found = catalog.QUERIES["op12_spelling_variants"](spark, data_dir)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"] and rows(found) == plain_variants(n)


@pytest.mark.parametrize("group", [3, 40, 2048])
def test_variants_in_blocks(spark, monkeypatch, group):
    """A group that leaves its task as blocks of any size gives the same links, found once."""
    r = random.Random(4)
    monkeypatch.setattr(spelling, "GROUP", group)
    monkeypatch.setattr(spelling, "FEW", 6)
    n = {"".join(r.choice("abé") for _ in range(r.randrange(0, 8))): r.randrange(1, 50) for _ in range(900)}
    n |= {"z" * k + x: k for k in (70, 71) for x in ("", "a", "b")}
    found = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert rows(found) == plain_variants(n)


def test_words_of_awkward_rows(spark, clashing, no_docs):
    want = plain_words([(r.doc_id, r.text) for r in clashing.collect()])
    assert {r.word: r.n for r in spelling.word_counts(clashing).collect()} == want
    n = {w: c for w, c in want.items() if len(w) >= 5 and c >= 3}
    assert rows(spelling.spelling_variants(clashing)) == plain_variants(n)
    assert spelling.spelling_variants(no_docs).count() == 0


def plain_selection(text, gram, window):
    """Window by window: smallest hash, rightmost of equal ones."""
    winnow = winnowing.Winnower(gram, window)
    kept = [(i, c) for i, c in enumerate(text) if c not in " \t\n\x0b\x0c\r"]
    if not kept:
        return []
    chars = "".join(c for _, c in kept)
    size = min(gram, len(chars))
    hashes = [int(winnow._hashes(np.array([ord(c) + 32 * ("A" <= c <= "Z") for c in chars[i:i + size]], np.uint32), size)[0]) for i in range(len(chars) - size + 1)]
    width, chosen = min(window, len(hashes)), []
    for i in range(len(hashes) - width + 1):
        at = max(range(i, i + width), key=lambda j: (-hashes[j], j))
        if not chosen or chosen[-1] != at:
            chosen.append(at)
    return [(hashes[i], kept[i][0]) for i in chosen]


@pytest.mark.parametrize("gram,window", [(1, 1), (3, 4), (16, 17), (5, 1)])
def test_selection(monkeypatch, gram, window):
    r = random.Random(7)
    monkeypatch.setattr(winnowing, "STRETCH", 50)
    for text in ["", " \n", "a", "aB a", "ab" * 90, "x" * 400, *["".join(r.choice("abC é😀\n") for _ in range(r.randrange(300))) for _ in range(40)]]:
        hashes, at = winnowing.Winnower(gram, window).fingerprint(text)
        assert list(zip(hashes.tolist(), at.tolist())) == plain_selection(text, gram, window)


def test_shared_passages_are_noticed():
    r = random.Random(1)
    winnow = winnowing.Winnower()
    for _ in range(50):
        passage, a, b = ("".join(r.choice("abcdefgh") for _ in range(n)) for n in (winnowing.GRAM + winnowing.WINDOW - 1, 200, 300))
        assert set(winnow.fingerprint(a + passage)[0]) & set(winnow.fingerprint(passage + b)[0])


def plain_comparison(docs):
    import xxhash
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, np.int64(np.uint64(xxhash.xxh64_intdigest((d[1] or "").encode(), 42))) if d[1] is not None else 42))
    winnow, out = winnowing.Winnower(), []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        m = len(text) // 4
        changed = text[:len(text) - m] + after[:m]
        sets = [set(winnow.fingerprint(t)[0].tolist()) for t in (text, changed, after)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), *near))
    return sorted(out, key=str)


def compared(df):
    found = df.collect()
    assert len({r.fingerprint for r in found} | {r.edited_fingerprint for r in found}) > 1 and all(r.near_edited < 1 or r.fingerprint == r.edited_fingerprint or r.n_chars > 0 for r in found)
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in found), key=str)


@pytest.mark.parametrize("ranges", [1, 5, 60])
def test_neighbours_across_ranges(spark, monkeypatch, ranges, clashing, data_dir):
    monkeypatch.setattr(winnowing, "parts_for", lambda *a: ranges)
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    assert compared(winnowing.compare_neighbours(docs)) == plain_comparison([(r.doc_id, r.text) for r in docs.collect()])
    assert compared(winnowing.compare_neighbours(clashing)) == plain_comparison([(r.doc_id, r.text) for r in clashing.collect()])


def test_neighbours_of_one_row_and_none(spark, no_docs):
    one = spark.createDataFrame([(3, "abcdefgh")], "doc_id long, text string")
    row = winnowing.compare_neighbours(one).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1.0
    assert winnowing.compare_neighbours(no_docs).count() == 0 and winnowing.fingerprints(no_docs).count() == 0


def test_equal_texts_have_equal_fingerprints(spark, clashing):
    found = winnowing.fingerprints(clashing).collect()
    by_text = defaultdict(set)
    for r in found:
        by_text[r.tag].add((tuple(r.hashes), tuple(r.positions)))
    assert len(found) == clashing.count() and all(len(s) == 1 for s in by_text.values())
