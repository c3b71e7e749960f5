from itertools import combinations

import numpy as np
import xxhash

from surveyloom.llm import components, simhash


def test_words_two_bits_apart_share_a_key():
    code = simhash.Golay()
    words = code.leader.copy()  # one word per syndrome; the code is linear
    keys = code.keys(words)
    for bits in [*combinations(range(23), 1), *combinations(range(23), 2)]:
        other = code.keys(words ^ sum(1 << b for b in bits))
        assert ((keys[:, :, None] == other[:, None, :]) & (keys[:, :, None] >= 0)).any((1, 2)).all()


def reference(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, distance=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= distance:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_and_groups_of_the_corpus(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(texts)
    fps = [reference(texts[i]) for i in ids]
    want = {i: ids[g] for i, g in zip(ids, groups(fps))}
    found = simhash.digest(simhash.near_duplicates(docs)).collect()
    assert {r.doc_id: r.component_id for r in found} == want
    assert {r.doc_id: r.fingerprint for r in found} == {i: f"{f:016x}" for i, f in zip(ids, fps)}


def test_dense_ball_links_in_pieces(spark):
    """Thousands of fingerprints around one: hot keys are compared piece by piece, with the same groups."""
    r = np.random.default_rng(3)
    center = int(r.integers(1 << 62))
    fps = {center ^ sum(1 << int(b) for b in r.choice(64, r.integers(1, 6), replace=False)) for _ in range(600)} | {int(x) for x in r.integers(0, 1 << 63, 50)}
    fps = sorted(np.array(sorted(fps), np.uint64).view(np.int64).tolist())
    table = spark.createDataFrame([(f,) for f in fps], "fp long")
    unsigned = [f & (1 << 64) - 1 for f in fps]
    whole = groups(unsigned)
    want = {f: min(x for x, h in zip(fps, whole) if h == g) for f, g in zip(fps, whole) if whole.count(g) > 1}
    for piece in (16, 1024):
        edges = simhash.links(table, piece=piece)
        assert {r.node: r.root for r in components.components(edges).collect()} == want


def test_components_of_chains_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 99), (99, 98), (5, 5), (200, 200), (98, 100)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 98: 98, 99: 98, 100: 98}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(clashing, no_docs, awkward):
    found = simhash.near_duplicates(clashing).collect()
    assert len(found) == clashing.count()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, set()).add((r.fp, r.component_id))
    assert by_id[1] == by_id[2] == by_id[3] == {(0, 1)} and (0, 1) in by_id[None]
    assert {c for _, c in by_id[6]} == {6} and 6 in {c for _, c in by_id[7]}
    kept = simhash.keep_first(clashing)
    assert kept.columns == clashing.columns and kept.count() == len({r.root for r in found})
    assert sum(r.doc_id == 6 for r in kept.collect()) == 1
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_first(no_docs).count() == 0
