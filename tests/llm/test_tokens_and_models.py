import hashlib
import math
import struct
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveyloom.llm import bpe, decontaminate, langid, lm, quality_net
from surveyloom.llm.common import held_out

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoder():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


TEXT = st.lists(st.sampled_from(["a", "B", "'s", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "1", "²", "é", "漢", "😀", "!!", "'ll", "don't", "x" * 60, " the", "́", "_", "\r\n", "\x00"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_pieces_equal_the_library(encoder, text):
    splitter, ranks = bpe.Splitter(public_tokenizers.PATTERN), encoder._mergeable_ranks
    assert [i for c in splitter.cut(text) for w in splitter.words(c) for i in bpe.merge(w.encode(), ranks)] == encoder.encode_ordinary(text)


def test_encode_and_decode_rows(clashing, no_docs, encoder):
    rows = bpe.encode(clashing, RANKS, public_tokenizers.PATTERN, block_bytes=1000)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows.collect())
    want = []
    for r in clashing.collect():
        ids = encoder.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"] is None, r["doc_id"] or 0, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.decode(rows, RANKS).where("sha2(decoded, 256) <> decoded_sha256").count() == 0
    assert bpe.encode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_encode_the_corpus(spark, data_dir, encoder):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    got = {r.doc_id: r.ids for r in bpe.encode(docs, RANKS, public_tokenizers.PATTERN, block_bytes=100_000).collect()}
    assert got == {r.doc_id: encoder.encode_ordinary(r.text or "") for r in docs.collect()}


def test_long_words_merge_alike(encoder):
    for word in ("ab" * 3000, "é" * 500, "=" * 1000, "the" * 77):
        assert bpe.merge(word.encode(), encoder._mergeable_ranks) == encoder.encode_ordinary(word)


def test_language_accuracy_on_held_out_rows(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    found = langid.identify(docs, langid.training_rows(docs)).join(docs, "doc_id").where(held_out(F.col("doc_id"), 4, 2) & (F.length("text") > 50))
    right, total = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert total > 20 and right / total > 0.97


def test_language_of_awkward_rows(clashing, no_docs):
    rows = {(r.doc_id, r.tag): r for r in langid.identify(clashing, langid.training_rows(clashing)).collect()}
    assert len(rows) == clashing.dropDuplicates(["doc_id", "text"]).count()
    for r in rows.values():
        assert 0 <= r.score <= 1 and (r.lang_pred in ("en", "fr", "de") or r.lang_pred == "und")
    assert {r.lang_pred for r in rows.values() if r.doc_id in (1, 2, 3, 4)} == {"und"}
    assert {r.lang_pred for r in langid.identify(clashing, no_docs).collect()} == {"und"}
    assert langid.identify(no_docs, no_docs).count() == 0
    kept = langid.relabel(clashing, langid.training_rows(clashing), 8.0)
    assert kept.columns == clashing.columns and {r["doc_id"] for r in kept.collect()} <= {5, 6, 7, 8, 9, 10, None}


def test_code_lengths_follow_the_tree():
    trees = langid.ContextTrees({"a": b"abababab", "b": b"abcabcabc"}, order=2, least=1)

    def bits(text, sample, order=2):
        total = 0.0
        for i, s in enumerate(text):
            for d in range(min(i, order), -1, -1):
                context = text[i - d:i]
                after = Counter(sample[j + d] for j in range(len(sample) - d) if sample[j:j + d] == context)
                if not after:
                    continue
                n = sum(after.values()) + len(after)
                if s in after:
                    total -= math.log2(after[s] / n)
                    break
                total -= math.log2(len(after) / n)
            else:
                total += 8
        return total

    texts = [b"abab", b"cab", b"zzaz", b"", b"ab" * 700]
    want = [[bits(t, b"abababab"), bits(t, b"abcabcabc")] for t in texts]
    assert np.allclose(trees.code_lengths(texts, segment=16), want, rtol=1e-4)


def test_decontamination_of_awkward_rows(clashing, benchmark_rows, no_docs):
    for limit in (1 << 20, 1):
        rows = [r for r in decontaminate.scan(clashing, benchmark_rows, slice_bytes=limit).collect()]
        assert len(rows) == clashing.count()
        of = lambda i: sorted((r.n_words, tuple(zip(r.starts, r.ends)), tuple(r.items)) for r in rows if r.doc_id == i)  # noqa: B023, E731
        assert of(1) == of(2) == of(3) == [(0, (), ())]
        assert of(6) == [(15, ((0, 15),), ("1", "2"))] * 2
        assert of(7) == [(15, ((0, 15),), ("1", "2")), (28, ((4, 9), (18, 23)), ("10",))]
        kept = decontaminate.decontaminate(clashing, benchmark_rows, slice_bytes=limit)
        assert kept.columns == clashing.columns
        assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 2, 3, 4, 5, 7, 8, 9, 10]
    assert decontaminate.scan(no_docs, benchmark_rows).count() == 0
    assert decontaminate.scan(clashing, benchmark_rows.limit(0)).where("size(starts) > 0").count() == 0


def brute_windows(items, words, window):
    hit, found = set(), set()
    for k, text in items:
        item = text.translate(decontaminate.NORMALISE).split()
        n = min(window, len(item))
        for i in range(len(words) - n + 1 if n else 0):
            if any(words[i:i + n] == item[j:j + n] for j in range(len(item) - n + 1)):
                hit.update(range(i, i + n))
                found.add(k)
    return hit, found


@pytest.mark.parametrize("collide", [False, True])
def test_gram_arrays_against_all_windows(monkeypatch, collide):
    if collide:  # hashes that tell almost nothing: the words decide
        monkeypatch.setattr(decontaminate, "mixed", lambda ids, n: (ids[:len(ids) - n + 1] % 2).astype(np.uint64))
    r = np.random.default_rng(5)
    draw = lambda n: " ".join("abc"[i] for i in r.integers(0, 3, n)).encode()
    for _ in range(60):
        items = [(str(k), draw(r.integers(0, 12))) for k in range(r.integers(0, 8))]
        grams = decontaminate.Grams(items, 4)
        for text in (draw(r.integers(0, 40)), b"a z b c a b", b""):
            words = text.translate(decontaminate.NORMALISE).split()
            spans, found = grams.scan(np.array([grams.words.get(w, -1) for w in words], np.int32))
            hit, names = brute_windows(items, words, 4)
            assert {i for a, b in spans for i in range(a, b)} == hit and {grams.items[k] for k in found} == names


def test_gram_arrays_take_what_the_slices_reckon(spark):
    texts = [" ".join(f"w{(i * 7919 + j * 31) % 9000}" for j in range(200)) for i in range(300)]
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    (part,) = decontaminate.slices(bench, "item_id", "text", 64 << 20)
    grams = decontaminate.Grams(part, 10)
    arrays = sum(a.nbytes for entry in grams.by_length.values() for a in entry) + grams.flat.nbytes
    assert arrays <= decontaminate.WINDOW_COST * 300 * 201
    parts = list(decontaminate.slices(bench, "item_id", "text", 2 << 20))
    assert len(parts) > 1 and sorted(i for p in parts for i, _ in p) == sorted(str(i) for i in range(300))


def test_empty_batches_lose_no_document(spark, encoder):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string").repartition(7, "doc_id")
    assert {r.doc_id: r.ids for r in bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()} == {1: encoder.encode_ordinary("a b"), 2: encoder.encode_ordinary("c")}


def test_quality_on_held_out_rows(spark, data_dir):
    docs, labels = (spark.read.parquet(f"{data_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_net.score(docs, labels).join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.85


def test_quality_of_awkward_rows(spark, clashing, no_docs):
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, 1), (9, 0), (10, 0), (None, 1), (8, None)], "doc_id long, quality int")
    rows = quality_net.score(clashing, labels, per_class=10).collect()
    assert len(rows) == clashing.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality_net.score(clashing, labels.limit(0)).collect()} == {0.5}
    assert quality_net.score(no_docs, labels).count() == 0


def test_network_covers_the_whole_text(monkeypatch):
    net = quality_net.Net().fold()
    text = bytes(range(32, 120)) * 50
    for n in (0, 1, 7, 8, 9, 4400):
        alone = net.probability([text[:n]])[0]
        assert np.isclose(alone, net.probability([b"x" * 99, text[:n], b""])[1])
    sizes = (1, 63, 64, 65, 66, 68, 69, 72, 132, 133, 4400)
    whole = net.probability([text[:n] for n in sizes])
    monkeypatch.setattr(quality_net, "AT_ONCE", 64)
    assert np.allclose(net.probability([text[:n] for n in sizes]), whole)


def plain_forward(net, text):
    """Probability of a text, chunk by chunk and filter by filter."""
    width, stride = quality_net.WIDTH, quality_net.STRIDE
    count = max(1, -(-(len(text) - width) // stride) + 1)
    padded = text.ljust((count - 1) * stride + width, b"\0")
    z = float(net.bias[0])
    for f in range(quality_net.FILTERS):
        best = max(sum(float(net.embedding[padded[c * stride + w]] @ net.filters[w, :, f]) for w in range(width)) for c in range(count))
        z += float(net.weights[f]) * max(0.0, best + float(net.shift[f]))
    return 1 / (1 + math.exp(-z))


def test_network_against_plain_loops(monkeypatch):
    net = quality_net.Net()
    texts = [b"", b"a", b"plain text of a few chunks, and more", bytes(range(256)), "é漢😀".encode() * 9]
    assert np.allclose(net.fold().probability(texts), [plain_forward(net, t) for t in texts], atol=1e-5)
    for name in ("embedding", "filters", "shift", "weights", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))  # so that small steps can be told apart
    labels, weight = np.array([1, 0, 1, 0, 1.0]), np.array([0.1, 0.3, 0.2, 0.2, 0.2])

    def loss():
        p = np.array([plain_forward(net, t) for t in texts])
        return float(-(weight * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum())

    found = net.gradients(texts, labels, weight)
    monkeypatch.setattr(quality_net, "AT_ONCE", 32)
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(found, net.gradients(texts, labels, weight)))
    r = np.random.default_rng(3)
    for p, g in zip(net.parameters, found):
        for at in [tuple(r.integers(0, n) for n in p.shape) for _ in range(12)] + [np.unravel_index(np.abs(g).argmax(), g.shape)]:
            was, step = p[at], 1e-5
            p[at] = was + step
            more = loss()
            p[at] = was - step
            less = loss()
            p[at] = was
            assert math.isclose((more - less) / (2 * step), float(g[at]), abs_tol=2e-4)


def test_training_texts_are_whole_and_bounded(spark):
    docs = spark.createDataFrame([(i, "x" * (100 * i)) for i in range(1, 41)] + [(99, "long" * 50_000)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality")
    take = lambda n: quality_net.training_rows(docs, labels, "quality", 5, 0, 1000, n, "doc_id", "text")
    every = take(1 << 20)
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    assert {i for i, _, _ in every} == {i for i in texts if zlib.crc32(str(i).encode()) % 5} and all(t == texts[i] for i, t, _ in every)
    few = take(5000)
    assert few and all(t == texts[i] for i, t, _ in few)
    assert all(sum(len(t) for _, t, y in few if y == label) <= 5000 for label in (0, 1)) and take(0) == []


def lattice(pieces, weights, word):
    text = lm.WORD_START.encode() + word

    @lru_cache(None)
    def rest(i):
        if i == len(text):
            return 1.0
        size = 1 if text[i] < 0x80 else 2 if text[i] < 0xE0 else 3 if text[i] < 0xF0 else 4
        total = sum(math.exp(weights[k]) * rest(j) for j in range(i + 1, len(text) + 1) if (k := pieces.table.get(text[i:j], -1)) >= 0)
        if pieces.table.get(text[i:i + size], -1) < 0:
            total += math.exp(sum(weights[pieces.bytes_at + b] for b in text[i:i + size])) * rest(i + size)
        return total

    return math.log(rest(0))


def test_lattices_sum_all_segmentations():
    pieces = lm.Pieces.read(PIECES)
    words = [w.encode() for w in ("the", "thrées", "漢字", "😀a", "antidisestablishment", "x", "!!")]
    logs, expected = lm.forward(pieces, pieces.weights, words, np.arange(1, len(words) + 1))
    assert np.allclose(logs, [lattice(pieces, pieces.weights, w) for w in words])
    assert math.isclose(np.exp(pieces.adapted(expected)).sum(), 1)


def test_base_scores(spark, data_dir, clashing, no_docs):
    for docs, size in ((spark.read.parquet(f"{data_dir}/documents.parquet"), 100_000), (clashing, 1000)):
        rows = [(r["doc_id"], (r["text"] or "").encode().lower().split()) for r in docs.collect()]
        counts, ends = Counter(), 0
        for i, words in rows:
            if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
                counts.update(words)
                ends += 1
        n, v = sum(counts.values()) + ends, len(counts) + 1
        want = sorted((len(w) + 1, sum(counts[x] > 0 for x in w) + 1, n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1)), 4)) for _, w in rows)
        found = lm.score(docs, PIECES, block_bytes=size).collect()
        assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found) == want
        assert all(r.score < 0 for r in found)
    assert lm.score(no_docs, PIECES).count() == 0
