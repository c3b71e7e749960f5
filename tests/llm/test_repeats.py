import hashlib
import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from surveyloom.llm import repeats, suffixes


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=80), st.integers(1, 3))
def test_suffix_arrays(values, times):
    text = np.array(values * times, np.uint8)
    raw = text.tobytes()
    want = sorted(range(len(raw)), key=lambda i: raw[i:])
    sa = suffixes.suffix_array(text)
    assert sa.tolist() == want
    common = [0] + [len(os.path.commonprefix([raw[a:], raw[b:]])) for a, b in zip(want, want[1:])]
    for limit in (5, 8, 100):
        assert suffixes.permuted_prefixes(text, sa, limit).tolist() == [min(c, limit) for c in common]


def brute(rows, length=100):
    first = {}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    key = lambda i: (i is not None, i or 0)
    raws = [(t or "").encode() for _, t in rows]
    for k in order:
        for p in range(len(raws[k]) - length + 1):
            w = raws[k][p:p + length]
            at = (key(rows[k][0]), p)
            first[w] = min(first.get(w, at), at)
    out = []
    for (i, _), raw in zip(rows, raws):
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            if first[raw[p:p + length]] < (key(i), p):
                gone[p:p + length] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(docs):
    return sorted((tuple(r) for r in repeats.digest(repeats.repeated_bytes(docs)).collect()), key=str)


@pytest.mark.parametrize("hot", [repeats.HOT_PASSAGES, 1])
def test_against_brute_force(spark, data_dir, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_PASSAGES", hot)
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_rows(spark, clashing, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in clashing.where("doc_id is null or doc_id <> 5").collect()]
    assert found(clashing.where("doc_id is null or doc_id <> 5")) == brute(rows)
    assert repeats.repeated_bytes(no_docs).count() == 0
    kept = repeats.remove_repeats(clashing)
    assert kept.columns == clashing.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[1] is None and texts[2] == "" and 10 not in texts and texts[8] == "é"
    assert repeats.remove_repeats(no_docs).count() == 0


def test_long_texts_are_scanned_in_overlapping_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SCAN_BYTES", 500)
    r = np.random.default_rng(5)
    text = "".join(map(chr, r.integers(97, 123, 3000)))
    docs = spark.createDataFrame([(2, text[700:1600] + "A" + text[:300]), (1, text), (3, text[900:1050] * 2)], "doc_id long, text string")
    assert found(docs) == brute([(x.doc_id, x.text) for x in docs.collect()])


def test_very_long_row_and_a_hundred_equal_rows(spark, awkward):
    """Equal rows share id and start, so none is earlier than the other; a later document of the same text loses all of it."""
    text = "".join(map(chr, np.random.default_rng(8).integers(97, 123, 400)))
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()] + [(20, text)] * 100 + [(21, "A" + text + "B")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_hot_anchors_need_no_further_shuffle_of_the_texts(spark, monkeypatch):
    """What is written on the way comes from scans and earlier tables, not from a join of the texts with lists of passages."""
    plans = []

    def settle(df, write=repeats.settle):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df)

    monkeypatch.setattr(repeats, "settle", settle)
    monkeypatch.setattr(repeats, "HOT_PASSAGES", 1)
    text = "".join(map(chr, np.random.default_rng(9).integers(97, 123, 400)))
    rows = [(1, text), (2, "A" + text[100:300]), (3, text[150:390] + "B"), (None, text[20:160]), (None, text[20:160])]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert len(plans) > 1 and not any("collect_set" in plan for plan in plans)
