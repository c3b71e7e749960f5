import hashlib

import corpus_pipeline
import tiktoken
import public_tokenizers

from surveyloom.llm import bpe, decontaminate, repeats, simhash


def test_stages_take_effect(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    columns, now = docs.columns, docs
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, data_dir).persist()
        assert now.columns == columns
        seen.append(now.count())
        assert now.where("n_chars <> length(text)").count() == 0 or name in ("language_id", "simhash_near_dedup")
    assert seen == sorted(seen, reverse=True) and seen[2] < seen[1] and seen[-1] > seen[0] / 2
    assert simhash.near_duplicates(docs).select("root").distinct().count() >= seen[2]
    bench = spark.read.parquet(f"{data_dir}/benchmark.parquet")
    before, after = (decontaminate.scan(x, bench).where("size(starts) > 0").count() for x in (docs, now))
    assert before > 0 and after == 0
    left = repeats.digest(repeats.repeated_bytes(now)).selectExpr("sum(n_removed)").first()[0]
    assert left < 0.02 * now.selectExpr("sum(octet_length(text))").first()[0]
    final = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, now, data_dir).collect()}
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    for r in now.collect():
        assert final[r.doc_id].ids == encoder.encode_ordinary(r.text) and final[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_run_equals_the_stages(spark, data_dir):
    assert corpus_pipeline.run(spark, data_dir).select("doc_id").distinct().count() > 50


def test_awkward_and_empty_tables(spark, data_dir, clashing, no_docs):
    """Nulls, empty and long texts, repeated rows, equal ids and clashing columns go through every stage; so does an empty table."""
    now = clashing
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, data_dir).persist()
        assert now.columns == clashing.columns
    kept = now.collect()
    texts = [r.text for r in kept]
    assert kept and len(set(texts)) == len(texts) and all(t and t.strip() for t in texts)
    encoded = corpus_pipeline.STAGES[-1][1](spark, now, data_dir).collect()
    assert sorted(r.decoded_sha256 for r in encoded) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in texts)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, data_dir).count() == 0
