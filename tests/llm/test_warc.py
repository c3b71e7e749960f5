import hashlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from surveyloom.llm import warc
from surveyloom.llm.common import shared_folder

BIG = "<p>" + "payload " * 200
ROWS = [(1, "http://a/", BIG), (5, "http://b/ x", BIG), (3, None, BIG), (3, None, BIG), (7, "u", "small"), (8, "u", "small"), (9, "u", None), (None, "u", BIG), (11, "é", "é" * 600), (12, "u", "é" * 600), (12, "u", "é" * 600)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string")


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip_of_awkward_pages(spark, pages, compress):
    archives = warc.write_archives(warc.plan_records(pages), shared_folder(spark), compress, limit=2000)
    read = warc.read_archives(archives).collect()
    assert all(r.kind == "record" for r in read)
    last = {BIG: 5, "é" * 600: 12}
    want = []
    for page, _, html in ROWS:
        raw = (html or "").encode()
        again = html in last and page != last[html]
        want.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", last[html] if again else None, None if again else raw))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.record_type == "revisit" else bytes(r.payload)) for r in read]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_every_archive_is_a_task(spark):
    pages = spark.createDataFrame([(i, "u", f"<p>{i} " + "x" * 900) for i in range(40)], "page_id long, url string, html string")
    archives = warc.write_archives(warc.plan_records(pages), shared_folder(spark), False, limit=2000)
    read = warc.read_archives(archives)
    tasks = read.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.countDistinct("path").alias("n")).collect()
    assert len(tasks) == archives.count() > 8 and {t.n for t in tasks} == {1}


def test_payloads_above_a_chunk_and_clashing_columns(spark):
    big = "".join(f"<p>{i}" for i in range(400_000))
    assert len(big) > 2 * warc.CHUNK
    pages = spark.createDataFrame([(1, "u", big), (2, "u", big), (3, "u", "")], "page_id long, url string, html string")
    for name in ("digest", "size", "record_type", "refers_to", "path", "kind"):
        pages = pages.withColumn(name, F.lit("7"))
    for compress in (True, False):
        read = warc.read_archives(warc.write_archives(warc.plan_records(pages), shared_folder(spark), compress))
        got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes, bytes(r.payload).decode() if r.record_type == "response" else bytes(r.payload)) for r in read.collect()}
        assert got[1] == ("revisit", 2, len(big), b"") and got[2] == ("response", None, len(big), big) and got[3][:3] == ("response", None, 0)


def test_no_pages(spark, pages):
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def archive(compress):
    records = [warc.record(i, f"http://x/{i}", f"<p>{i}".encode() * (50 + i), hashlib.sha1(f"<p>{i}".encode() * (50 + i)).hexdigest(), 0, "response", None) for i in range(20)]
    return [warc.member(r) if compress else r for r in records]


def ids(items):
    found = [re.fullmatch(r"<urn:page:([0-9]+)>", x[3]["warc-record-id"]) for x in items if x[0] == "record"]
    return [int(x[1]) for x in found if x]


@pytest.mark.parametrize("compress", [True, False])
def test_salvage_after_damage(compress):
    parts = archive(compress)
    whole = list(warc.salvage(io.BytesIO(b"".join(parts))))
    assert ids(whole) == list(range(20))
    r = random.Random(4)
    for _ in range(30):
        k = r.randrange(20)
        part = bytearray(parts[k])
        for at in r.sample(range(len(part)), 8):
            part[at] ^= 0xFF
        data = b"".join([*parts[:k], bytes(part), *parts[k + 1:]])
        found = list(warc.salvage(io.BytesIO(data)))
        assert [i for i in range(20) if i != k] == [i for i in ids(found) if i != k]
        at = 0
        for kind, start, end, _, _ in found:  # records and gaps cover every byte once
            assert start == at
            at = end
        assert at == len(data)
        gap = [x for x in found if x[0] == "gap"]
        assert not gap or gap[0][1] >= sum(map(len, parts[:k]))


@pytest.mark.parametrize("compress", [True, False])
def test_salvage_of_truncated_and_foreign_bytes(compress):
    parts = archive(compress)
    data = b"junk" * 1000 + b"".join(parts[:3]) + parts[3][:40] + b"\x1f\x8b\x08" + b"".join(parts[4:6]) + parts[6][:-30]
    found = list(warc.salvage(io.BytesIO(data)))
    assert ids(found) == [0, 1, 2, 4, 5]
    assert [x[0] for x in found] == ["gap", "record", "record", "record", "gap", "record", "record", "gap"] and found[-1][2] == len(data)
    assert list(warc.salvage(io.BytesIO(b""))) == []
