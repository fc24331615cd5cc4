import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import warc
from tessera.llm.common import get

PAGES = "page_id long, url string, html string, bundle string, first long"


@pytest.fixture(scope="module")
def pages(spark):
    big, other, long = "é" * 600, "b" * 1000, "lorem ipsum " * 300_000
    rows = [(1, "http://a/x y\r\nz", big), (5, "http://b", big), (3, None, big), (5, "http://b", big), (7, "http://c", "small"), (8, "http://d", "small"), (9, "http://e", None), (10, "http://f", ""), (11, "http://g", other), (12, "http://h", "b" * 999), (13, "http://i", "b" * 999), (14, "u", long), (2, "u", long), (None, "n", big), (None, "n", "c" * 2000), (20, "\r\n\r\nWARC/1.1", "x\r\n\r\nWARC/1.1\r\n\r\n" * 99)]
    return spark.createDataFrame([(*r, "clash", 0) for r in rows], PAGES).repartition(3)


def plain(rows):
    top = {}
    for page, _, html, *_ in rows:
        b = (html or "").encode()
        if len(b) >= 1000 and page is not None:
            top[b] = max(page, top.get(b, page))
    out = []
    for page, _, html, *_ in rows:
        b = (html or "").encode()
        again = b in top and top[b] != page
        out.append((str(page), len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", top[b] if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, pages):
    index = warc.write_archives(spark, pages)
    got = sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(spark, index).collect()), key=str)
    rows = [tuple(r) for r in pages.collect()]
    assert got == plain(rows)
    for r in index.collect():
        one = warc.fetch(r.bundle, r.frame, r.record_at)
        assert one[0] == r.page_id and (str(one[0]), *one[1:5]) in got
    for bundle in {r.bundle for r in index.collect()}:
        data, own = get(bundle), [r for r in index.collect() if r.bundle == bundle]
        table = warc.seek_table(pa.BufferReader(data), data.size)
        assert {(r.frame, r.frame_at) for r in own} == {(i, t[0]) for i, t in enumerate(table)}
        assert sum(len(f) for f in warc.frames(bundle)) == sum(r.record_bytes for r in own) == sum(t[2] for t in table)


def test_identifiers_are_different_and_revisits_find_theirs(spark, pages):
    again = pages.unionByName(pages.where("page_id in (5, 7)")).unionByName(pages.where("page_id = 11").withColumn("page_id", F.lit(14)))
    again = again.unionByName(pages.where("page_id = 12").withColumn("html", F.lit("b" * 1000)))
    index = warc.write_archives(spark, again.coalesce(1))
    heads = []
    for bundle in {r.bundle for r in index.collect()}:
        for data in warc.frames(bundle):
            at = 0
            while at < len(data):
                head, _, at = warc.parse(data, at)
                heads.append(head)
    ids = {h["WARC-Record-ID"]: h for h in heads}
    assert len(ids) == len(heads) == again.count()
    referring = [h for h in heads if h["WARC-Type"] == "revisit"]
    assert len(referring) >= 4
    for h in referring:
        kept = ids[h["WARC-Refers-To"]]
        assert kept["WARC-Type"] == "response" and kept["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]


def test_small_bundles_and_empty_table(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 900)
    index = warc.write_archives(spark, pages, bundle_bytes=3000)
    assert index.select("bundle").distinct().count() > 3
    assert warc.read_archives(spark, index).count() == pages.count()
    nothing = warc.write_archives(spark, pages.limit(0))
    assert nothing.count() == 0 and warc.read_archives(spark, nothing).count() == 0


def test_a_damaged_payload_is_noticed():
    data = warc.record(1, "u", b"payload")
    head, block, end = warc.parse(data)
    assert end == len(data) and warc.described(head, block)[1] == 7
    head, block, _ = warc.parse(data.replace(b"payload", b"paylOad"))
    with pytest.raises(ValueError):
        warc.described(head, block)
