"""The corpus pipeline, stage by stage, against brute force; and the registered queries on the smallest tables."""

import re

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from tessera.llm import common, queries, simhash
from tests.llm import test_decontam, test_quality, test_simhash, test_tokens
from tests.llm.conftest import SF

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def without_repeats(rows, k=13):
    """{doc_id: text} after substring removal, windows judged on the input."""
    least = {}
    for d, t in rows:
        w = split(t)
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            least[key] = min(d, least.get(key, d))
    out = {}
    for d, t in rows:
        w, gone = split(t), set()
        for i in range(len(w) - k + 1):
            if least[tuple(w[i : i + k])] < d:
                gone |= set(range(i, i + k))
        if not gone:
            out[d] = t
        elif len(gone) < len(w):
            out[d] = " ".join(x for i, x in enumerate(w) if i not in gone)
    return out


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = common.stored(spark, stage(spark, docs, SF), name)
        held[name] = before, docs
        if name != "packing":
            assert docs.columns == COLUMNS
    got = lambda name: {r.doc_id: r.text for r in held[name][1].select("doc_id", "text").collect()}

    before, _ = held["quality_rules"]
    kept, texts = got("quality_rules"), dict(before)
    for d, t in before:
        c = test_quality.plain(t)
        if c[0] < 20 or 100 * c[4] > 30 * c[0]:
            assert d not in kept
    assert all(texts[d] == t for d, t in kept.items()) and len(kept) > 0.8 * len(before)

    before, _ = held["simhash_near_dedup"]
    words = simhash.wide_fingerprints(pa.array([t or "" for _, t in before]))
    prints = {d: sum(int(w) << 64 * i for i, w in enumerate(row)) for (d, _), row in zip(before, words)}
    root = test_simhash.plain_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= simhash.COPIES.distance)
    first = {}
    for d, _ in sorted(before):
        first.setdefault(root[prints[d]], d)
    kept = got("simhash_near_dedup")
    assert set(kept) == set(first.values()) and all(dict(before)[d] == t for d, t in kept.items())

    before, after = held["substring_dedup"]
    assert got("substring_dedup") == without_repeats(before)
    assert after.where("n_chars <> length(text)").count() == 0

    before, _ = held["benchmark_decontamination"]
    bad = {int(r[0]) for r in test_decontam.plain(before, bench) if r[5]}
    assert got("benchmark_decontamination") == {d: t for d, t in before if d not in bad}

    before, after = held["packing"]
    test_tokens.whole(after.collect(), before, 0)


def test_stages_take_empty_tables_nulls_and_further_columns(spark, docs, empty):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
        out = stage(spark, docs, SF)
        assert out.count() > 0
        if name != "packing":
            assert out.columns == docs.columns


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, duck, name):
    got = queries.queries()[name](spark, SF)
    rows = sorted((repr(tuple(r[c] for c in sorted(got.columns))) for r in got.collect()))
    assert rows
    if name in queries.oracle_sql():
        want = duck.sql(queries.oracle_sql()[name])
        place = [want.columns.index(c) for c in sorted(got.columns)]
        assert rows == sorted(repr(tuple(r[i] for i in place)) for r in want.fetchall())


def test_every_operator_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 11)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "packing"]
