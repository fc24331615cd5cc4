import hashlib
import random
import re

import numpy as np
import pytest

from tessera.llm import substrings


def plain(rows, k=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    order = [substrings.NO_ID if d is None else d for d, _ in rows]
    for d, w in zip(order, words):
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            least[key] = min(d, least.get(key, d))
    out = []
    for (doc, _), d, w in zip(rows, order, words):
        gone = set()
        for i in range(len(w) - k + 1):
            if least[tuple(w[i : i + k])] < d:
                gone |= set(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(doc), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("small_blocks", [False, True])
def test_rows_match_brute_force(spark, docs, monkeypatch, small_blocks):
    if small_blocks:
        monkeypatch.setattr(substrings, "BLOCK_BYTES", 3000)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.digests(spark, docs).collect())
    assert got == plain(rows)


@pytest.mark.parametrize("cell, fan, shard, lanes", [(None, 2, 700, None), (14, 2, 700, 1), (6, 2, 1 << 20, None), (9, 1, 1 << 20, 3), (8, 3, 400, 5)])
def test_narrow_sketches_and_chunks_change_nothing(spark, monkeypatch, cell, fan, shard, lanes):
    made, used = substrings.split_for, []

    def narrowed(size):
        split = made(size, cell)
        split = split._replace(lanes=lanes or split.lanes)
        used.append(split)
        return split

    for name, value in (("split_for", narrowed), ("FAN_BITS", fan), ("SHARD_BYTES", shard), ("BLOCK_BYTES", 1500)):
        monkeypatch.setattr(substrings, name, value)
    rows = passages(9)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.digests(spark, df).collect())
    assert got == plain(rows)
    assert used[0].second > 0 and used[0].first + used[0].second <= used[0].cell


def test_splits_grow_with_the_input():
    small, large = substrings.split_for(30 << 30), substrings.split_for(100 << 40)
    assert small.second == 0 and small.cell >= 36
    assert large.first <= substrings.FAN_BITS and large.second <= substrings.FAN_BITS
    assert (100 << 40) >> (large.first + large.second) <= substrings.SHARD_BYTES
    assert (100 << 40) // (large.lanes << large.first) <= substrings.SHARD_BYTES and 1 << large.cell >= 4 * (100 << 40)


def passages(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    passage = " ".join(rng.choices(words, k=60))
    rows = []
    for i in rng.sample(range(1000), 120):
        own = " ".join(rng.choices(words, k=rng.choice([3, 30, 90])))
        rows.append((i, own + " " + passage + " " + own if i % 3 else " ".join(["loop"] * (i % 40)) + "\n" + own))
    return rows


def test_passages_shared_by_many_and_loops(spark):
    rows = passages(9)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.digests(spark, df).collect())
    assert got == plain(rows)


def test_trimmed_keeps_columns_and_whole_documents(spark, docs, empty):
    got = substrings.trimmed(spark, docs)
    assert got.columns == docs.columns
    want = {(r[0], r[1]): r for r in plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])}
    rows = got.collect()
    for r in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert any(w[0] == str(r.doc_id) and w[1] - w[2] == n for w in want.values())
    gone = [w for w in plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]) if w[1] and w[1] == w[2]]
    assert len(rows) == docs.count() - len(gone)
    assert substrings.trimmed(spark, empty).count() == 0 and substrings.digests(spark, empty).count() == 0


def test_sketch_overestimates_only():
    rng = np.random.default_rng(2)
    a = [rng.integers(0, 1 << 63, 50).astype("<u8"), rng.integers(0, 9, 50).astype("<u4")]
    back = substrings.unpacked(substrings.packed(*a), "<u8", "<u4")
    assert all((x == y).all() for x, y in zip(a, back))
    assert substrings.unpacked(substrings.packed(np.zeros(0, "<u8")), "<u8")[0].size == 0
