import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tessera.llm import simhash


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(keys, linked):
    up = {k: k for k in keys}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if linked(a, b):
                up[max(root(a), root(b))] = min(root(a), root(b))
    return {k: root(k) for k in keys}


def test_rows_match_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    prints = {t: plain_fingerprint(t) for _, t in rows}
    root = plain_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for d, t in rows:
        if d is not None:
            r = root[prints[t]]
            least[r] = min(d, least.get(r, d))
    want = sorted((str(d), f"{prints[t]:016x}", least[root[prints[t]]]) for d, t in rows)
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(spark, docs).collect())
    assert got == want


def scattered(rng, bits, distance):
    """Lone values, chains of near values and a dense ball, which is a hot branch of every trie."""
    values = set()
    for _ in range(120):
        v = rng.getrandbits(bits)
        for _ in range(rng.choice([1, 1, 3, 12])):
            values.add(v)
            for _ in range(rng.randrange(distance // 2, distance + 2)):
                v ^= 1 << rng.randrange(bits)
    base = rng.getrandbits(bits)
    return sorted(values | {base ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)})


def frame(spark, values, kind):
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(i, *(signed(v >> 64 * w & (1 << 64) - 1) for w in range(kind.bits // 64))) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{w} long" for w in kind.words)).repartition(3)


def joined(keys, edges):
    up = {k: k for k in keys}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {k: root(k) for k in keys}


@pytest.mark.parametrize("kind", [simhash.NEAR, simhash.COPIES], ids=["near", "copies"])
def test_links_keep_every_component_whatever_the_cost_parameters(spark, monkeypatch, kind):
    values = scattered(random.Random(5), kind.bits, kind.distance)
    want = plain_components(range(len(values)), lambda i, j: (values[i] ^ values[j]).bit_count() <= kind.distance)
    prints = frame(spark, values, kind)
    other = {64: (1, 2, 3, 4), 256: (9, 15, 45)}[kind.bits]
    for tries, part, step in [(kind.tries, kind.part, simhash.STEP_VALUES), *((t, 100, 50) for t in other)]:
        monkeypatch.setattr(simhash, "STEP_VALUES", step)
        edges = simhash.links(spark, prints, kind._replace(tries=tries, part=part)).collect()
        assert all((values[r.a] ^ values[r.b]).bit_count() <= 20 * kind.distance for r in edges)
        assert joined(range(len(values)), [(r.a, r.b) for r in edges]) == want


def test_small_steps_change_nothing(monkeypatch):
    for kind in (simhash.NEAR, simhash.COPIES):
        values = scattered(random.Random(6), kind.bits, kind.distance)
        whole = joined(range(len(values)), in_one_step(values, kind)[0])
        for frontier, bucket in ((7, 1), (100, 9)):
            monkeypatch.setattr(simhash, "FRONTIER", frontier)
            monkeypatch.setattr(simhash, "BUCKET", bucket)
            assert joined(range(len(values)), in_one_step(values, kind)[0]) == whole
        monkeypatch.undo()


def in_one_step(values, kind, n=None):
    """Edges that the tries for n values find in `values`, and what they counted."""
    words = [np.array([v >> 64 * w & (1 << 64) - 1 for v in values], np.uint64) for w in range(kind.bits // 64)]
    seen, edges = Counter(), []
    for trie in simhash.tries(n or len(values), kind):
        lead = np.array([sum((v >> b & 1) << k for k, b in enumerate(trie.order[: trie.top])) for v in values])
        a, b = simhash.forest_edges(words, lead, np.zeros(len(values), np.int32), trie, kind.distance, seen)
        edges += zip(a.tolist(), b.tolist())
    return edges, seen


def test_the_tries_find_the_links_and_prune_the_rest():
    rng = random.Random(8)
    values = [rng.getrandbits(64) for _ in range(3000)]
    near = {}
    for i in range(0, 3000, 10):
        near[i] = len(values)
        values.append(values[i] ^ sum(1 << b for b in rng.sample(range(64), 3)))
    edges, seen = in_one_step(values, simhash.NEAR)
    assert joined(range(len(values)), edges) == joined(range(len(values)), near.items())
    every = len(values) * (len(values) - 1) // 2
    # Each of the two tries cuts branches off at many nodes, and few pairs of values come to be compared.
    assert seen["pruned"] > len(values) and seen["descended"] > seen["leaves"] > 300
    assert seen["leaves"] < every // 50


def test_dense_groups_are_tied_without_all_pairs():
    rng = random.Random(9)
    base = rng.getrandbits(256)
    values = sorted({base ^ sum(1 << b for b in rng.sample(range(256), 9)) for _ in range(2000)})
    edges, seen = in_one_step(values, simhash.COPIES._replace(tries=45))
    assert set(joined(range(len(values)), edges).values()) == {0}
    assert seen["leaves"] < 45 * 2000 * 30 and seen["tied"] > 0


def test_long_texts_in_parts(monkeypatch, texts):
    whole = [simhash.fingerprint(t or "") for t in texts]
    assert whole == [plain_fingerprint(t) for t in texts]
    for size in (1, 7, 64):
        monkeypatch.setattr(simhash, "PART_BYTES", size)
        assert [simhash.fingerprint(t or "") for t in texts] == whole


@pytest.mark.parametrize("kind", [simhash.NEAR, simhash.COPIES], ids=["near", "copies"])
def test_every_near_pair_meets_in_a_trie(kind):
    rng = random.Random(1)
    for n in (10, kind.part, 1 << 22, 1 << 40):
        for tries in (1, kind.tries, kind.distance + 1):
            found = simhash.tries(n, kind._replace(tries=tries))
            for _ in range(200):
                differ = set(rng.sample(range(kind.bits), rng.choice([1, kind.distance])))
                assert any(not differ & set(t.order[: t.top]) and len(differ & set(t.order[: t.segment])) <= t.budget for t in found)
            assert all(sorted(t.order) == list(range(kind.bits)) for t in found)


def plain_wide(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_wide_fingerprints(monkeypatch, texts):
    whole = simhash.wide_fingerprints(pa.array([t or "" for t in texts]))
    sets = [plain_wide(t) for t in texts]
    for i, a in enumerate(sets):  # a function of the set of shingles, zero for none
        assert bool(whole[i].any()) == bool(a)
        for j in range(i):
            if a == sets[j]:
                assert (whole[i] == whole[j]).all()
    for i, t in enumerate(texts):  # alone, and in parts
        monkeypatch.setattr(simhash, "PART_BYTES", 64)
        assert (simhash.wide_fingerprints(pa.array([t or ""]))[0] == whole[i]).all()
    differ = [int(np.bitwise_count(whole[i] ^ whole[j]).sum()) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and not sets[i] & sets[j]]
    assert min(differ) > 80  # unlike texts are far apart: 128 bits of 256, give or take


def test_copies_are_found_and_others_left(spark):
    """Against exact similarity: near copies are merged, and nothing goes that has no similar text."""
    rng = random.Random(12)
    bases = [[f"w{rng.randrange(2000)}" for _ in range(rng.choice([60, 150, 400]))] for _ in range(150)]
    rows = []
    for w in bases:
        rows.append((len(rows), " ".join(w)))
        v = list(w)
        for _ in range(max(1, len(w) // 60)):
            v[rng.randrange(len(v))] = f"new{rng.randrange(10**6)}"
        rows.append((len(rows), " ".join(v)))
    similar = [len(a & b) / len(a | b) for a, b in ((plain_wide(rows[i][1]), plain_wide(rows[i + 1][1])) for i in range(0, 300, 2))]
    kept = {r.doc_id for r in simhash.one_of_each(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert set(range(0, 300, 2)) <= kept
    copies = [i for i, s in enumerate(similar) if s >= 0.8]
    assert len(copies) > 100 and sum(2 * i + 1 not in kept for i in copies) > 0.97 * len(copies)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame(chain + star + [(200, 200), (7, 3)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(spark, edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert simhash.components(spark, edges.limit(0)).count() == 0


def test_one_of_each_keeps_columns_and_one_row(spark, docs, empty):
    kept = simhash.one_of_each(spark, docs, simhash.NEAR)
    assert kept.columns == docs.columns
    ids = simhash.near_duplicates(spark, docs).select("component_id").distinct().count()
    assert kept.count() == ids
    assert simhash.one_of_each(spark, empty).count() == 0 and simhash.near_duplicates(spark, empty).count() == 0


def test_columns_of_any_name_keep_their_values(spark, texts):
    names = ["tessera_fp", "tessera_row", "w0", "id", "block", "at", "k", "root", "first", "trie", "fp"]
    rows = [(i, t, *range(100 * i, 100 * i + len(names))) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} long" for n in names)).repartition(3)
    for kind in (simhash.NEAR, simhash.COPIES):
        kept = simhash.one_of_each(spark, df, kind)
        assert kept.columns == df.columns
        got = [tuple(r) for r in kept.collect()]
        assert len(got) == len(set(got)) and set(got) <= set(rows)
    assert simhash.near_duplicates(spark, df).count() == len(rows)
