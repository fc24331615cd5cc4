import hashlib
import random
import re

from tessera.llm import decontam


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items):
    windows = []
    for i, t in items:
        w = words_of(t)
        if w:
            k = min(13, len(w))
            windows += [(i, tuple(w[j : j + k])) for j in range(len(w) - k + 1)]
    out = []
    for d, t in docs:
        w, hit, found = words_of(t), set(), set()
        text = " " + " ".join(w) + " "
        for i, win in windows:
            if f" {' '.join(win)} " in text:
                for j in range(len(w) - len(win) + 1):
                    if tuple(w[j : j + len(win)]) == win:
                        hit |= set(range(j, j + len(win)))
                        found.add(str(i))
        found -= {"None"}
        out.append((str(d), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


def result(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def test_rows_match_brute_force(spark, docs, texts, empty):
    rng = random.Random(1)
    pool = [t for t in texts if t and len(words_of(t)) > 13]
    items = [(100 + i, " ".join(t.split()[:30])) for i, t in enumerate(pool[:6])]
    items += [(7, "stone river"), (8, "word"), (9, ""), (10, None), (11, "the and of lamp never here xyz"), (None, " ".join(pool[8].split()[2:20])), (100, "über, ÑANDÚ"), (12, " ".join(pool[9].split()[:12]))]
    items += [(20 + i, " ".join(rng.choice(pool).split()[3 : 3 + rng.choice([12, 13, 14, 25])])) for i in range(8)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(decontam.hits(spark, docs, bench)) == plain(rows, items)
    kept = decontam.uncontaminated(spark, docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r[5] for r in plain(rows, items))
    none = bench.limit(0)
    assert all(r[2] == 0 for r in result(decontam.hits(spark, docs, none)))
    assert decontam.hits(spark, empty, bench).count() == 0


def test_repeated_words_and_item_repeats(spark):
    docs = [(1, "a " * 40), (2, "a " * 12), (3, "b " + "a " * 13 + "b"), (4, "a b " * 20)]
    items = [(1, "a " * 13), (1, "a b " * 7), (2, "a " * 30)]
    got = decontam.hits(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert result(got) == plain(docs, items)


def test_hot_fingerprints_and_narrow_bitmaps_change_nothing(spark, empty, monkeypatch):
    """A phrase in every document and every item, under bitmaps full of false hits and many or no copies."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    phrase = " ".join(rng.choices(words, k=18))
    own = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, f"{own(i % 4)} {phrase} {own(20)}") for i in range(12)]
    docs = [(i, f"{own(30)} {phrase} {own(rng.choice([5, 300, 900]))} {items[i % 12][1] if i % 5 == 0 else ''}") for i in range(60)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")
    want = plain(docs, items)
    assert all(r[3] == 12 for r in want) and 0 < sum(r[5] for r in want) < 60
    for bits, hot in ((4, 1), (24, 64), (4, 1 << 20)):
        assert result(decontam.hits(spark, d, b, bits=bits, hot=hot)) == want
    clean = sorted(r[0] for r in want if not r[5])
    for limit in (decontam.BROADCAST_ROWS, -1):
        monkeypatch.setattr(decontam, "BROADCAST_ROWS", limit)
        kept = decontam.uncontaminated(spark, d, b)
        assert kept.columns == d.columns and sorted(str(r.doc_id) for r in kept.collect()) == clean
        assert decontam.uncontaminated(spark, empty, b).count() == 0
