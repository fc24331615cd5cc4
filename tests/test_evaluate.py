import math
import re
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tessera.operators import evaluate
from tessera.sources.connectors import EchoGenerator

PRED = "id long, input string, prediction string, reference string"


def plain(p, r):
    p = " ".join((p if p is not None else "None").lower().split())
    words, why, bad = p.split(), [], False
    if not p:
        why.append("empty_output")
        bad = True
    if not words or len(set(words)) / len(words) < 0.3:
        why.append("repetition")
        bad = True
    if r:
        r = " ".join(r.lower().split())
        s = SequenceMatcher(None, p, r).ratio()
        if s < 0.5:
            why.append(f"low_similarity_{s:.2f}")
            bad = True
        if p == r:
            why.append("exact_match")
    elif len(p) < 5:
        why.append("too_short")
        bad = True
    return why if bad else None


def test_failures(spark):
    long = "the stone of the river " * 20
    pairs = [("", "x y"), ("  ", None), ("a a a a a a a a a a", None), ("a b c a a a a a a a", None), ("so so so so so so", "so so so so so so"), ("abcd", ""), ("abcde", ""), ("abcd", "  "), ("ab", "cd"), ("abcd", "abxy"), ("Same Text here", "same  text HERE"), (long, long[7:] + "z"), (None, "none"), ("ok", None)]
    df = spark.createDataFrame([(i, "in", p, r) for i, (p, r) in enumerate(pairs)], PRED)
    got = {r.id: r.reasons for r in evaluate.failures(df).collect()}
    assert got == {i: w for i, (p, r) in enumerate(pairs) if (w := plain(p, r)) is not None}


def test_similarity_is_asymmetric_and_handles_nulls(spark):
    rows = [("", ""), ("tide", "diet"), ("diet", "tide"), (None, "x"), ("a" * 300 + "b", "b" + "a" * 300)]
    df = spark.createDataFrame(rows, "a string, b string").select(evaluate.similarity(F.col("a"), F.col("b")))
    assert [r[0] for r in df.collect()] == [None if a is None else SequenceMatcher(None, a, b).ratio() for a, b in rows]


def test_term_weights(spark):
    texts = ["The cat, the dog", "a dog runs", "naïve CAT cat", ""]
    counts = [Counter(re.findall(r"\w\w+", t.lower())) for t in texts]
    df_ = Counter(w for c in counts for w in c)
    got = {(r.id, r.term): r.weight for r in evaluate.tfidf(spark.createDataFrame(list(enumerate(texts)), "id long, t string"), "id", F.col("t")).collect()}
    want = {}
    for i, c in enumerate(counts):
        raw = {w: n * (math.log(5 / (1 + df_[w])) + 1) for w, n in c.items()}
        size = math.sqrt(sum(x * x for x in raw.values()))
        want |= {(i, w): x / size for w, x in raw.items()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    few = evaluate.tfidf(spark.createDataFrame(list(enumerate(texts)), "id long, t string"), "id", F.col("t"), 1)
    assert {r.term for r in few.collect()} == {"cat"}


@pytest.mark.parametrize("n, k", [(1, 1), (2, 2), (19, 2), (20, 2), (79, 7), (80, 8), (200, 8)])
def test_cluster_count(n, k):
    assert evaluate.cluster_count(n) == k


def test_clusters_and_preview(spark):
    rows = [(i, "stone river" if i % 2 else "sun cloud", "lamp" if i % 2 else "rain", ["x"]) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, input string, prediction string, reasons array<string>")
    made = evaluate.failure_clusters(df, n_init=2).collect()
    assert len({r.cluster for r in made}) == 2 and len({(r.cluster, r.id % 2) for r in made}) == 2
    shown = evaluate.preview(spark.createDataFrame(made)).collect()
    assert [r["count"] for r in shown] == [10, 10] and [r["first"] for r in shown] == [0, 1] and len(shown[0].examples) == 3
    one = evaluate.failure_clusters(df.limit(1), n_init=1)
    assert [r.cluster for r in one.collect()] == [0]
    none = evaluate.failure_clusters(df.limit(0))
    assert none.count() == 0 and evaluate.preview(none).count() == 0


def test_predictions(spark):
    df = spark.createDataFrame([(i, f"p {i}", None) for i in range(9)], "ord long, prompt string, reference string")
    got = evaluate.predicted(df, EchoGenerator(), 3).collect()
    assert [r.id for r in got] == [0, 1, 2] and all(r.prediction.startswith(r.input) for r in got)
    assert evaluate.predicted(df, EchoGenerator(), None).count() == 9
