"""Predictions, what is wrong with them, and clusters of failures."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.functions import order as O
from tessera.functions import text as T

VOCABULARY = 2000
LEAST_SIMILARITY = 0.5


def predicted(rows: DataFrame, generator, max_samples: int | None = 64, max_new_tokens: int = 128, order: str = "ord") -> DataFrame:
    """(id, input, prediction, reference) of the first rows of (order, prompt, reference)."""
    chosen = rows.orderBy(order).limit(max_samples) if max_samples else rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [generator.generate(p, max_new_tokens) for p in b["prompt"]]
            yield pd.DataFrame({"id": b[order], "input": b["prompt"], "prediction": out, "reference": b["reference"]})

    return chosen.select(F.col(order).cast("long").alias(order), "prompt", "reference").mapInPandas(run, "id long, input string, prediction string, reference string")


def similarity(a: Column, b: Column) -> Column:
    """difflib's ratio of two texts: longest matching blocks, in that order of arguments."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y)], dtype="float64")

    return run(a, b)


def _two_places(c: Column) -> Column:
    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda v: None if v is None or v != v else f"{v:.2f}")

    return run(c)


def flagged(predictions: DataFrame, with_similarity: bool = True) -> DataFrame:
    """All columns and empty_output, repetition, similarity, exact_match, too_short of (prediction, reference)."""
    has = F.coalesce(F.col("reference"), F.lit("")) != ""
    if with_similarity:  # its cost grows with the product of two lengths, so rows are dealt out evenly
        predictions = predictions.repartition(max(predictions.sparkSession.sparkContext.defaultParallelism, int(predictions.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    rows = predictions.withColumn("_p", T.normalise(F.coalesce("prediction", F.lit("None")))).withColumn("_r", F.when(has, T.normalise("reference")))
    words = T.tokens(F.col("_p"))
    rows = rows.withColumn("n_tokens", F.size(words).cast("long")).withColumn("n_distinct", F.size(F.array_distinct(words)).cast("long"))
    rows = rows.withColumns({
        "empty_output": F.col("_p") == "",
        "repetition": (F.col("n_tokens") == 0) | (10 * F.col("n_distinct") < 3 * F.col("n_tokens")),
        "exact_match": has & (F.col("_p") == F.col("_r")),
        "too_short": ~has & (F.length("_p") < 5),
        "similarity": similarity(F.col("_p"), F.col("_r")) if with_similarity else F.lit(None).cast("double"),
    })
    return rows.drop("_p", "_r")


def failures(predictions: DataFrame, with_similarity: bool = True) -> DataFrame:
    """The failing rows and their reasons, in the order of the checks; an exact match alone is no failure."""
    f = flagged(predictions, with_similarity)
    unlike = F.coalesce(F.col("similarity") < LEAST_SIMILARITY, F.lit(False))
    named = [F.when(F.col(c), F.lit(c)) for c in ("empty_output", "repetition", "exact_match", "too_short")]
    if with_similarity:
        named.insert(2, F.when(unlike, F.concat(F.lit("low_similarity_"), _two_places(F.col("similarity")))))
    bad = F.col("empty_output") | F.col("repetition") | F.col("too_short") | unlike
    return f.where(bad).withColumn("reasons", F.array_compact(F.array(*named))).select(*predictions.columns, "reasons")


#: Slots of the table in which a row looks its terms up.
_SLOTS = 1 << 13


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({T.TERM})"), 1)


def _counted(text: Column) -> Column:
    """(term, tf) of the different terms of one text: the lengths of equal runs in the sorted terms."""

    def runs(words: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(words) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))
        ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(words)))
        return F.zip_with(starts, ends, lambda i, j: F.struct(F.get(words, i).alias("term"), (j - i).alias("tf")))

    none = F.array().cast("array<struct<term:string,tf:int>>")
    words = F.coalesce(F.sort_array(_terms(text)), F.array().cast("array<string>"))
    # A one-element transform binds the sorted words, so that they are made once.
    return F.flatten(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, runs(w)).otherwise(none)))


def vocabulary_of(docs: DataFrame, text: Column, vocabulary: int = VOCABULARY) -> list[tuple[str, int, float]]:
    """(term, slot, inverse document frequency) of the most frequent terms, by all occurrences in all documents.

    Terms are counted inside each row and pre-aggregated; at most `vocabulary` rows and one reach the driver.
    """
    counts = docs.select(F.explode(F.concat(_counted(text), F.array(F.struct(F.lit("").alias("term"), F.lit(0).alias("tf"))))).alias("c"))
    totals = counts.groupBy("c.term").agg(F.sum("c.tf").alias("total"), F.count("*").alias("df"))
    # The empty term stands in every row, once: its frequency is the number of documents.
    chosen = totals.orderBy(F.col("term") != "", F.desc("total"), "term").limit(vocabulary + 1)
    rows = chosen.withColumn("slot", F.pmod(F.xxhash64("term"), F.lit(_SLOTS))).collect()
    n = next((r["df"] for r in rows if not r["term"]), 0)
    return [(r["term"], r["slot"], math.log((1 + n) / (1 + r["df"])) + 1) for r in rows if r["term"]]


def tfidf(docs: DataFrame, key: str, text: Column, vocabulary: int = VOCABULARY) -> DataFrame:
    """(key, term, weight), where a row is a document: terms of two characters or more, the most frequent `vocabulary` of
    the corpus, smoothed inverse document frequency plus one, rows of length one.

    Only term totals are shuffled. A row counts its terms, looks them up in the vocabulary, whose size is bounded and which
    is part of the plan, and takes its own length; terms leave the row last.
    """
    slots: dict[int, list] = {}
    for term, slot, idf in vocabulary_of(docs, text, vocabulary):
        slots.setdefault(slot, []).append({"term": term, "idf": idf})
    table = F.from_json(F.lit(json.dumps([slots.get(i, []) for i in range(_SLOTS)])), "array<array<struct<term:string,idf:double>>>")
    found = lambda c: F.get(F.filter(F.get(table, F.pmod(F.xxhash64(c["term"]), F.lit(_SLOTS)).cast("int")), lambda e: e["term"] == c["term"]), F.lit(0))
    weighed = F.transform(_counted(text), lambda c: F.struct(c["term"].alias("term"), (c["tf"] * found(c)["idf"]).alias("w")))
    known = F.transform(F.array(F.filter(weighed, lambda x: x["w"].isNotNull())), lambda x: F.struct(x.alias("x"), F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, e: a + e["w"] * e["w"])).alias("norm")))
    rows = docs.select(key, F.explode(known).alias("k")).select(key, "k.norm", F.explode("k.x").alias("x"))
    return rows.select(key, F.col("x.term").alias("term"), (F.col("x.w") / F.col("norm")).alias("weight"))


def cluster_count(n: int) -> int:
    return min(n, min(8, max(2, n // 10)))


def vectors(docs: DataFrame, key: str, text: Column, vocabulary: int = VOCABULARY) -> DataFrame:
    """(key, features): each document's term weights as a sparse vector of length one over the vocabulary."""
    known = vocabulary_of(docs, text, vocabulary)
    rows = docs.select(key, F.coalesce(_terms(text), F.array().cast("array<string>")).alias("terms"))
    counts = CountVectorizerModel.from_vocabulary([t for t, _, _ in known] or [""], inputCol="terms", outputCol="counts")
    scale = ElementwiseProduct(scalingVec=Vectors.dense([w for _, _, w in known] or [1.0]), inputCol="counts", outputCol="scaled")
    return Normalizer(p=2.0, inputCol="scaled", outputCol="features").transform(scale.transform(counts.transform(rows))).select(key, "features")


def clustered(features: DataFrame, n: int, n_init: int = 10, seed: int = 42) -> DataFrame:
    """All columns and `cluster`: the cheapest of `n_init` k-means runs; no rows in, no rows out."""
    if n == 0:
        return features.withColumn("cluster", F.lit(None).cast("int"))
    if n == 1:
        return features.withColumn("cluster", F.lit(0))
    features = features.persist()
    try:
        fits = [KMeans(k=max(2, cluster_count(n)), seed=seed + i, featuresCol="features", predictionCol="cluster").fit(features) for i in range(n_init)]
        best = min(fits, key=lambda m: m.summary.trainingCost)
    finally:
        features.unpersist()
    return best.transform(features)


def preview(failures: DataFrame, order: str = "id", n: int = 3, *show: str) -> DataFrame:
    """(cluster, count, examples, first): the first n rows of each cluster; clusters in order of first appearance."""
    show = show or ("input", "prediction", "reasons")
    placed = failures.withColumn("_n", F.row_number().over(W.partitionBy("cluster").orderBy(order)))
    top = placed.where(F.col("_n") <= n).groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("_n", *show))).alias("x"))
    sizes = failures.groupBy("cluster").agg(F.count("*").alias("count"), F.min(order).alias("first"))
    shown = F.transform("x", lambda e: F.struct(*(e[s].alias(s) for s in show)))
    return sizes.join(top, "cluster").select("cluster", "count", shown.alias("examples"), "first").orderBy("first")


def failure_clusters(failed: DataFrame, order: str = "id", n_init: int = 10, seed: int = 42) -> DataFrame:
    """Failures (order, input, prediction, …) with a cluster each, by their weighted terms; read once, then kept."""
    failed = O.held(failed)
    groups = clustered(vectors(failed, order, F.concat_ws(" ", "input", "prediction")), failed.count(), n_init, seed)
    return failed.join(groups.select(order, "cluster"), order, "left").withColumn("cluster", F.coalesce("cluster", F.lit(0)))
