"""Benchmark decontamination by winnowing.

Of every nine consecutive 5-gram hashes the least is a fingerprint, so any span of 13 words that a document shares with
a benchmark item has a fingerprint at the same place in both. Document fingerprints that miss a bitmap of the benchmark's
are dropped at once (a bitmap has false hits only); the others are joined on their hash, and each meeting is extended word
by word in both directions to tell how long the shared span really is. Items whose words around a fingerprint are the same
meet documents as one; the documents of a hot fingerprint are dealt out over as many copies of it as their number asks
for. Items under 13 words are one window of their own length, found by that length's hashes in the same way.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tessera.llm.common import ALNUM, from_blocks, hashes_of, in_blocks, record_batch, rolling, scratch, slices, starts_of, stored, texts_of, words_of

SPAN = 13
GRAM = 5
#: Bits of the bitmap sent to executors, as a power of two: sixteen a fingerprint of the benchmark; 2 MB at least, 32 at most.
LEAST_BITS, MOST_BITS = 24, 28
#: Places in documents of one fingerprint that a copy of it meets.
HOT = 1 << 16
#: Contaminated rows up to which their keys are broadcast, 16 bytes each; beyond, keys are shuffled.
BROADCAST_ROWS = 1 << 20

_HITS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("kind", pa.int32()), ("h", pa.int64()), ("at", pa.int64()), ("lead", pa.int32()), ("words", pa.string())])
HIT_SCHEMA = "doc_id long, text_key long, n_words long, kind int, h long, at long, lead int, words string"


def _slide(a: np.ndarray, n: int, f) -> np.ndarray:
    """f over every n consecutive values, by doubling."""
    size, out = 1, a
    while 2 * size <= n:
        out = f(out[:-size], out[size:])
        size *= 2
    return out if size == n else f(out[: len(a) - n + 1], out[n - size : n - size + len(a) - n + 1])


def winnowed(word_hashes: np.ndarray, offsets: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first words of the grams that are least in some window of `span` words of one text, ties included."""
    start = starts_of(offsets, span)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = rolling(word_hashes, gram) | np.uint64(1)
    n = span - gram + 1
    least = np.zeros(len(h) - n + 1, np.uint64)
    least[start] = _slide(h, n, np.minimum)[start]
    pad = np.zeros(n - 1, np.uint64)
    at = np.flatnonzero(_slide(np.concatenate([pad, least, pad]), n, np.maximum) == h)
    return h[at], at


def grams_of(word_hashes: np.ndarray, offsets: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of the grams of a kind: SPAN for fingerprints of long items, else an item's own length."""
    if kind == SPAN:
        h, at = winnowed(word_hashes, offsets)
    else:
        at = starts_of(offsets, kind)
        h = rolling(word_hashes, kind)[at]
    with np.errstate(over="ignore"):
        return h ^ (np.uint64(kind) * np.uint64(0x9E3779B97F4A7C15)), at


def _found(batch: pa.RecordBatch, kinds, bitmap: np.ndarray | None, bits: int, whole: bool) -> pa.RecordBatch:
    """Rows of grams that the bitmap knows, with the words around them; `whole`: one row more per text, of no kind."""
    ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    codes, words, offsets = words_of(texts_of(batch, "text"), ALNUM)
    n = np.diff(offsets)
    hashes = hashes_of(words)[codes] if len(codes) else np.zeros(0, np.uint64)
    rows = [(d, k, m, None, None, None, None, None) for d, k, m in zip(ids, keys, n.tolist())] if whole else []
    plain = None
    for kind in kinds:
        h, at = grams_of(hashes, offsets, kind)
        owner = np.searchsorted(offsets, at, side="right") - 1
        if bitmap is not None:
            bit = h >> np.uint64(64 - bits)
            known = (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0
        else:
            known = (n[owner] >= SPAN) == (kind == SPAN)
            known &= (kind == SPAN) | (n[owner] == kind)
        h, at, owner = h[known].view(np.int64).tolist(), at[known].tolist(), owner[known].tolist()
        if h and plain is None:
            plain = words.to_pylist()
        around, size = (SPAN - GRAM, GRAM) if kind == SPAN else (0, kind)
        for x, p, o in zip(h, at, owner):
            lo, hi = max(int(offsets[o]), p - around), min(int(offsets[o + 1]), p + size + around)
            rows.append((ids[o], keys[o], int(n[o]), kind, x, p - int(offsets[o]), p - lo, " ".join(plain[c] for c in codes[lo:hi].tolist())))
    return record_batch(_HITS, [list(c) for c in zip(*rows)] if rows else [[] for _ in _HITS])


def shared(a: list[str], i: int, b: list[str], j: int, size: int) -> tuple[int, int]:
    """How many equal words two lists have before and from their grams at i and j; (0, 0) if the grams differ."""
    if a[i : i + size] != b[j : j + size]:
        return 0, 0
    left = 0
    while left < min(i, j) and a[i - left - 1] == b[j - left - 1]:
        left += 1
    right = size
    while i + right < len(a) and j + right < len(b) and a[i + right] == b[j + right]:
        right += 1
    return left, right


def _keyed(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return table.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))


def _bitmap(prints: DataFrame, bits: int) -> np.ndarray:
    """Bits of all benchmark fingerprints; what reaches the driver is at most the bitmap itself."""
    bit = F.shiftrightunsigned("h", 64 - bits)
    words = prints.select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - bits}) & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(1 << max(0, bits - 6), np.int64)
    for r in words.toLocalIterator():
        out[r.w] = r.b
    return out.view(np.uint64)


def spans(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", bits: int | None = None, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(every document row with n_words; the hit spans (doc_id, text_key, item_ids, start, stop) in words).

    `bits` and `hot` set the cost and never the result.
    """

    def of_items(batches):
        for b in slices(batches, "text"):
            yield _found(b, range(1, SPAN + 1), None, 0, False)

    prints = stored(spark, _keyed(benchmark, item_col, item_text_col).mapInArrow(of_items, HIT_SCHEMA), "benchmark")
    kinds = sorted(r.kind for r in prints.select("kind").distinct().collect())  # at most SPAN values
    bits = bits or min(MOST_BITS, max(LEAST_BITS, (16 * prints.count()).bit_length()))
    bitmap = _bitmap(prints, bits)

    def of_docs(batches):
        for b in slices(batches, "text"):
            yield _found(b, kinds, bitmap, bits, True)

    found = stored(spark, _keyed(docs, id_col, text_col).mapInArrow(of_docs, HIT_SCHEMA), "fingerprints")
    rows = found.where("kind is null").select("doc_id", "text_key", "n_words")
    places = found.where("kind is not null")
    salts = stored(spark, places.groupBy("kind", "h").count().where(F.col("count") > hot).select("kind", "h", F.ceil(F.col("count") / F.lit(hot)).alias("salts")), "salts")
    salted = F.pmod(F.xxhash64("doc_id", "text_key", "at"), F.coalesce("salts", F.lit(1))).alias("salt")
    places = places.join(salts, ["kind", "h"], "left").select("doc_id", "text_key", "kind", "h", "at", "lead", "words", salted)
    items = prints.groupBy("kind", "h", F.col("lead").alias("item_lead"), F.col("words").alias("item_words")).agg(F.sort_array(F.collect_set("doc_id")).alias("item_ids"))
    items = items.join(salts, ["kind", "h"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    met = places.join(items.hint("shuffle_hash"), ["kind", "h", "salt"])
    met = met.select("doc_id", "text_key", "kind", "at", "lead", "words", "item_ids", "item_lead", "item_words")
    out = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("item_ids", pa.list_(pa.int64())), ("start", pa.int64()), ("stop", pa.int64())])

    def extended(batches):
        for b in batches:
            rows = []
            for doc, key, kind, at, lead, words, item, item_lead, item_words in zip(*(c.to_pylist() for c in b.columns)):
                size = GRAM if kind == SPAN else kind
                left, right = shared(words.split(" "), lead, item_words.split(" "), item_lead, size)
                if left + right >= kind:
                    rows.append((doc, key, item, at - left, at + right))
            yield record_batch(out, [list(c) for c in zip(*rows)] if rows else [[] for _ in out])

    return rows, met.mapInArrow(extended, "doc_id long, text_key long, item_ids array<long>, start long, stop long")


def hits(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, **cols) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row.

    A hit word lies in an occurrence of a window of 13 item words, or of a whole shorter item; a document is contaminated
    from 5 hit words in 100. Null and empty texts have no words and no windows. Rows equal in doc_id and text are judged
    alike and each keeps its row; a null doc_id stays null; a null item_id hits but is not counted among items. An empty
    benchmark hits nothing; an empty table gives no rows.
    """
    rows, found = spans(spark, docs, benchmark, **cols)
    found = found.distinct()
    key = ["doc_id", "text_key"]
    before = F.max("stop").over(W.partitionBy(*key).orderBy("start", "stop", "item_ids").rowsBetween(W.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))))
    each = found.select(*key, "item_ids", fresh.alias("fresh")).groupBy(*key).agg(F.sum("fresh").alias("n_hit"), F.array_distinct(F.flatten(F.collect_set("item_ids"))).cast("array<string>").alias("items"))
    each = each.select(F.col("doc_id").alias("hit_doc"), F.col("text_key").alias("hit_key"), "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"))
    joined = rows.join(each, rows.doc_id.eqNullSafe(each.hit_doc) & (rows.text_key == each.hit_key), "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return joined.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "text_key")


def uncontaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **cols) -> DataFrame:
    """The rows that are not contaminated, with all their columns.

    Rows without words stay; rows equal in id and text stay or go together, whatever their other columns; ids may be null;
    an empty benchmark keeps every row, an empty table gives none. Where the contaminated rows are too many to broadcast
    their keys, these meet the rows' keys in an exchange; texts are never shuffled.
    """
    bad = stored(spark, hits(spark, docs, benchmark, id_col=id_col, text_col=text_col, **cols).where("contaminated").select(F.col("doc_id").alias("bad_doc"), F.col("text_key").alias("bad_key")).distinct(), "contaminated")
    if bad.count() <= BROADCAST_ROWS:
        same = docs[id_col].cast(T.LongType()).eqNullSafe(bad.bad_doc) & (F.xxhash64(docs[text_col]) == bad.bad_key)
        return docs.join(F.broadcast(bad), same, "left_anti")
    folder = scratch(spark, "clean")
    keys = docs.select("*", F.xxhash64(text_col).alias(key := f"key_{uuid.uuid4().hex}"))
    rows = in_blocks(spark, keys, folder, text_col, id_col, ["text_key"], lambda b: [b.column(b.schema.get_field_index(key))])
    keep = rows.join(bad, rows.id.eqNullSafe(bad.bad_doc) & (rows.text_key == bad.bad_key), "left_anti")
    return from_blocks(rows, keep, folder, docs.schema)
