"""Registered queries of the package: each applies its operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontam, licenses, packing, quality, simhash, substrings, tokencount, tokenids, urlfilter, warc
from tessera.sources import readers

#: The vocabulary whose ids and counts the queries return.
BYTE_BPE = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.table(spark, sf_dir, name, spread=True)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(spark, _table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spark, _table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, _table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.hits(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_key")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(_table(spark, sf_dir, "documents")).select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, _table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(spark, _table(spark, sf_dir, "documents"))


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenids.write_matrices(spark, _table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return tokenids.read_segments(spark, files)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_warc, op2_licenses, op3_simhash, op4_decontamination, op5_url_filter, op6_quality_rules, op7_token_counts, op8_packing, op9_substrings, op10_token_ids)}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1_SQL, "op2_licenses": licenses.oracle(), "op4_decontamination": OP4_SQL, "op9_substrings": OP9_SQL}


OP1_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
     d as (select page_id, strlen(html) as n, sha1(html) as digest from p),
     m as (select digest, n, max(page_id) as top from d where n >= 1000 group by digest, n)
select d.page_id, cast(d.n as bigint) as payload_bytes, d.digest as payload_digest,
       case when m.top is null or m.top = d.page_id then 'response' else 'revisit' end as record_type,
       case when m.top <> d.page_id then m.top end as refers_to
from d left join m on m.digest = d.digest and m.n = d.n
"""

OP9_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
     p as (select doc_id, i, array_to_string(ws[i:i + 12], ' ') as k from (select *, unnest(range(1, len(ws) - 11)) as i from w)),
     m as (select k, min(doc_id) as least from p group by k),
     hit as (select doc_id, i from p join m using (k) where doc_id > least),
     gone as (select distinct doc_id, i + unnest(range(0, 13)) as i from hit),
     g as (select doc_id, count(*) as n, list(i) as gone from gone group by doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n, 0) as n_removed,
       sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(ws) + 1), lambda i: gone is null or not list_contains(gone, i)), lambda i: ws[i]), ' '), '')) as kept_sha256
from w left join g on g.doc_id = w.doc_id
"""

OP4_SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
     b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
     sizes as (select distinct least(13, len(ws)) as k from b where len(ws) > 0),
     iw as (select distinct item_id, k, array_to_string(ws[i:i + k - 1], ' ') as w from (select item_id, ws, least(13, len(ws)) as k, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) as i from b where len(ws) > 0)),
     dw as (select doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') as w from (select doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) as i from d, sizes where len(ws) >= k)),
     hit as (select doc_id, item_id, i, k from dw join iw using (k, w)),
     n as (select doc_id, count(distinct p) as n_hit from (select doc_id, i + unnest(range(0, k)) as p from hit) group by doc_id),
     m as (select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as items from (select distinct doc_id, cast(item_id as varchar) as s from hit) group by doc_id)
select d.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join n on n.doc_id = d.doc_id left join m on m.doc_id = d.doc_id
"""
