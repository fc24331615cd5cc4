"""Collection and cleaning of search results and texts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.functions import text as T
from tessera.operators.html import picture_size
from tessera.sources.writers import write_once

# Domains that searches leave out.
EXCLUDED_DOMAINS = (
    "facebook.com", "instagram.com", "youtube.com", "tiktok.com", "twitter.com", "x.com", "reddit.com", "pinterest.com",
    "linkedin.com", "vk.com", "ok.ru", "t.me", "play.google.com", "apps.apple.com",
)
PLACEHOLDER = "(no text collected)"


def search_query(query: Column | str, domains: Iterable[str] = EXCLUDED_DOMAINS) -> Column:
    """The query followed by an exclusion for each domain."""
    return F.concat(T.col(query), F.lit("".join(f" -site:{d}" for d in domains)))


def is_excluded(url: Column | str, domains: Iterable[str] = EXCLUDED_DOMAINS) -> Column:
    return T.under_domain(T.bare_host(url), tuple(domains))


def first_hits(hits: DataFrame, n: int | None = None, domains: Iterable[str] = EXCLUDED_DOMAINS) -> DataFrame:
    """Of hits (query, rank, link, …) the best-ranked row of each link in each query, without empty and excluded links;
    then the best `n` of each query. Links are dealt out by (query, link), and only the best n of each task go on to the
    second window, so a query with most of the hits burdens no task."""
    usable = hits.where((F.coalesce("link", F.lit("")) != "") & ~is_excluded("link", domains))
    kept = usable.withColumn("_first", F.row_number().over(W.partitionBy("query", "link").orderBy("rank"))).where("_first = 1").drop("_first")
    if n is None:
        return kept
    return kept.withColumn("_place", F.row_number().over(W.partitionBy("query").orderBy("rank"))).where(F.col("_place") <= n).drop("_place")


def distinct_queries(queries: DataFrame) -> DataFrame:
    """(q_ord, query): a repeated query keeps its first place."""
    return queries.groupBy("query").agg(F.min("q_ord").alias("q_ord"))


def unique_texts(texts: DataFrame, text: str = "text", order: str = "ord") -> DataFrame:
    """(order, text_md5, text columns dropped): the first row of each stripped, non-empty text.

    Grouped on a 256-bit digest with a pre-aggregated minimum, so a text that fills a third of the table reaches the
    shuffle once per task and no text is shuffled at all.
    """
    body = T.strip(F.col(text))
    rows = texts.select(F.col(order), body.alias("_body")).where("_body <> ''")
    rows = rows.select(order, F.sha2("_body", 256).alias("_key"), F.md5("_body").alias("text_md5"), F.length("_body").cast("long").alias("n_chars"))
    return rows.groupBy("_key", "text_md5", "n_chars").agg(F.min(order).alias(order)).drop("_key")


def unique_rows(texts: DataFrame, text: str = "text", order: str = "ord") -> DataFrame:
    """The rows themselves, stripped: the survivors' ordinals joined back."""
    keep = unique_texts(texts, text, order).select(order)
    return texts.join(keep, order, "left_semi").withColumn(text, T.strip(F.col(text)))


def capped(df: DataFrame, size: int | None, order: str) -> DataFrame:
    """The first `size` rows in order; all of them where size is null or 0."""
    return df.orderBy(order).limit(size) if size else df


def or_placeholder(texts: DataFrame) -> DataFrame:
    """The texts and their order, if they have one, or the placeholder row where there are none; decided inside the plan,
    without an action."""
    columns = [c for c in ("ord", "text") if c in texts.columns]
    one = texts.sparkSession.range(1).select(F.lit(0).cast("long").alias("ord"), F.lit(PLACEHOLDER).alias("text")).select(*columns)
    some = texts.select(F.lit(1).alias("_some")).limit(1)
    return texts.select(*columns).unionByName(one.join(some, F.lit(True), "left_anti"))


def together(call: Callable, values: Iterable, n: int) -> list:
    """The results of `call`, in order, up to `n` of them under way at once; None where it raises."""

    def one(value):
        try:
            return call(value)
        except Exception:
            return None

    with ThreadPoolExecutor(max(1, n)) as pool:
        return list(pool.map(one, values))


def searched(queries: DataFrame, connector, n: int = 10, concurrency: int = 1) -> DataFrame:
    """(query, rank, link, snippet) from a search connector, asked `concurrency` times at once by a task; a failing search
    gives no rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = together(lambda q: connector.search(q, n), b["query"], concurrency)
            rows = [(q, i, h.get("link"), h.get("snippet")) for q, hits in zip(b["query"], found) for i, h in enumerate(hits or [])]
            yield pd.DataFrame(rows, columns=["query", "rank", "link", "snippet"])

    return queries.select("query").mapInPandas(run, "query string, rank long, link string, snippet string")


def scraped(hits: DataFrame, connector, concurrency: int = 1) -> DataFrame:
    """(query, rank, url, snippet, full_text) of the pages whose text could be read and is not blank."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [(t or "").strip() for t in together(connector.scrape, b["link"], concurrency)]
            out = pd.DataFrame({"query": b["query"], "rank": b["rank"], "url": b["link"], "snippet": b["snippet"], "full_text": texts})
            yield out[out["full_text"] != ""]

    return hits.select("query", "rank", "link", "snippet").mapInPandas(run, "query string, rank long, url string, snippet string, full_text string")


def image_urls(pages: DataFrame) -> DataFrame:
    """Page addresses over all queries, in order, repeats kept."""
    return pages.where(F.coalesce("url", F.lit("")) != "").select("query", "rank", "url")


def fetched(addresses: DataFrame, connector, concurrency: int = 1) -> DataFrame:
    """(page_id, url, html) of the addresses (page_id, url) that answer with status 200; others give no rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = together(connector.fetch, b["url"], concurrency)
            rows = [(page, url, g[1]) for page, url, g in zip(b["page_id"], b["url"], got) if g is not None and g[0] == 200]
            yield pd.DataFrame(rows, columns=["page_id", "url", "html"])

    return addresses.select("page_id", "url").mapInPandas(run, "page_id long, url string, html string")


def pictures(addresses: DataFrame, connector, folder: str, min_width: int = 300, min_height: int = 300, concurrency: int = 1) -> DataFrame:
    """(name, path, width, height) of the pictures at (name, url) that answer with status 200, decode and are large enough,
    written below a folder that all executors share; contents stay in the task, `concurrency` of them at a time."""
    step = max(1, concurrency)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i in range(0, len(b), step):
                part = b.iloc[i : i + step]
                for name, got in zip(part["name"], together(connector.fetch, part["url"], concurrency)):
                    size = picture_size(got[1]) if got is not None and got[0] == 200 else None
                    if size and size[0] >= min_width and size[1] >= min_height:
                        rows.append((name, write_once(folder, name, got[1]), *size))
            yield pd.DataFrame(rows, columns=["name", "path", "width", "height"])

    return addresses.select("name", "url").mapInPandas(run, "name string, path string, width int, height int")
