"""URL filters: longest-match host and path rules, and a logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mixed, record_batch

#: (host, path, verdict); a rule holds for its host and all subdomains where the url's path starts with the rule's.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))

#: Width of the hashed feature space; the weights sent to executors are this many float32 whatever the data.
DIMENSIONS = 1 << 16
NGRAMS = (2, 3, 4, 5)
#: The largest labelled table the driver trains on.
MAX_LABELLED = 10_000

_ALLOW_HOSTS = ("docs.python-guide.org", "library.university.edu", "en.encyclopedia.org", "www.city-museum.org", "archive.science-journal.org", "blog.gardening-notes.net", "research.institute.edu", "www.history-society.org", "wiki.open-maps.org", "news.local-paper.net", "www.recipes-at-home.com", "learn.mathematics.edu", "forum.woodworking.org", "www.national-park.gov", "health.clinic-info.org", "static.book-reviews.net")
_ALLOW_PATHS = ("/", "/article/2021/river-ecology", "/en/introduction.html", "/wiki/Photosynthesis", "/docs/tutorial/part-2", "/blog/how-to-prune-roses", "/papers/1998/volume3/abstract", "/fr/histoire-de-la-ville", "/de/anleitung/", "/es/noticias/cultura", "/about")
_BLOCK_HOSTS = ("win-casino-bonus.biz", "xxx-live-cams.net", "cheap-pills-online.info", "free-crack-download.ru", "hot-adult-dating.top", "www.lucky-slots777.com", "buy-viagra-now.shop", "torrent-warez.cc", "ads.click-track.biz", "sexy-webcam-chat.xxx", "payday-loan-fast.loan", "poker-jackpot.bet", "replica-watches-sale.shop", "seo-backlinks.click", "porn-tube-free.top", "fake-followers.click")
_BLOCK_PATHS = ("/", "/free-bonus?aff=1234", "/xxx/video/123456", "/buy-now/cheap/viagra", "/download/crack-keygen.exe", "/casino/slots/jackpot", "/adult/cams/live", "/click?track=99&ad=7", "/porn/hd/", "/cart?promo=sale90", "/tag/escort")


def labelled_urls() -> list[tuple[str, int]]:
    """The small labelled table: every host with every path of its class, 1 for block."""
    good = [(f"https://{h}{p}", 0) for h in _ALLOW_HOSTS for p in _ALLOW_PATHS]
    return good + [(f"http://{h}{p}", 1) for h in _BLOCK_HOSTS for p in _BLOCK_PATHS]


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path of one url, by the same definition as `host_path`."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return rest[:end].translate({c: c + 32 for c in range(65, 91)}), path[:stop]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` to `/`, `?`, `#` or the end, A-Z lower-cased; path: from there to `?`, `#` or the end."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def features(hosts: list[bytes], paths: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every character n-gram, host and path hashed apart, vectorised over the whole batch."""
    rows, buckets = [], []
    for side, parts in ((1, [b"^" + h + b"$" for h in hosts]), (2, [b"^" + p + b"$" for p in paths])):
        raw = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        ends, row = np.cumsum(size), np.repeat(np.arange(len(parts)), size)
        for n in NGRAMS:
            m = len(raw) - n + 1
            if m <= 0:
                continue
            with np.errstate(over="ignore"):
                h = np.full(m, side * 31 + n, np.uint64)
                for j in range(n):
                    h = h * np.uint64(0x100000001B3) + raw[j : m + j]
                h = mixed(h)
            inside = np.arange(m) + n <= ends[row[:m]]
            rows.append(row[:m][inside])
            buckets.append((h[inside] % np.uint64(DIMENSIONS)).astype(np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(buckets)


def scores(hosts: list[str], paths: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """Probability of block."""
    row, bucket = features([h.encode() for h in hosts], [p.encode() for p in paths])
    n = len(hosts)
    total = np.bincount(row, weights=weights[bucket], minlength=n)
    count = np.maximum(1, np.bincount(row, minlength=n))
    return 1 / (1 + np.exp(-(total / np.sqrt(count) + bias)))


def train(labelled: list[tuple[str, int]], steps: int = 300, rate: float = 0.5, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Full-batch gradient descent on the labelled table, whose size is bounded by MAX_LABELLED."""
    if len(labelled) > MAX_LABELLED:
        raise ValueError(f"the labelled table has {len(labelled)} rows, at most {MAX_LABELLED} are trained on")
    if not labelled:
        return np.zeros(DIMENSIONS, np.float32), 0.0
    parts = [split_url(u) for u, _ in labelled]
    y = np.array([v for _, v in labelled], float)
    row, bucket = features([h.encode() for h, _ in parts], [p.encode() for _, p in parts])
    n = len(y)
    value = (1 / np.sqrt(np.maximum(1, np.bincount(row, minlength=n))))[row]
    w, bias = np.zeros(DIMENSIONS), 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(np.bincount(row, weights=w[bucket] * value, minlength=n) + bias)))
        g = (p - y) / n
        w -= rate * (10 * np.bincount(bucket, weights=g[row] * value, minlength=DIMENSIONS) + decay * w)
        bias -= rate * g.sum()
    return w.astype(np.float32), float(bias)


def judge_urls(pages: DataFrame, labelled: list[tuple[str, int]] | None = None, rules=RULES, threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and score of every url.

    The longest fitting rule decides, else the classifier. A null url or one without `://` has an empty host and path and
    is judged by the classifier. One row per input row; an empty table gives none. Rules run as built-in expressions,
    the classifier in one Arrow pass with a fixed-size weight vector; no shuffle.
    """
    weights, bias = train(labelled_urls() if labelled is None else labelled)
    host, path = host_path(F.col("url"))
    parts = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    parts = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    out = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()), ("score", pa.float64())])

    def run(batches):
        for b in batches:
            page, h, p, r, ruled = (b.column(i) for i in range(5))
            s = scores(h.to_pylist(), p.to_pylist(), weights, bias)
            judged = [v or ("block" if x >= threshold else "allow") for v, x in zip(ruled.to_pylist(), s)]
            yield record_batch(out, [page.cast(pa.int64()), h.cast(pa.string()), p.cast(pa.string()), r.cast(pa.string()), judged, s])

    return parts.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, score double")
