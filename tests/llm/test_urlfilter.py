import math
import random

import pytest

from tessera.llm import urlfilter

URLS = [
    None, "", "no scheme", "http://", "https://Example.COM/en/x?y#z", "https://www.example.com/en/", "http://a.www.example.com/en/1", "https://badexample.com/en/", "http://example.com", "http://x.net/es/1",
    "http://x.net/ES/1", "http://net/fr/", "ftp://a.net?/es/", "http://a.com#/", "http://a.com/?x", "x://y://z.com/", "http://ÉX.com/é", "http://u:p@h.com:80/q", "http://a.net/fr", "https://sub.example.com/en/" + "p" * 20_000, "://b.com/",
]


def plain(url):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n]), rest[n:]
        path = rest[: next((i for i, c in enumerate(rest) if c in "?#"), len(rest))]
    fits = [(len(h + p), h + p, v) for h, p, v in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_rows_match_brute_force(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(0, URLS[4], "x"), (None, URLS[9], "x")]
    got = urlfilter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string").repartition(3)).collect()
    w, b = urlfilter.train(urlfilter.labelled_urls())
    want = []
    for i, u, _ in rows:
        host, path, rule, verdict = plain(u)
        assert urlfilter.split_url(u) == (host, path)
        want.append((str(i), host, path, rule, verdict or ("block" if urlfilter.scores([host], [path], w, b)[0] >= 0.5 else "allow")))
    assert sorted(map(str, want)) == sorted(str((str(r.page_id), r.host, r.path, r.rule, r.verdict)) for r in got)
    assert urlfilter.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def plain_score(host, path, weights, bias):
    """Probability of block, one character n-gram after the other."""
    buckets = []
    for side, part in ((1, b"^" + host.encode() + b"$"), (2, b"^" + path.encode() + b"$")):
        for n in urlfilter.NGRAMS:
            for i in range(len(part) - n + 1):
                h = side * 31 + n
                for c in part[i : i + n]:
                    h = (h * 0x100000001B3 + c) % (1 << 64)
                for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
                    h = (h ^ h >> 33) * m % (1 << 64)
                buckets.append((h ^ h >> 33) % urlfilter.DIMENSIONS)
    total = sum(float(weights[b]) for b in buckets)
    return 1 / (1 + math.exp(-(total / math.sqrt(max(1, len(buckets))) + bias)))


def test_scores_match_brute_force():
    w, b = urlfilter.train(urlfilter.labelled_urls())
    parts = [urlfilter.split_url(u) for u in URLS]
    got = urlfilter.scores(*zip(*parts), w, b)
    assert all(abs(s - plain_score(h, p, w, b)) < 1e-6 for s, (h, p) in zip(got, parts))


def test_held_out_accuracy():
    data = urlfilter.labelled_urls()
    hosts = sorted({urlfilter.split_url(u)[0] for u, _ in data})
    random.Random(2).shuffle(hosts)
    right = total = 0
    for fold in range(4):
        out = set(hosts[fold::4])  # whole hosts are held out
        w, b = urlfilter.train([d for d in data if urlfilter.split_url(d[0])[0] not in out])
        test = [d for d in data if urlfilter.split_url(d[0])[0] in out]
        p = urlfilter.scores(*zip(*(urlfilter.split_url(u) for u, _ in test)), w, b)
        right += sum((s >= 0.5) == bool(y) for s, (_, y) in zip(p, test))
        total += len(test)
    assert right / total > 0.85


def test_training_is_bounded():
    with pytest.raises(ValueError):
        urlfilter.train([("http://a", 0)] * (urlfilter.MAX_LABELLED + 1))
    w, b = urlfilter.train([])
    assert not w.any() and b == 0
