import pytest
from pyspark.sql import functions as F

from tessera.operators import collect, html
from tessera.sources.connectors import FixedPages, FixedScrape, FixedSearch

HITS = "query string, rank int, link string"


def test_hits_are_filtered_before_the_cut(spark):
    rows = [("q", 0, "https://x.com/a"), ("q", 1, "https://a.org/1"), ("q", 2, "https://a.org/1"), ("q", 3, ""), ("q", 4, None), ("q", 5, "https://wx.com"), ("q", 6, "https://b.org"), ("q", 7, "https://c.org"), ("r", 0, "https://a.org/1")]
    got = collect.first_hits(spark.createDataFrame(rows, HITS), 2).collect()
    assert sorted((r.query, r["rank"]) for r in got) == [("q", 1), ("q", 6), ("r", 0)]
    assert collect.first_hits(spark.createDataFrame(rows, HITS)).count() == 4


@pytest.mark.parametrize("url, hit", [("https://m.facebook.com/", True), ("https://notfacebook.com", False), ("https://wx.com", True), ("https://www.web.com", False), ("https://play.google.com/store", True), ("https://google.com", False), ("nonsense", False), (None, False)])
def test_exclusion(spark, url, hit):
    assert spark.createDataFrame([(url,)], "u string").select(collect.is_excluded("u")).first()[0] is hit


def test_texts(spark):
    rows = [(3, " a "), (1, "b"), (2, "a"), (4, ""), (5, " \n"), (6, None), (7, "b　")]
    df = spark.createDataFrame(rows, "ord long, text string")
    assert sorted((r.ord, r.text) for r in collect.unique_rows(df).collect()) == [(1, "b"), (2, "a")]
    once = collect.unique_rows(df)
    assert sorted(r.ord for r in collect.unique_rows(once).collect()) == [1, 2]
    assert [r.ord for r in collect.capped(once, 1, "ord").collect()] == [1]
    assert collect.capped(once, 0, "ord").count() == 2
    assert [r.text for r in collect.or_placeholder(df.limit(0)).collect()] == [collect.PLACEHOLDER]
    assert collect.or_placeholder(once).count() == 2


def test_connectors(spark):
    class Moody(FixedSearch):
        def search(self, query, n):
            if query == "bad":
                raise OSError
            return super().search(query, n)

    class Half(FixedScrape):
        def scrape(self, url):
            return "  " if url.endswith("0.example.org/q") or "site0" in url else super().scrape(url)

    hits = collect.searched(spark.createDataFrame([("q",), ("bad",)], "query string"), Moody(), 3)
    assert hits.count() == 3
    pages = collect.scraped(hits, Half())
    assert pages.count() == 2 and pages.where("full_text = ''").count() == 0
    assert collect.image_urls(pages).count() == 2
    got = collect.fetched(spark.createDataFrame([(1, "http://a"), (2, "http://gone"), (3, None)], "page_id long, url string"), FixedPages()).collect()
    assert [r.page_id for r in got] == [1]


PAGE = '<html><style>p{}</style><body>Lead <b>bold</b><img src="/a.png" width="640" height="480">mid<img width="9" height="9" src="s.png"><img><img src="//cdn/x" width="100%" height="1">' + "".join(f'<img src="n{i}.png" width="5">t{i} ' for i in range(10)) + "<script>x()</script>tail</body>"


def test_images_and_context(spark):
    text, found = html.read(PAGE)
    assert "x()" not in text and "p{}" not in text and len(found) == 14
    assert text.startswith("Lead bold __IMG_MARKER_0__ mid __IMG_MARKER_1__")
    got = html.images(spark.createDataFrame([(1, "http://h/p/q", PAGE), (2, "u", None)], "page_id long, url string, html string"), 5).orderBy("img_ord").collect()
    assert [r.img_ord for r in got] == [0, 3, *range(4, 14)]
    assert (got[0].context_before, got[0].context_after) == ("bold ", " mid ")
    assert html.context("abc", "zz", 5) == ("", "")
    assert html.context(text, "__IMG_MARKER_1__", 4)[0] == "mid "


def test_addresses(spark):
    rows = [("//c/x", "https://c/x"), ("/r/x", "http://h/r/x"), ("x.png", "http://h/p/x.png"), ("https://o/y", "https://o/y"), ("../up", "http://h/up")]
    df = spark.createDataFrame([(s,) for s, _ in rows], "s string").withColumn("b", F.lit("http://h/p/q"))
    assert [r[0] for r in df.select(html.resolved("s", "b")).collect()] == [w for _, w in rows]
    assert spark.range(1).select(html.file_name(F.lit("abc"))).first()[0] == "a9993e364706816a.jpg"


def test_picture_headers(spark):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (640).to_bytes(4, "big") + (300).to_bytes(4, "big")
    gif = b"GIF89a" + (10).to_bytes(2, "little") + (20).to_bytes(2, "little")
    jpg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + (400).to_bytes(2, "big") + (500).to_bytes(2, "big")
    assert [html.picture_size(x) for x in (png, gif, jpg, b"", b"junk")] == [(640, 300), (10, 20), (500, 400), None, None]
    df = spark.createDataFrame([("a", png), ("b", gif), ("c", jpg), ("d", b"no"), ("e", None)], "path string, content binary")
    assert sorted(r.path for r in html.pictured(df).collect()) == ["a", "c"]
