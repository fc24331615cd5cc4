"""Images and the text around them, from HTML."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import col

_SILENT = {"script", "style", "template"}
# Fixed value: what stands in a text for its n-th image.
MARKER = "__IMG_MARKER_%d__"


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.images: list[dict[str, str | None]] = []
        self.silent: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT:
            self.silent.append(tag)
        elif tag == "img":
            self.parts.append(MARKER % len(self.images))
            self.images.append(dict(attrs))

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        if self.silent and tag == self.silent[-1]:
            self.silent.pop()

    def handle_data(self, data):
        if not self.silent and data.strip():
            self.parts.append(data.strip())


def read(html: str) -> tuple[str, list[dict[str, str | None]]]:
    """Text nodes joined by single spaces, with a marker before each image, and the images' attributes."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    return " ".join(reader.parts), reader.images


def large_enough(attrs: dict[str, str | None], min_width: int, min_height: int) -> bool:
    """Whether the stated size allows the image; sizes that are missing or no integers do."""
    width, height = attrs.get("width"), attrs.get("height")
    try:
        return not (width and height and (int(width) < min_width or int(height) < min_height))
    except ValueError:
        return True


def context(text: str, marker: str, size: int) -> tuple[str, str]:
    before, found, after = text.partition(marker)
    return (before[max(0, len(before) - size) :], after[:size]) if found else ("", "")


IMAGE_SCHEMA = "page_id long, url string, img_ord int, img_url string, context_before string, context_after string"


def images(pages: DataFrame, size: int = 500, min_width: int = 300, min_height: int = 300) -> DataFrame:
    """A row for each image of pages (page_id, url, html) that has a source and is not stated to be too small."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for page, url, html in zip(b["page_id"], b["url"], b["html"]):
                text, found = read(html or "")
                for i, attrs in enumerate(found):
                    if attrs.get("src") and large_enough(attrs, min_width, min_height):
                        rows.append((page, url, i, attrs["src"], *context(text, MARKER % i, size)))
            yield pd.DataFrame(rows, columns=["page_id", "url", "img_ord", "img_url", "context_before", "context_after"])

    return pages.select("page_id", "url", "html").mapInPandas(run, IMAGE_SCHEMA)


def resolved(src: Column | str, base: Column | str) -> Column:
    """An image address made absolute; forms that need no path arithmetic stay built-in expressions."""
    src, base = col(src), col(base)

    @F.pandas_udf("string")
    def join(b: pd.Series, s: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else urljoin(y or "", x) for y, x in zip(b, s)])

    return F.when(src.startswith("//"), F.concat(F.lit("https:"), src)).when(src.rlike("^https?://"), src).otherwise(join(base, src))


def rooted(src: Column | str, base: Column | str) -> Column:
    """The same for `//x`, `/x` and absolute addresses, without Python."""
    src, base = col(src), col(base)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    return F.when(src.startswith("//"), F.concat(F.lit("https:"), src)).when(src.startswith("/"), F.concat(origin, src)).otherwise(src)


def file_name(url: Column | str) -> Column:
    """Content-addressed file name of an image address."""
    return F.concat(F.substring(F.sha1(col(url)), 1, 16), F.lit(".jpg"))


def picture_size(head: bytes) -> tuple[int, int] | None:
    """Width and height from the header of a PNG, GIF or JPEG file, else None."""
    if head[:8] == b"\x89PNG\r\n\x1a\n" and len(head) >= 24:
        return int.from_bytes(head[16:20], "big"), int.from_bytes(head[20:24], "big")
    if head[:6] in (b"GIF87a", b"GIF89a") and len(head) >= 10:
        return int.from_bytes(head[6:8], "little"), int.from_bytes(head[8:10], "little")
    at = 2
    while head[:2] == b"\xff\xd8" and at + 9 <= len(head) and head[at] == 0xFF:
        if 0xC0 <= head[at + 1] <= 0xCF and head[at + 1] not in (0xC4, 0xC8, 0xCC):
            return int.from_bytes(head[at + 7 : at + 9], "big"), int.from_bytes(head[at + 5 : at + 7], "big")
        at += 2 + int.from_bytes(head[at + 2 : at + 4], "big")
    return None


def pictured(files: DataFrame, min_width: int = 300, min_height: int = 300) -> DataFrame:
    """Of (path, content) the files that decode and are large enough, with width and height."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(p, *s) for p, c in zip(b["path"], b["content"]) if c is not None and (s := picture_size(bytes(c))) and s[0] >= min_width and s[1] >= min_height]
            yield pd.DataFrame(rows, columns=["path", "width", "height"])

    return files.select("path", "content").mapInPandas(run, "path string, width int, height int")
