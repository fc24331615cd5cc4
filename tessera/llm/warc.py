"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames of about a megabyte; a bundle ends with the seek table of the public
seekable format (a skippable frame of compressed and decompressed frame sizes), and an index table maps each record
to its bundle, frame and offset inside the frame, so one record is read by decompressing one frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import located, record_batch, scratch, slices, stored

#: Payloads of at least so many bytes are recorded once; further equal ones become revisits.
REVISIT_BYTES = 1000
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
#: The page, and what tells its record from others: the payload's digest where revisits refer to it, else bundle and number.
_ID = "<urn:tessera:page:%s:%s>"
_INDEX = pa.schema([("bundle", pa.string()), ("page_id", pa.int64()), ("frame", pa.int32()), ("frame_at", pa.int64()), ("record_at", pa.int32()), ("record_bytes", pa.int32())])
INDEX_SCHEMA = "bundle string, page_id long, frame int, frame_at long, record_at int, record_bytes int"
_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])
READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def _uri(url: str) -> str:
    """A header value may hold no control characters."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False, mark: str | None = None) -> bytes:
    """One WARC/1.1 record; a revisit keeps length and digest of the payload that it leaves out.

    The identifier has the payload's digest, or `mark` in its place for records that no revisit refers to.
    """
    digest = hashlib.sha1(payload)
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: " + (_ID % (page_id, mark or digest.hexdigest())).encode(), b"WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append(b"WARC-Target-URI: " + _uri(url).encode())
    head.append(b"WARC-Payload-Digest: sha1:" + base64.b32encode(digest.digest()))
    block = _HTTP % len(payload)
    if revisit:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: " + (_ID % (refers_to, digest.hexdigest())).encode(), b"WARC-Truncated: length"]
    else:
        block += payload
    head += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, HTTP block and end of the record at `at`."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record at {at}")
    head = dict(x.split(": ", 1) for x in lines[1:])
    start, size = end + 4, int(head["Content-Length"])
    return head, data[start : start + size], start + size + 4


def described(head: dict[str, str], block: bytes) -> tuple:
    """page_id, payload length, hex digest, type, refers_to and url of a record; a kept payload is checked against its digest."""
    number = lambda v: None if v == "None" else int(v)
    own = lambda v: number(v.removeprefix("<urn:tessera:page:").partition(":")[0])
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = head["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its record")
    return own(head["WARC-Record-ID"]), size, digest, kind, own(head["WARC-Refers-To"]) if kind == "revisit" else None, head.get("WARC-Target-URI")


class BundleWriter:
    """Appends records; a frame is closed when full, the seek table is written at the end."""

    def __init__(self, uri: str, level: int = 3):
        fs, path = located(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.uri, self.out, self.zip = uri, fs.open_output_stream(path, compression=None), zstandard.ZstdCompressor(level=level)
        self.frames, self.frame, self.filled, self.at, self.raw = [], [], 0, 0, 0

    def add(self, data: bytes) -> tuple[int, int, int]:
        """Frame number, the frame's place in the file and the record's offset in the frame."""
        if self.filled and self.filled + len(data) > FRAME_BYTES:
            self._flush()
        place = len(self.frames), self.at, self.filled
        self.frame.append(data)
        self.filled += len(data)
        self.raw += len(data)
        return place

    def _flush(self) -> None:
        if self.filled:
            packed = self.zip.compress(b"".join(self.frame))
            self.out.write(packed)
            self.frames.append((len(packed), self.filled))
            self.at += len(packed)
            self.frame, self.filled = [], 0

    def close(self) -> None:
        self._flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


def seek_table(f, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed, decompressed) of each frame, from the footer."""
    f.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    f.seek(size - 9 - 8 * n)
    raw, at, found = f.read(8 * n), 0, []
    for packed, plain in struct.iter_unpack("<II", raw):
        found.append((at, packed, plain))
        at += packed
    return found


def frames(uri: str):
    """Decompressed frames of a bundle, one at a time."""
    fs, path = located(uri)
    with fs.open_input_file(path) as f:
        unzip = zstandard.ZstdDecompressor()
        for at, packed, plain in seek_table(f, f.size()):
            f.seek(at)
            yield unzip.decompress(f.read(packed), max_output_size=plain)


def fetch(uri: str, frame: int, record_at: int) -> tuple:
    """One record by its index entry: reads the footer and a single frame."""
    fs, path = located(uri)
    with fs.open_input_file(path) as f:
        at, packed, plain = seek_table(f, f.size())[frame]
        f.seek(at)
        data = zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=plain)
    head, block, _ = parse(data, record_at)
    return described(head, block)


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, html, `first`: the page whose record holds the payload, null where the row keeps its own; and `told`:
    whether revisits refer to the row's own record.

    The largest page_id among equal payloads is found by a pre-aggregated group on digest and length; only groups of
    two rows or more are joined back, so a hot payload is one build row and its many rows are split by adaptive execution.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"))
    key = F.when(F.octet_length("html") >= REVISIT_BYTES, F.concat_ws(":", F.sha1("html"), F.octet_length("html").cast("string")))
    first = rows.select("page_id", key.alias("key")).where("key is not null").groupBy("key").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "first")
    spread = F.coalesce(key, F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))  # small payloads meet nothing and are dealt out
    joined = rows.withColumn("key", spread).join(first.hint("shuffle_hash"), "key", "left")
    other = F.col("first") != F.coalesce("page_id", F.lit(-(1 << 63)))
    return joined.select("page_id", "url", "html", F.when(other, F.col("first")).alias("first"), F.coalesce(~other, F.lit(False)).alias("told"))


def write_archives(spark: SparkSession, pages: DataFrame, folder: str | None = None, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, **cols) -> DataFrame:
    """Write a WARC record per row into bundles under `folder` and return the index table.

    A null html is an empty payload; each row has its own record identifier and index row, rows of equal page_id too; a
    revisit refers to the response with the largest page_id, of repeated rows to the first that a task meets. An empty table writes nothing. Bundles carry fresh names and
    count only through committed index rows, so a lost executor's half-written file is never read.
    """
    folder = folder or scratch(spark, "warc")

    def run(batches):
        writer, found, met = None, [], set()

        def closed():
            writer.close()
            return record_batch(_INDEX, [list(c) for c in zip(*found)])

        for b in slices(batches, "html"):
            for page, url, html, first, told in zip(*(b.column(i).to_pylist() for i in range(5))):
                if writer is None:
                    name = uuid.uuid4().hex
                    writer = BundleWriter(f"{folder}/{name}.warc.zst")
                payload = html.encode()
                key = (page, hashlib.sha1(payload).digest()) if told else None
                mark = None if told and key not in met else f"{name}.{len(found)}"
                met |= {key} if told else set()
                data = record(page, url, payload, first, first is not None, mark)
                found.append((writer.uri, page, *writer.add(data), len(data)))
                if writer.raw >= bundle_bytes:
                    yield closed()
                    writer, found = None, []
        if writer:
            yield closed()

    return stored(spark, plan_records(pages, **cols).mapInArrow(run, INDEX_SCHEMA), "warc-index")


def read_archives(spark: SparkSession, index: DataFrame) -> DataFrame:
    """Every record of the bundles that `index` names, decoded and checked frame by frame."""
    bundles = index.select("bundle").distinct()
    n = max(1, bundles.count())

    def run(batches):
        for b in batches:
            for uri in b.column(0).to_pylist():
                for data in frames(uri):
                    at, rows = 0, []
                    while at < len(data):
                        head, block, at = parse(data, at)
                        rows.append(described(head, block))
                    yield record_batch(_READ, [list(c) for c in zip(*rows)])

    return bundles.repartition(min(n, 20_000)).mapInArrow(run, READ_SCHEMA)
