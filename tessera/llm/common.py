"""Shared pieces of the training-data operators: shared storage, Arrow slicing, words and hashes.

Conventions that hold for every operator of the package:

* a null text counts as an empty text; a null id is carried through;
* inputs may carry further columns of any name: operators read only the columns named in their signature, and the
  row-preserving forms return every input column unchanged;
* intermediate tables and files go to the folder named by ``spark.checkpoint.dir``, which all executors share, under a
  fresh name for each call. Files become visible through rows that Spark committed, so a repeated task only leaves an
  orphan that nothing refers to.
"""

from __future__ import annotations

import atexit
import contextlib
import io
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes that one vectorised step works on at once; a longer single text is a step of its own.
SLICE_BYTES = 2 << 20
#: Text bytes and rows of a block file, which a task holds at once.
BLOCK_BYTES = 8 << 20
BLOCK_ROWS = 1 << 16

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Lower-cases A-Z and turns every ASCII character that is no letter or digit into a space.
ALNUM = bytes(LOWER[c] if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


@lru_cache(maxsize=1)
def _own_dir() -> str:
    found = tempfile.mkdtemp(prefix="tessera-")
    atexit.register(shutil.rmtree, found, True)
    return found


#: Hadoop's schemes of stores that Arrow opens under another name.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}
_OPENED = ("file", "hdfs", "viewfs", "s3", "gs", "abfs", "abfss")


def shared_dir(spark: SparkSession) -> str:
    """Whole URI of the shared folder, with scheme and host as Hadoop completes them.

    It is the folder in `spark.checkpoint.dir`, else that of the context's `setCheckpointDir`. Only a session on a single
    machine that names neither gets a temporary one; on a cluster that is an error.
    """
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = _own_dir()
    path = jvm.org.apache.hadoop.fs.Path(named)
    with contextlib.suppress(Exception):  # a scheme that this Hadoop lacks is judged by `located`
        path = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path)
    whole = str(path.toString()).rstrip("/")
    located_uri(whole)
    return whole


def located_uri(uri: str) -> str:
    """The URI as Arrow opens it; an error for a store that it cannot open, rather than a local folder of that name."""
    scheme, _, rest = uri.partition(":")
    scheme = SCHEMES.get(scheme, scheme)
    if not rest or scheme not in _OPENED:
        raise ValueError(f"tasks cannot open files under {uri}; name a folder under one of {', '.join(_OPENED)} or {', '.join(SCHEMES)}")
    return f"{scheme}:{rest if rest.startswith('//') else '//' + rest}"


_MADE: list[str] = []


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder; what is there when the driver ends is removed."""
    _MADE.append(f"{shared_dir(spark)}/tessera-{label}-{uuid.uuid4().hex}")
    return _MADE[-1]


@atexit.register
def sweep() -> None:
    """Remove the intermediate folders of this driver. Results that still read them must be written before."""
    while _MADE:
        with contextlib.suppress(OSError, ValueError, NotImplementedError):
            fs, path = located(_MADE.pop())
            fs.delete_dir(path)


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: evaluated once, no lineage behind it."""
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def located(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(located_uri(uri))


def put(uri: str, data) -> None:
    """Write one whole file. Names are never reused, so readers never see a half-written one."""
    fs, path = located(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path, compression=None) as out:
        out.write(data)


def get(uri: str) -> pa.Buffer:
    fs, path = located(uri)
    with fs.open_input_file(path) as f:
        return f.read_buffer()


def put_table(uri: str, rows: pa.Table) -> None:
    out = io.BytesIO()
    pq.write_table(rows, out, compression="zstd", use_dictionary=False)
    put(uri, out.getbuffer())


def get_table(uri: str) -> pa.Table:
    return pq.read_table(pa.BufferReader(get(uri)))


def block_tables(batches: Iterable[pa.RecordBatch], text_col: str, limit: int | None = None) -> Iterator[pa.Table]:
    """The same rows in tables of about `limit` text bytes, and BLOCK_ROWS rows at most."""
    held, size, rows = [], 0, 0
    for s in slices(batches, text_col):
        for lo in range(0, s.num_rows, BLOCK_ROWS):
            b = s.slice(lo, BLOCK_ROWS)
            if held and rows + b.num_rows > BLOCK_ROWS:
                yield pa.Table.from_batches(held)
                held, size, rows = [], 0, 0
            held.append(b)
            size, rows = size + int(sizes_of(texts_of(b, text_col)).sum()), rows + b.num_rows
            if size >= (limit or BLOCK_BYTES):
                yield pa.Table.from_batches(held)
                held, size, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def in_blocks(spark: SparkSession, docs: DataFrame, folder: str, text_col: str, id_col: str, names: list[str], longs: Callable) -> DataFrame:
    """Write the rows to block files; (block, at, id, and the long columns that `longs` makes of a batch) of every row."""
    out = pa.schema([("block", pa.string()), ("at", pa.int32()), ("id", pa.int64()), *((n, pa.int64()) for n in names)])

    def run(batches):
        for rows in block_tables(batches, text_col):
            block, at = uuid.uuid4().hex, 0
            put_table(f"{folder}/{block}.parquet", rows)
            for b in slices(rows.to_batches(), text_col):
                ids = b.column(b.schema.get_field_index(id_col)).cast(pa.int64())
                yield record_batch(out, [[block] * b.num_rows, np.arange(at, at + b.num_rows, dtype=np.int32), ids, *longs(b)])
                at += b.num_rows

    return stored(spark, docs.mapInArrow(run, ", ".join(["block string, at int, id long", *(f"{n} long" for n in names)])), "rows")


def from_blocks(rows: DataFrame, keep: DataFrame, folder: str, schema: T.StructType) -> DataFrame:
    """The rows of block files at the places (block, at) of `keep`; `rows` are all places. Only places are shuffled."""
    blocks = max(1, rows.select("block").distinct().count())
    names = schema.names

    def run(batches):
        for b in batches:
            for block, at in zip(b.column(0).to_pylist(), b.column(1)):
                kept = get_table(f"{folder}/{block}.parquet").take(pa.array(np.sort(at.values.to_numpy())))
                yield from kept.select(names).combine_chunks().to_batches()

    places = keep.groupBy("block").agg(F.collect_list("at").alias("at"))
    return places.repartition(min(20_000, 3 * blocks), "block").mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    a = batch.column(batch.schema.get_field_index(column))
    if not pa.types.is_string(a.type):
        a = a.cast(pa.string())
    return pc.fill_null(a, "")


def sizes_of(texts: pa.Array) -> np.ndarray:
    return pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` text bytes, at least a row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(sizes_of(texts_of(batch, column)))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def words_of(texts: pa.Array, table: bytes | None = None) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words between ASCII white space, after an optional byte-for-byte translation that leaves bytes over 127 alone.

    Returns word codes of all texts, the dictionary they point to, and where each text starts among them.
    """
    if len(texts) == 0:
        return np.zeros(0, np.int32), pa.array([], pa.string()), np.zeros(1, np.int64)
    if table is not None:
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        raw = memoryview(data)[at[0] : at[-1]] if data is not None else b""
        texts = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer((at - at[0]).astype(np.int32)), pa.py_buffer(bytes(raw).translate(table))])
    lists = pc.ascii_split_whitespace(texts)
    ends = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    ends = ends - ends[0]
    mask = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(mask.to_numpy(zero_copy_only=False))]).astype(np.int64)
    coded = flat.filter(mask).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, kept[ends]


def hashes_of(words: pa.Array) -> np.ndarray:
    """XXH64 of each word."""
    _, offsets, data = words.buffers()
    if not len(words):
        return np.zeros(0, np.uint64)
    at = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].tolist()
    raw, h = bytes(data), xxhash.xxh64_intdigest
    return np.fromiter([h(raw[i:j]) for i, j in zip(at, at[1:])], np.uint64, len(words))


def _inverse(m: int) -> int:
    return pow(m, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def rolling(word_hashes: np.ndarray, k: int, multiplier: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every run of k consecutive words: a polynomial modulo 2**64 by prefix sums, then mixed.

    Runs across text borders are included; callers mask them.
    """
    n = len(word_hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        up = np.full(n, multiplier, np.uint64)
        up[0] = 1
        np.multiply.accumulate(up, out=up)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(up * word_hashes, dtype=np.uint64)])
        down = np.full(n - k + 1, _inverse(multiplier), np.uint64)
        down[0] = 1
        np.multiply.accumulate(down, out=down)
        return mixed((sums[k:] - sums[:-k]) * down)


def starts_of(offsets: np.ndarray, k: int) -> np.ndarray:
    """Positions at which k words of one text begin."""
    n = int(offsets[-1])
    if n < k:
        return np.zeros(0, np.int64)
    ok = np.zeros(n + 1, np.int32)
    lengths = np.diff(offsets)
    whole = lengths >= k
    np.add.at(ok, offsets[:-1][whole], 1)
    np.add.at(ok, offsets[1:][whole] - k + 1, -1)
    return np.flatnonzero(np.cumsum(ok[:-1]) > 0)


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of n words lie in a run of k that begins at one of `starts`."""
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + k, -1)
    return np.cumsum(mark[:-1]) > 0


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
