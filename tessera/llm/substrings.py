"""Removal of word windows that already start in a document with a smaller id.

Documents are gathered into bounded blocks, written once to the shared folder; texts are never shuffled. Four small
exchanges follow:

1. each block sends a count-min sketch of its windows (one row of saturating counters, at least four times as many as the
   input has bytes, kept sparse: sorted cell numbers, split into shards by their top bits);
2. a shard adds up the sketches of all blocks and returns to each block which of its cells count two or more; a count is
   never too small, so no repeated window is lost;
3. a block looks up its windows again and sends those estimated repeated, one for each different window (that of its
   smallest document), under a 96-bit hash; a shard of hashes finds those that also start in a smaller document elsewhere;
4. the block marks these, and what repeats inside the block, and drops the covered words.

Where there are more shards than a block should be split into, steps 2 and 3 go through a tree: a block is split by the
shards' first bits only, pieces of several blocks are merged into chunks, in which a cell or window stands once, chunks are
split by the bits that remain, and answers go back the same way. Rows thus grow with the input and not with its square, and a
window in every document reaches a chunk once per block and a shard once per chunk at most, so that hot passages cannot pile
up in a task.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import covered, get, hashes_of, mixed, put, record_batch, rolling, scratch, slices, starts_of, stored, texts_of, words_of

WINDOW = 13
#: Text bytes of a block, which a task holds at once with its hashes, and of a shard's share of windows.
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 24 << 20
#: Bits by which a block, and a chunk, is split at most.
FAN_BITS = 12
#: A null id is larger than any other.
NO_ID = (1 << 63) - 1

_SECOND = 0xD6E8FEB86659FD93


class Split(NamedTuple):
    """Bits of a cell, bits that split a block, further bits that split a chunk, and chunks for each piece of a block."""

    cell: int
    first: int
    second: int
    lanes: int


def split_for(size: int, cell: int | None = None) -> Split:
    """How the windows of `size` text bytes are dealt out; `cell` narrows the sketch, which changes no result."""
    bits = max(4, (size // SHARD_BYTES).bit_length())
    first = bits if bits <= FAN_BITS else (bits + 1) // 2
    return Split(cell or max(36, size.bit_length() + 2), first, bits - first, max(1, -(-(size >> first) // SHARD_BYTES)))


def packed(*arrays: np.ndarray) -> bytes:
    """Equally long arrays, byte plane by byte plane, compressed."""
    n = len(arrays[0]) if arrays else 0
    planes = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(n, a.itemsize).T).tobytes() for a in arrays) if n else b""
    return n.to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(planes)


def unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return [np.zeros(0, k) for k in kinds]
    planes, at, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[8:]), np.uint8), 0, []
    for k in kinds:
        size = np.dtype(k).itemsize
        out.append(np.ascontiguousarray(planes[at : at + n * size].reshape(size, n).T).view(k).ravel())
        at += n * size
    return out


class Windows:
    """Hashes of all windows of a block of rows, in reading order."""

    def __init__(self, rows: pa.Table, text_col: str, id_col: str, k: int, second: bool):
        ids = pc.fill_null(rows.column(id_col).cast(pa.int64()), NO_ID).to_numpy()
        first, other, doc, self.starts, base, at = [], [], [], [], 0, 0
        self.parts = []  # (first row, codes, dictionary, offsets, first word)
        for b in slices(rows.to_batches(), text_col):
            codes, words, offsets = words_of(texts_of(b, text_col))
            start = starts_of(offsets, k)
            hashes = hashes_of(words)
            first.append(rolling(hashes[codes], k)[start])
            if second:
                other.append(rolling(mixed(hashes ^ np.uint64(_SECOND))[codes], k, _SECOND)[start].astype(np.uint32))
            doc.append(at + np.searchsorted(offsets, start, side="right") - 1)
            self.starts.append(start + base)
            self.parts.append((at, codes, words, offsets, base))
            at, base = at + b.num_rows, base + int(offsets[-1])
        join = lambda x, t: np.concatenate(x).astype(t, copy=False) if x else np.zeros(0, t)
        self.n_words, self.h1, self.h2, self.starts = base, join(first, np.uint64), join(other, np.uint32), join(self.starts, np.int64)
        self.row = join(doc, np.int64)
        self.doc = ids[self.row] if len(self.row) else np.zeros(0, np.int64)

    def cells(self, split: Split) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct sketch cells in order, whether each counts twice here, and where each piece begins."""
        cell = np.sort(self.h1 >> np.uint64(64 - split.cell))
        new = np.ones(len(cell), bool)
        new[1:] = cell[1:] != cell[:-1]
        at = np.flatnonzero(new)
        twice = np.diff(np.append(at, len(cell))) > 1
        cell = cell[at]
        edges = np.searchsorted(cell, np.arange((1 << split.first) + 1, dtype=np.uint64) << np.uint64(split.cell - split.first))
        return cell, twice, edges

    def repeated(self) -> np.ndarray:
        """Windows whose first hash occurs again in the block."""
        order = np.argsort(self.h1)
        same = self.h1[order[1:]] == self.h1[order[:-1]]
        again = np.zeros(len(order), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        return np.flatnonzero(again)

    def groups(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows `w` in order of (hash, id, place), where each different one begins in that order, and its smallest id."""
        w = w[np.lexsort((self.doc[w], self.h2[w], self.h1[w]))]
        new = np.ones(len(w), bool)
        new[1:] = (self.h1[w][1:] != self.h1[w][:-1]) | (self.h2[w][1:] != self.h2[w][:-1])
        begin = np.flatnonzero(new)
        return w, begin, self.doc[w[begin]]


def _apart(df: DataFrame, n: int, key: str) -> DataFrame:
    """Rows dealt out by a key of n values; three partitions a value keep most values from sharing one."""
    return df.repartition(min(20_000, 3 * n), key)


def _load(uri: str) -> pa.Table:
    return pq.read_table(pa.BufferReader(get(uri)))


def _write(uri: str, rows: pa.Table) -> None:
    out = io.BytesIO()
    pq.write_table(rows, out, compression="zstd", use_dictionary=False)
    put(uri, out.getbuffer())


def _sketches(cell: np.ndarray, twice: np.ndarray, edges: np.ndarray, bits: int) -> tuple[np.ndarray, list[bytes]]:
    """The pieces that hold cells, and each one's cells by their last `bits` with the mark of those that count twice."""
    low = ((cell & np.uint64((1 << bits) - 1)) << np.uint64(1)) | twice.astype(np.uint64)
    pieces = np.flatnonzero(np.diff(edges))
    return pieces, [packed(np.diff(low[edges[p] : edges[p + 1]], prepend=np.uint64(0)).astype(np.uint64)) for p in pieces]


def _counted(sketches: pa.ChunkedArray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The cells of each sketch; all different ones in order, and whether the sketches together count each twice or more."""
    cells, many = [], []
    for s in sketches:
        low = np.cumsum(unpacked(s.as_py(), "<u8")[0])
        cells.append(low >> np.uint64(1))
        many.append(cells[-1][(low & np.uint64(1)) > 0])
    every = np.sort(np.concatenate([*cells, *many, np.zeros(0, np.uint64)]))
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    at = np.flatnonzero(new)
    return cells, every[at], np.diff(np.append(at, len(every))) > 1


def _among(again: np.ndarray, cells: np.ndarray) -> bytes:
    """A bit for each of `cells`: whether it is in the sorted `again`."""
    if not len(again):
        return np.packbits(np.zeros(len(cells), bool)).tobytes()
    i = np.searchsorted(again, cells)
    i[i == len(again)] = 0
    return np.packbits(again[i] == cells).tobytes()


def _blocks(spark: SparkSession, docs: DataFrame, folder: str, split: Split, k: int, id_col: str, text_col: str) -> DataFrame:
    """Write the block files; rows (block, shard, sketch), and one of shard -1 for each block."""
    out = pa.schema([("block", pa.string()), ("shard", pa.int32()), ("sketch", pa.binary())])

    def run(batches):
        held, size = [], 0

        def written():
            nonlocal held, size
            rows, block = pa.Table.from_batches(held), uuid.uuid4().hex
            held, size = [], 0
            _write(f"{folder}/{block}.parquet", rows)
            cell, twice, edges = Windows(rows, text_col, id_col, k, False).cells(split)
            shards, blobs = _sketches(cell, twice, edges, split.cell - split.first)
            return record_batch(out, [[block] * (len(shards) + 1), [-1, *shards.tolist()], [b"", *blobs]])

        for b in slices(batches, text_col):
            held.append(b)
            size += pc.sum(pc.binary_length(texts_of(b, text_col))).as_py() or 0
            if size >= BLOCK_BYTES:
                yield written()
        if held:
            yield written()

    return stored(spark, docs.mapInArrow(run, "block string, shard int, sketch binary"), "sketches")


def _repeated(sketches: DataFrame, shards: int) -> DataFrame:
    """For each block and shard, a bit per cell of the block: whether all sketches together count it twice or more."""
    out = pa.schema([("block", pa.string()), ("shard", pa.int32()), ("bits", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        cells, every, twice = _counted(table.column("sketch"))
        again = every[twice]
        del every, twice
        bits = [_among(again, c) for c in cells]
        return pa.table([table.column("block").combine_chunks(), table.column("shard").combine_chunks(), pa.array(bits, pa.binary())], schema=out)

    return _apart(sketches.where("shard >= 0"), shards, "shard").groupBy("shard").applyInArrow(run, "block string, shard int, bits binary")


def _lanes(df: DataFrame, split: Split) -> DataFrame:
    """Rows of (block, shard) with the chunk that they belong to: the shard's pieces of some blocks, dealt out by block."""
    chunk = F.concat_ws("-", F.col("shard").cast("string"), F.pmod(F.xxhash64("block"), F.lit(split.lanes)).cast("string"))
    return _apart(df.withColumn("chunk", chunk), split.lanes << split.first, "chunk")


def _answered(df: DataFrame, split: Split) -> DataFrame:
    """Answers to chunks, under the chunk's name."""
    return _apart(df.withColumnRenamed("block", "chunk"), split.lanes << split.first, "chunk")


def _repeated_by_chunks(pieces: DataFrame, split: Split) -> DataFrame:
    """What `_repeated` gives for pieces (block, shard, sketch), by chunks that are split once more."""
    rest = split.cell - split.first - split.second
    edges_of = lambda cell: np.searchsorted(cell, np.arange((1 << split.second) + 1, dtype=np.uint64) << np.uint64(rest))

    def merged(table: pa.Table) -> pa.Table:
        _, cell, twice = _counted(table.column("sketch"))
        fine, blobs = _sketches(cell, twice, edges_of(cell), rest)
        piece = table.column("shard")[0].as_py()
        return pa.table({"block": pa.array([table.column("chunk")[0].as_py()] * len(fine), pa.string()), "shard": pa.array((piece << split.second) | fine, pa.int32()), "sketch": pa.array(blobs, pa.binary())})

    def back(table: pa.Table, answers: pa.Table) -> pa.Table:
        cells, cell, _ = _counted(table.column("sketch"))
        edges, again = edges_of(cell), np.zeros(len(cell), bool)
        for shard, b in zip(answers.column("shard").to_pylist(), answers.column("bits")):
            lo, hi = edges[shard & ((1 << split.second) - 1) :][:2]
            again[lo:hi] = np.unpackbits(np.frombuffer(b.as_py(), np.uint8), count=hi - lo).astype(bool)
        return pa.table({"block": table.column("block").combine_chunks(), "shard": table.column("shard").combine_chunks(), "bits": pa.array([_among(cell[again], c) for c in cells], pa.binary())})

    pieces = _lanes(pieces.where("shard >= 0"), split)
    merges = pieces.groupBy("chunk").applyInArrow(merged, "block string, shard int, sketch binary")
    answers = _answered(_repeated(merges, 1 << split.first + split.second), split)
    return pieces.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(back, "block string, shard int, bits binary")


def _candidates(bits: DataFrame, folder: str, blocks: int, split: Split, k: int, id_col: str, text_col: str) -> DataFrame:
    """(shard, block, windows): each different window that is estimated repeated, with its hashes, smallest id and place."""
    out = pa.schema([("shard", pa.int32()), ("block", pa.string()), ("windows", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        w = Windows(_load(f"{folder}/{block}.parquet"), text_col, id_col, k, True)
        cell, _, edges = w.cells(split)
        again = np.zeros(len(cell), bool)
        for shard, b in zip(table.column("shard").to_pylist(), table.column("bits")):
            lo, hi = edges[shard], edges[shard + 1]
            again[lo:hi] = np.unpackbits(np.frombuffer(b.as_py(), np.uint8), count=hi - lo).astype(bool)
        cell = cell[again]
        own = w.h1 >> np.uint64(64 - split.cell)
        i = np.searchsorted(cell, own)
        i[i == len(cell)] = 0
        order, begin, _ = w.groups(np.flatnonzero(cell[i] == own) if len(cell) else np.zeros(0, np.int64))
        first = order[begin]
        shards, blobs = _dealt(w.h1[first], w.h2[first], w.doc[first], first, split.first)
        return pa.table([pa.array(shards, pa.int32()), pa.array([block] * len(shards), pa.string()), pa.array(blobs, pa.binary())], schema=out)

    return _apart(bits, blocks, "block").groupBy("block").applyInArrow(run, "shard int, block string, windows binary")


def _dealt(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, place: np.ndarray, bits: int) -> tuple[np.ndarray, list[bytes]]:
    """The pieces, by the first `bits` of the sorted `h1`, that hold windows, and each one's windows."""
    edge = np.searchsorted(h1 >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    pieces = np.flatnonzero(np.diff(edge))
    parts = (slice(edge[p], edge[p + 1]) for p in pieces)
    return pieces, [packed(np.diff(h1[s], prepend=np.uint64(0)), h2[s], doc[s], place[s].astype(np.uint32)) for s in parts]


def _gathered(windows: pa.ChunkedArray) -> tuple[np.ndarray, ...]:
    """All windows in order of (hash, id): source row, place there, hashes, id; and where each different one begins."""
    parts = [unpacked(x.as_py(), "<u8", "<u4", "<i8", "<u4") for x in windows]
    source = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p[0]) for p in parts])
    h1 = np.concatenate([np.cumsum(p[0]) for p in parts])
    h2, doc, place = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
    del parts
    order = np.lexsort((doc, h2, h1))
    source, place, h1, h2, doc = (x[order] for x in (source, place, h1, h2, doc))
    new = np.ones(len(order), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    return source, place, h1, h2, doc, np.flatnonzero(new)


def _marked(blocks: pa.ChunkedArray, source: np.ndarray, place: np.ndarray) -> pa.Table:
    """(block, marks) of the places hit in each source row; rows without a hit are left out."""
    by = np.lexsort((place, source))
    source, place = source[by], place[by]
    edge = np.searchsorted(source, np.arange(len(blocks) + 1))
    names, rows = blocks.to_pylist(), np.flatnonzero(np.diff(edge))
    return pa.table([pa.array([names[r] for r in rows], pa.string()), pa.array([packed(np.diff(place[edge[r] : edge[r + 1]], prepend=np.uint32(0))) for r in rows], pa.binary())], names=["block", "marks"])


def _elsewhere_by_chunks(candidates: DataFrame, split: Split) -> DataFrame:
    """What `_elsewhere` gives, by chunks that send each different window once, with its smallest id."""

    def merged(table: pa.Table) -> pa.Table:
        _, _, h1, h2, doc, begin = _gathered(table.column("windows"))
        shards, blobs = _dealt(h1[begin], h2[begin], doc[begin], np.arange(len(begin)), split.first + split.second)
        return pa.table({"shard": pa.array(shards, pa.int32()), "block": pa.array([table.column("chunk")[0].as_py()] * len(shards), pa.string()), "windows": pa.array(blobs, pa.binary())})

    def back(table: pa.Table, answers: pa.Table) -> pa.Table:
        source, place, _, _, doc, begin = _gathered(table.column("windows"))
        smaller = np.zeros(len(begin), bool)
        for m in answers.column("marks"):
            smaller[np.cumsum(unpacked(m.as_py(), "<u4")[0])] = True
        size = np.diff(np.append(begin, len(doc)))
        hit = np.repeat(smaller, size) | (doc > np.repeat(doc[begin], size))
        return _marked(table.column("block"), source[hit], place[hit])

    rows = _lanes(candidates, split)
    merges = rows.groupBy("chunk").applyInArrow(merged, "shard int, block string, windows binary")
    answers = _answered(_elsewhere(merges, 1 << split.first + split.second), split)
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(back, "block string, marks binary")


def _elsewhere(candidates: DataFrame, shards: int) -> DataFrame:
    """(block, marks): windows of the block that also start in a document with a smaller id in another block."""

    def run(table: pa.Table) -> pa.Table:
        source, place, _, _, doc, begin = _gathered(table.column("windows"))
        hit = doc > np.repeat(doc[begin], np.diff(np.append(begin, len(doc))))
        return _marked(table.column("block"), source[hit], place[hit])

    return _apart(candidates, shards, "shard").groupBy("shard").applyInArrow(run, "block string, marks binary")


def _apply(spark: SparkSession, docs: DataFrame, k: int, id_col: str, text_col: str, schema: T.StructType, finish) -> DataFrame:
    """Run the exchanges; `finish(rows, kept texts, words, removed words)` makes the output of each block part."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    split = split_for(size)
    folder = scratch(spark, "blocks")
    sketches = _blocks(spark, docs, folder, split, k, id_col, text_col)
    names = sketches.where("shard = -1").select("block", F.lit(None).cast("binary").alias("marks"))
    blocks = max(1, names.count())
    bits = _repeated_by_chunks(sketches, split) if split.second else _repeated(sketches, 1 << split.first)
    found = _candidates(bits, folder, blocks, split, k, id_col, text_col)
    marks = _elsewhere_by_chunks(stored(spark, found, "windows"), split) if split.second else _elsewhere(found, 1 << split.first)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _load(f"{folder}/{key[0].as_py()}.parquet")
        w = Windows(rows, text_col, id_col, k, True)
        hit = np.zeros(len(w.h1), bool)
        for b in batches:
            for m in b.column(b.schema.get_field_index("marks")):
                if m.is_valid:
                    hit[np.cumsum(unpacked(m.as_py(), "<u4")[0])] = True
        order, begin, least = w.groups(w.repeated())
        if len(order):
            size = np.diff(np.append(begin, len(order)))
            hit[order] = np.repeat(np.logical_or.reduceat(hit[order], begin), size) | (w.doc[order] > np.repeat(least, size))
        gone = covered(w.starts[hit], k, w.n_words)
        for at, codes, words, offsets, base in w.parts:
            out = gone[base : base + len(codes)]
            stay = np.concatenate([[0], np.cumsum(~out)])[offsets]
            kept = pa.ListArray.from_arrays(pa.array(stay.astype(np.int32)), words.take(pa.array(codes[~out])))
            n = np.diff(offsets)
            yield finish(rows.slice(at, len(n)), pc.binary_join(kept, " "), n, n - np.diff(stay))

    return _apart(marks.unionByName(names), blocks, "block").groupBy("block").applyInArrow(run, schema)


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def digests(spark: SparkSession, docs: DataFrame, k: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words joined by single spaces, of every row.

    A null or empty text has no words and keeps the empty string. A null doc_id counts as larger than any other; rows
    that share a doc_id do not remove each other's words; texts under `k` words lose nothing. An empty table gives none.
    """

    def finish(rows, kept, n, removed):
        return record_batch(_DIGEST, [rows.column("doc_id").combine_chunks().cast(pa.int64()), n, removed, [hashlib.sha256(t.encode()).hexdigest() for t in kept.to_pylist()]])

    schema = T._parse_datatype_string("doc_id long, n_words long, n_removed long, kept_sha256 string")
    return _apply(spark, docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), k, "doc_id", "text", schema, finish)


def trimmed(spark: SparkSession, docs: DataFrame, k: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """All columns of every row, its text without the removed words; a text that loses none stays as it is.

    Rows whose every word goes are dropped. `chars_col`, where present, follows the new text.
    """
    names = docs.columns

    def finish(rows, kept, n, removed):
        texts = rows.column(text_col).combine_chunks()
        changed = pa.array(removed > 0)
        columns = {c: rows.column(c).combine_chunks() for c in names}
        columns[text_col] = pc.if_else(changed, kept, texts)
        if chars_col in columns:
            columns[chars_col] = pc.if_else(changed, pc.utf8_length(kept).cast(columns[chars_col].type), columns[chars_col])
        return pa.RecordBatch.from_arrays(list(columns.values()), names=names).filter(pa.array((removed == 0) | (removed < n)))

    return _apply(spark, docs, k, id_col, text_col, docs.schema, finish)
