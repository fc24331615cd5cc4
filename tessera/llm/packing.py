"""Bounded-space online packing of documents into fixed-length sequences.

Each task keeps a fixed number of open windows. A document is cut into full sequences and a rest; the rest goes to the
open window that it fills best, or, where it fits none, to a new window, for which the fullest window is emitted if all
are in use. Windows still open at the end carry their ids to a second step, which merges those of eight tasks: they are
laid end to end and cut where a sequence is full, so that a group leaves one partly filled sequence.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bytebpe import document_ids
from tessera.llm.common import record_batch, slices, stored, texts_of

CAPACITY = 1024
OPEN_WINDOWS = 256
#: Tasks whose leftovers are merged together; times OPEN_WINDOWS sequences at most.
MERGED_TASKS = 8
_MERGED = 1 << 62

_PIECES = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
_OUT = pa.schema(_PIECES)
_OPEN = pa.schema([*_PIECES, ("leftover", pa.int64()), ("ids", pa.binary())])
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
OPEN_SCHEMA = PIECE_SCHEMA + ", leftover long, ids binary"


def little_endian(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


class Packer:
    """Open windows, kept in order of free room. A window is [free, sequence number, pieces]."""

    def __init__(self, capacity: int, windows: int, first_sequence: int):
        self.capacity, self.windows, self.next = capacity, windows, first_sequence
        self.open: list[list] = []
        self.done: list[tuple] = []

    def _close(self, window: list) -> None:
        self.done += [(*p[:3], zlib.crc32(p[5]), p[3], window[1], p[4], None, None) for p in window[2]]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.capacity:
            raw = little_endian(ids[start : start + self.capacity])
            self.done.append((doc_id, start, self.capacity, zlib.crc32(raw), total, self.next, 0, None, None))
            self.next += 1
            start += self.capacity
        rest = total - start
        if not rest:
            return
        at = bisect_left(self.open, [rest])
        if at < len(self.open):
            window = self.open.pop(at)
        else:
            if len(self.open) == self.windows:
                self._close(self.open.pop(0))
            window = [self.capacity, self.next, []]
            self.next += 1
        window[2].append((doc_id, start, rest, total, self.capacity - window[0], little_endian(ids[start:])))
        window[0] -= rest
        if window[0]:
            insort(self.open, window)
        else:
            self._close(window)

    def taken(self) -> list[tuple]:
        out, self.done = self.done, []
        return out

    def leftovers(self, group: int) -> list[tuple]:
        return [(*p[:3], 0, p[3], w[1], p[4], group, p[5]) for w in self.open for p in w[2]]


def merged(rows: list[dict], group: int, capacity: int) -> list[tuple]:
    """Leftover windows laid end to end, the fullest first, cut only where a sequence ends."""
    fill: dict[int, int] = {}
    for r in rows:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    rows = sorted(rows, key=lambda r: (-fill[r["sequence_id"]], r["sequence_id"], r["offset"]))
    out, sequence, used = [], _MERGED + (group << 32), 0
    for r in rows:
        at = 0
        while at < r["length"]:
            n = min(r["length"] - at, capacity - used)
            out.append((r["doc_id"], r["start"] + at, n, zlib.crc32(r["ids"][4 * at : 4 * (at + n)]), r["doc_tokens"], sequence, used))
            at, used = at + n, used + n
            if used == capacity:
                sequence, used = sequence + 1, 0
    return out


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, windows: int = OPEN_WINDOWS, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every row lies in one piece; a null or empty text is its end id alone; rows that share a doc_id are
    packed apart; a null doc_id stays null; an empty table gives no rows. The only shuffle carries the leftovers, at most
    `windows` sequences a task. The first step is written once, so a lost executor cannot mix two packings.
    """

    def run(batches):
        task = TaskContext.get().partitionId()
        packer = Packer(capacity, windows, task << 32)
        for b in slices(batches, text_col):
            for doc, text in zip(b.column(0).to_pylist(), texts_of(b, text_col).to_pylist()):
                packer.add(doc, document_ids(text, tokenizer, end))
            if rows := packer.taken():
                yield record_batch(_OPEN, [list(c) for c in zip(*rows)])
        if rows := packer.taken() + packer.leftovers(task // MERGED_TASKS):
            yield record_batch(_OPEN, [list(c) for c in zip(*rows)])

    def merge(table: pa.Table) -> pa.Table:
        group = table.column("leftover")[0].as_py()
        rows = merged(table.to_pylist(), group, capacity)
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)], schema=_OUT)

    first = stored(spark, docs.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(run, OPEN_SCHEMA), "packed")
    rest = first.where("leftover is not null").groupBy("leftover").applyInArrow(merge, PIECE_SCHEMA)
    return first.where("leftover is null").drop("leftover", "ids").unionByName(rest)
