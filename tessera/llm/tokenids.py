"""Token-id matrices in binary files: best-fit-decreasing packing with a segment tree over free capacities.

A block of documents is packed at once. Documents longer than a sequence are split into full sequences and a rest,
losing nothing; pieces go longest first to the fullest sequence with room, found by one descent in a segment tree
whose leaves are the free capacities 0 to `capacity`. A block becomes one .npz file: the id matrix (rows padded with the
end id), cumulative segment lengths of each row, and a bit mask of the places at which positions restart from 0.
"""

from __future__ import annotations

import io
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bytebpe import document_ids
from tessera.llm.common import get, put, record_batch, scratch, slices, stored, texts_of
from tessera.llm.packing import little_endian

CAPACITY = 1024
#: Tokens that a task holds and packs at once.
BLOCK_TOKENS = 2 << 20

_FILES = pa.schema([("path", pa.string()), ("first_sequence", pa.int64()), ("n_sequences", pa.int64()), ("n_tokens", pa.int64())])
FILE_SCHEMA = "path string, first_sequence long, n_sequences long, n_tokens long"
_SEGMENTS = pa.schema([("sequence_id", pa.int64()), ("segment", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("offset", pa.int32()), ("doc_tokens", pa.int64()), ("ids_crc32", pa.int64())])
SEGMENT_SCHEMA = "sequence_id long, segment int, doc_id long, start long, length int, offset int, doc_tokens long, ids_crc32 long"


class Room:
    """A segment tree over free capacities; a node tells whether some open sequence below it has that much room."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves <= capacity:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, free: int, sequence: int) -> None:
        self.at[free].append(sequence)
        node = self.leaves + free
        while node:
            self.count[node] += 1
            node //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """(free, sequence) of least free capacity of at least `need`, removed from the tree."""
        node = self.leaves + need
        if not self.count[node]:
            while node > 1 and (node % 2 or not self.count[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        free, up = node - self.leaves, node
        while up:
            self.count[up] -= 1
            up //= 2
        return free, self.at[free].pop()


def fit(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length); documents given by their lengths."""
    full, rests = [], []
    for doc, n in enumerate(lengths):
        cut = n - n % capacity
        full += [[(doc, s, capacity)] for s in range(0, cut, capacity)]
        if n > cut:
            rests.append((n - cut, doc, cut))
    bins: list[list[tuple[int, int, int]]] = []
    room = Room(capacity)
    for n, doc, start in sorted(rests, key=lambda r: (-r[0], r[1])):
        found = room.take(n)
        if found is None:
            found = capacity, len(bins)
            bins.append([])
        free, b = found
        bins[b].append((doc, start, n))
        if free > n:
            room.put(free - n, b)
    return full + bins


def block(docs: list[tuple[int | None, np.ndarray]], capacity: int, pad: int) -> dict[str, np.ndarray]:
    """Arrays of one packed block."""
    rows = fit([len(i) for _, i in docs], capacity)
    ids = np.full((len(rows), capacity), pad, np.uint32)
    resets = np.zeros((len(rows), capacity), bool)
    cumulative, ends, owner, starts, totals = [], [], [], [], []
    for r, segments in enumerate(rows):
        at = 0
        cumulative.append(0)
        for doc, start, n in segments:
            ids[r, at : at + n] = docs[doc][1][start : start + n]
            resets[r, at] = True
            at += n
            cumulative.append(at)
            owner.append(doc)
            starts.append(start)
            totals.append(len(docs[doc][1]))
        if at < capacity:
            resets[r, at] = True  # the padding is a segment of its own
        ends.append(len(cumulative))
    known = [docs[o][0] is not None for o in owner]
    return {
        "ids": ids.astype("<u2") if ids.max(initial=0) < 1 << 16 else ids.astype("<u4"),
        "cumulative_lengths": np.array(cumulative, "<i4"), "row_ends": np.array(ends, "<i8"), "position_resets": np.packbits(resets, axis=1),
        "doc_ids": np.array([docs[o][0] if k else 0 for o, k in zip(owner, known)], "<i8"), "doc_known": np.array(known, bool), "starts": np.array(starts, "<i8"), "doc_tokens": np.array(totals, "<i8"),
    }


def position_ids(resets: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Positions of each row, counted from the last reset."""
    marks = np.unpackbits(resets, axis=1, count=capacity).astype(bool)
    here = np.arange(capacity)
    return here - np.maximum.accumulate(np.where(marks, here, 0), axis=1)


def write_matrices(spark: SparkSession, docs: DataFrame, tokenizer: str, folder: str | None = None, capacity: int = CAPACITY, end: int = 50256, block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, pack and write every document; returns the table of files.

    A null or empty text is its end id alone; repeated rows and rows that share a doc_id are packed apart; a null doc_id
    is kept as unknown; an empty table writes nothing. No shuffle: a block never leaves its task.
    """
    folder = folder or scratch(spark, "token-ids")

    def run(batches):
        sequence = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def written():
            nonlocal sequence, held, size
            arrays = block(held, capacity, end)
            data, path = io.BytesIO(), f"{folder}/{uuid.uuid4().hex}.npz"
            np.savez(data, **arrays)
            put(path, data.getbuffer())
            n = len(arrays["row_ends"])
            row = record_batch(_FILES, [[path], [sequence], [n], [size]])
            sequence, held, size = sequence + n, [], 0
            return row

        for b in slices(batches, text_col):
            for doc, text in zip(b.column(0).to_pylist(), texts_of(b, text_col).to_pylist()):
                ids = document_ids(text, tokenizer, end)
                held.append((doc, ids))
                size += len(ids)
                if size >= block_tokens:
                    yield written()
        if held:
            yield written()

    return stored(spark, docs.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(run, FILE_SCHEMA), "token-files")


def read_segments(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Every segment of the written files: its place, its document and the CRC-32 of its ids as little-endian uint32."""
    n = max(1, files.count())

    def run(batches):
        for b in batches:
            for path, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with np.load(io.BytesIO(get(path))) as f:
                    a = {k: f[k] for k in f.files}
                rows, at, k = [], 0, 0
                for r, stop in enumerate(a["row_ends"].tolist()):
                    cumulative = a["cumulative_lengths"][at:stop].tolist()
                    for s, (lo, hi) in enumerate(zip(cumulative, cumulative[1:])):
                        doc = int(a["doc_ids"][k]) if a["doc_known"][k] else None
                        rows.append((first + r, s, doc, int(a["starts"][k]), hi - lo, lo, int(a["doc_tokens"][k]), zlib.crc32(little_endian(a["ids"][r, lo:hi]))))
                        k += 1
                    at = stop
                yield record_batch(_SEGMENTS, [list(c) for c in zip(*rows)])

    return files.select("path", "first_sequence").repartition(min(n, 20_000)).mapInArrow(run, SEGMENT_SCHEMA)
