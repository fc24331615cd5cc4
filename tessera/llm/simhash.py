"""SimHash near-duplicates: fingerprints of word shingles and an exact Hamming self-join by binary tries.

Equal fingerprints are collapsed first. The fingerprint's bits are cut into segments, one for each trie; with budgets that
add up to the distance, two fingerprints that are near differ within the budget of some segment. A trie has the bits of its
segment on top and all others below. It is joined with itself: pairs of nodes descend together, the bits on which they
differ are added up, and a pair over the budget of the segment, later over the distance, is pruned with all below it.

A trie of many values is cut at its top into branches, which are partition keys: of d differing bits, one of d + 1 pieces of
the segment has none, so each piece in turn leads the trie, and the branch is given by that piece's first bits. A branch
hands on a spanning forest of its links, never all pairs; components follow from alternating minimum steps.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, from_blocks, hashes_of, in_blocks, mixed, record_batch, rolling, scratch, slices, starts_of, stored, texts_of, words_of

SEED = 42
#: Bytes of a text that are split into words at once.
PART_BYTES = 1 << 18
_GAP = re.compile(rb"[\x20\x09-\x0D]")
#: Values after which the whole branches held so far are joined.
STEP_VALUES = 1 << 17
#: Node pairs walked, and value pairs compared, in one vectorised step.
FRONTIER = 1 << 20
#: Below the segment, node pairs of so few value pairs are compared at once.
BUCKET = 64


class Kind(NamedTuple):
    """What fingerprints are made of and when two are near.

    `tries` and `part` (values of a branch that one task joins; larger ones are dealt out as pairs of such parts) set the
    cost and never the result.
    """

    shingle: int
    bits: int
    distance: int
    tries: int
    part: int

    @property
    def words(self) -> list[str]:
        return [f"w{i}" for i in range(self.bits // 64)]


#: 64 bits of all 3-word shingles, repeats included, hashed by XXH64.
NEAR = Kind(shingle=3, bits=64, distance=3, tries=2, part=1 << 15)
#: 256 bits of the different 5-word shingles. Sets of similarity 0.8 have a cosine of 8/9 and differ in 39 bits on average
#: with a deviation of 6; 44 takes nearly all pairs of that similarity or more, and many from 0.75 on.
COPIES = Kind(shingle=5, bits=256, distance=44, tries=15, part=1 << 18)


def _ones(words: list[bytes], shingle: int) -> tuple[np.ndarray, int]:
    """How often each bit is set in the hashes of the words' shingles, and how many these are."""
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    begin = (ends - sizes + 1)[:n].tolist()
    stop = ends[min(shingle, len(words)) - 1 :].tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(joined[a:b], SEED) for a, b in zip(begin, stop)), np.uint64, n)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64), n


def fingerprint(text: str, shingle: int = NEAR.shingle) -> int:
    """64-bit SimHash of one text: a bit is set where over half of the shingle hashes have it; no words give 0.

    A long text is read in parts that end at white space and overlap by a shingle less one word, so memory is bounded.
    """
    raw, at, held = text.encode().translate(LOWER), 0, []
    ones, n = np.zeros(64, np.int64), 0
    while at < len(raw):
        gap = _GAP.search(raw, at + PART_BYTES)
        stop = gap.end() if gap else len(raw)
        held += raw[at:stop].split()
        at = stop
        if len(held) >= shingle:
            more, k = _ones(held, shingle)
            ones, n, held = ones + more, n + k, held[len(held) - shingle + 1 :]
    if not n and held:
        ones, n = _ones(held, shingle)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def different_shingles(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's different shingles, and where each text's begin; a text of fewer words is one shingle."""
    codes, words, offsets = words_of(texts, LOWER)
    hashes, lengths = hashes_of(words)[codes], np.diff(offsets)
    start = starts_of(offsets, shingle)
    owner = np.searchsorted(offsets, start, side="right") - 1
    short = np.flatnonzero((lengths > 0) & (lengths < shingle))
    whole = [xxhash.xxh64_intdigest(hashes[offsets[i] : offsets[i + 1]].tobytes()) for i in short]
    tokens = np.concatenate([rolling(hashes, shingle)[start], np.array(whole, np.uint64)])
    owner = np.concatenate([owner, short])
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    first = np.ones(len(tokens), bool)
    first[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    tokens, owner = tokens[first], owner[first]
    return tokens, np.searchsorted(owner, np.arange(len(texts) + 1))


def wide_fingerprints(texts: pa.Array, kind: Kind = COPIES) -> np.ndarray:
    """A row of 64-bit words for each text: SimHash of its different shingles; no words give zeros."""
    tokens, at = different_shingles(texts, kind.shingle)
    out = np.zeros((len(texts), kind.bits // 64), np.uint64)
    size = np.diff(at)
    for w in range(kind.bits // 64):
        ones = np.zeros((len(texts), 64), np.int64)
        for lo in range(0, len(tokens), PART_BYTES):
            part = tokens[lo : lo + PART_BYTES]
            bits = np.unpackbits(mixed(part + np.uint64((w + 1) * 0x9E3779B97F4A7C15 % (1 << 64))).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            inside = np.flatnonzero((np.minimum(at[1:], lo + len(part)) > np.maximum(at[:-1], lo)))
            ones[inside] += np.add.reduceat(bits, np.maximum(at[inside] - lo, 0), axis=0, dtype=np.int64)
        out[:, w] = np.packbits(2 * ones > size[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(texts: pa.Array, kind: Kind) -> list[np.ndarray]:
    """The signed words of each text's fingerprint, one array a word."""
    if kind.bits == 64:
        return [np.fromiter((fingerprint(t, kind.shingle) for t in texts.to_pylist()), np.uint64, len(texts)).view(np.int64)]
    found = wide_fingerprints(texts, kind)
    return [np.ascontiguousarray(found[:, w]).view(np.int64) for w in range(found.shape[1])]


class Trie(NamedTuple):
    """One way to look: bits from the top, how many of them lead a branch, how many are of the segment, its budget."""

    order: list[int]
    top: int
    segment: int
    budget: int


def tries(n: int, kind: Kind) -> list[Trie]:
    """Tries that together meet every pair of near fingerprints, for n different ones."""
    edges = np.linspace(0, kind.bits, kind.tries + 1).astype(int)
    base, more = divmod(kind.distance + 1, kind.tries)
    wanted = max(0, math.ceil(math.log2(max(1, n) / kind.part)))
    out = []
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        budget, own = base - 1 + (i < more), list(range(lo, hi))
        rest = [b for b in range(kind.bits) if not lo <= b < hi]
        if budget < 0:  # more tries than the distance asks for
            continue
        cuts = np.linspace(0, hi - lo, budget + 2).astype(int)
        for a, b in zip(cuts, cuts[1:]):
            lead = own[a:b]
            top = min(wanted, len(lead))
            out.append(Trie(lead + [x for x in own if x not in lead] + rest, top, hi - lo, budget))
            if not wanted:  # one branch holds all: one leading piece is enough
                break
    return out


class Forest:
    """Union by smaller root over positions of an array."""

    def __init__(self, n: int):
        self.up = np.arange(n)
        self.changed = True

    def roots(self) -> np.ndarray:
        while True:
            nxt = self.up[self.up]
            if (nxt == self.up).all():
                return nxt
            self.up = nxt

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            up = self.roots()
            a, b = up[a], up[b]
            apart = a != b
            a, b = a[apart], b[apart]
            if len(a):
                self.changed = True
                np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))


def descend(values: np.ndarray, nodes: tuple, levels: int, segment: int, budget: int, distance: int, forest: Forest, seen: Counter | None = None) -> None:
    """Joins tries, given as pairs of root nodes (a0, a1, b0, b1); links go to `forest`.

    A row of `values` holds the bits of a value in trie order, the first in the highest place; a node is a piece of an array
    sorted by them. Pairs within a subtrie come before pairs across it, and a pair whose values are in one component
    already is passed over, so that a large group of near values is tied together without comparing all of its pairs.
    """
    seen = Counter() if seen is None else seen
    stack = [(0, *nodes, np.zeros(len(nodes[0]), np.int16))]
    zeros: dict[int, np.ndarray] = {}
    roots = edge = None
    while stack:
        level, a0, a1, b0, b1, cost = stack.pop()
        if forest.changed:
            roots, forest.changed = forest.roots(), False
            edge = np.concatenate([[0], np.cumsum(roots[1:] != roots[:-1])])
        if not len(a0):
            continue
        apart = (roots[a0] != roots[b0]) | (edge[a1 - 1] != edge[a0]) | (edge[b1 - 1] != edge[b0])
        seen["tied"] += len(a0) - int(apart.sum())
        a0, a1, b0, b1, cost = (x[apart] for x in (a0, a1, b0, b1, cost))
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            stack += [(level, *(x[half:] for x in (a0, a1, b0, b1, cost))), (level, *(x[:half] for x in (a0, a1, b0, b1, cost)))]
            continue
        seen["descended"] += len(a0)
        pairs = (a1 - a0) * (b1 - b0)
        done = (pairs == 1) | (level == levels) | ((level >= segment) & (pairs <= BUCKET))
        if done.any():
            seen["leaves"] += int(done.sum())
            _leaves(values, a0[done], a1[done], b0[done], b1[done], distance, forest)
            a0, a1, b0, b1, cost = (x[~done] for x in (a0, a1, b0, b1, cost))
        if not len(a0):
            continue
        if level not in zeros:
            if len(zeros) > 64:
                zeros.clear()
            bit = (values[:, level // 64] >> np.uint64(63 - level % 64)) & np.uint64(1)
            zeros[level] = np.concatenate([[0], np.cumsum(bit == 0)]).astype(np.int32)
        z = zeros[level]
        am, bm = a0 + z[a1] - z[a0], b0 + z[b1] - z[b0]  # zeros come first in a sorted node
        own = a0 == b0
        two, more = ~own, cost + 1
        within = [(a0[own], am[own], b0[own], bm[own], cost[own]), (am[own], a1[own], bm[own], b1[own], cost[own])]
        across = [(a0, am, bm, b1, more), *(tuple(x[two] for x in p) for p in ((am, a1, b0, bm, more), (a0, am, b0, bm, cost), (am, a1, bm, b1, cost)))]
        limit = budget if level < segment else distance
        for children in (across, within):  # the last is walked first
            a0, a1, b0, b1, cost = (np.concatenate(x) for x in zip(*children))
            there = (a0 < a1) & (b0 < b1)
            keep = there & (cost <= limit) & ~((a0 == b0) & (a1 - a0 == 1))
            seen["pruned"] += int((there & (cost > limit)).sum())
            if keep.any():
                stack.append((level + 1, *(x[keep] for x in (a0, a1, b0, b1, cost))))


def _leaves(values, a0, a1, b0, b1, distance, forest) -> None:
    """Compare all bits of the few values below node pairs."""
    nb, size = b1 - b0, (a1 - a0) * (b1 - b0)
    ends = np.cumsum(size)
    lo = 0
    while lo < len(a0):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + FRONTIER, side="right")))
        n = size[lo:hi]
        pair = np.repeat(np.arange(lo, hi), n)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        i, j = a0[pair] + k // nb[pair], b0[pair] + k % nb[pair]
        near = i < j
        i, j = i[near], j[near]
        differ = np.zeros(len(i), np.uint16)
        for w in range(values.shape[1]):
            differ += np.bitwise_count(values[i, w] ^ values[j, w])
        near = differ <= distance
        forest.join(i[near], j[near])
        lo = hi


def forest_edges(words: list[np.ndarray], run: np.ndarray, side: np.ndarray, trie: Trie, distance: int, seen: Counter | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of links that make spanning forests of the runs; the values of a run share the trie's top.

    Runs in which `side` is 1 for some values are joined across sides only, others with themselves.
    """
    n = len(run)
    raw = np.ascontiguousarray(np.stack(words, axis=1).astype("<u8", copy=False)).view(np.uint8).reshape(n, -1)
    order = trie.order[trie.top :]
    bits = np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, order], axis=1)
    bits = np.ascontiguousarray(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8)))).view(">u8").astype(np.uint64)
    by = np.lexsort((*(bits[:, w] for w in reversed(range(bits.shape[1]))), side, run))
    bits, run, side = bits[by], run[by], side[by]
    begin = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if n else np.zeros(0, np.int64)
    end = np.append(begin[1:], n)
    second = np.concatenate([[0], np.cumsum(side == 0)])
    middle = begin + second[end] - second[begin]
    whole = (middle == end) | (middle == begin)  # one side alone: of a cross join nothing is left, of a run all
    alone = whole & (side[begin] == 0) if n else whole
    nodes = [np.concatenate([x[~whole], y[alone]]) for x, y in ((begin, begin), (middle, end), (middle, begin), (end, end))]
    several = (nodes[0] != nodes[2]) | (nodes[1] - nodes[0] > 1)
    forest = Forest(n)
    descend(bits, tuple(x[several] for x in nodes), len(order), trie.segment - trie.top, trie.budget, distance, forest, seen)
    roots = forest.roots()
    joined = np.flatnonzero(roots != np.arange(n))
    return by[joined], by[roots[joined]]


def links(spark: SparkSession, prints: DataFrame, kind: Kind = NEAR) -> DataFrame:
    """Edges (a, b) of ids that connect exactly the fingerprints connected by chains of near ones.

    `prints` has a long `id` and the fingerprint's words `w0`, `w1`, ..., all different. A branch of over `kind.part` values
    is dealt out as pairs of parts: a part meets itself once and every other part across, so no task holds an unbounded
    branch and none is skipped.
    """
    n = prints.count()
    found = tries(n, kind)
    columns = ["id", *kind.words]
    keyed_schema = "trie int, branch int, " + ", ".join(f"{c} long" for c in columns)
    keyed_out = pa.schema([("trie", pa.int32()), ("branch", pa.int32()), *((c, pa.int64()) for c in columns)])

    def keyed(batches):
        for b in batches:
            if not b.num_rows:
                continue
            words = [c.to_numpy().view(np.uint64) for c in b.columns[1:]]
            for i, t in enumerate(found):
                branch = np.zeros(b.num_rows, np.int64)
                for bit in t.order[: t.top]:
                    branch = (branch << 1) | ((words[bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)).astype(np.int64)
                yield record_batch(keyed_out, [np.full(b.num_rows, i, np.int32), branch.astype(np.int32), *b.columns])

    rows = prints.select(*columns).mapInArrow(keyed, keyed_schema)
    branches = sum(1 << t.top for t in found)
    if n > kind.part:
        # Parts of a hot branch meet in pairs (i, j); a row goes to the meetings of its part, on side 1 where it is the second.
        large = rows.groupBy("trie", "branch").count().where(F.col("count") > kind.part)
        large = large.select("trie", "branch", F.ceil(F.col("count") / F.lit(kind.part)).cast("int").alias("parts"))
        branches += n // kind.part * len(found)
        rows = rows.join(large.hint("shuffle_hash"), ["trie", "branch"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(F.least(j, F.col("own")).alias("i"), F.greatest(j, F.col("own")).alias("j")))
        rows = rows.withColumn("m", F.explode(meets)).select("trie", "branch", F.col("m.i").alias("i"), F.col("m.j").alias("j"), ((F.col("m.i") < F.col("m.j")) & (F.col("own") == F.col("m.j"))).cast("int").alias("side"), *columns)
    else:
        zero = F.lit(0)
        rows = rows.select("trie", "branch", zero.alias("i"), zero.alias("j"), zero.alias("side"), *columns)
    key = ["trie", "branch", "i", "j"]
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(min(20_000, 3 * branches, max(least, n * len(found) >> 12)), *key).sortWithinPartitions(*key)
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        held: list[list[np.ndarray]] = []  # whole runs of one trie, and the one being read
        size, number, last = 0, 0, None

        def joined():
            nonlocal held, size
            cols = [np.concatenate(x) for x in zip(*held)]
            held, size = [], 0
            a, b = forest_edges([c.view(np.uint64) for c in cols[3:]], cols[0], cols[1], found[last[0]], kind.distance)
            return record_batch(out, [cols[2][a], cols[2][b]])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy() for c in batch.columns]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)) + 1
            cuts = np.concatenate([[0], change, [batch.num_rows]])
            numbers = number + np.repeat(np.arange(1, len(cuts)), np.diff(cuts))
            if last is not None and tuple(int(c[0]) for c in cols[:4]) == last:
                numbers -= 1
            # A step ends where the trie changes, or at a run's end once enough is held.
            steps, since = [], size
            for c, before in zip(cuts[1:-1].tolist(), cuts[:-2].tolist()):
                since += c - before
                if cols[0][c] != cols[0][c - 1] or since > STEP_VALUES:
                    steps.append(c)
                    since = 0
            for lo, hi in zip([0, *steps], [*steps, batch.num_rows]):
                if held and (int(cols[0][lo]) != last[0] or size > STEP_VALUES and int(numbers[lo]) != number):
                    yield joined()
                held.append([numbers[lo:hi], cols[4][lo:hi], *(c[lo:hi] for c in cols[5:])])
                size += hi - lo
                number, last = int(numbers[hi - 1]), tuple(int(c[hi - 1]) for c in cols[:4])
        if held:
            yield joined()

    return ordered.mapInArrow(run, "a long, b long")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) of every node of (a, b) edges; the root is the smallest node of its component.

    Alternates two minimum steps until nothing changes: every larger neighbour of a node moves to the least node around it,
    then every smaller one does. All groupings are pre-aggregated minima and a hub's many rows meet one build row, so a
    hot component is split like any skewed join. Each step is written to the shared folder.
    """
    now = stored(spark, edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(spark, both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.join(least.hint("shuffle_hash"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(spark, large, "edges")
        least = stored(spark, large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least.hint("shuffle_hash"), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = stored(spark, small, "edges")
        before, state = state, _state(now)
        if state == before:
            break
    members = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.expr("bit_xor(xxhash64(u, v))"), F.lit(0))).first())


def clustered(spark: SparkSession, rows: DataFrame, kind: Kind, first: str) -> DataFrame:
    """(words, root, first) of every different fingerprint of `rows`: its component, and the least `first` of its rows."""
    number = F.col("w0") if kind.bits == 64 else F.monotonically_increasing_id()
    prints = rows.groupBy(*kind.words).agg(F.min(first).alias("first")).withColumn("id", number)
    prints = stored(spark, prints, "fingerprints")
    member = components(spark, links(spark, prints, kind)).select(F.col("node").alias("id"), "root")
    return prints.join(member, "id", "left").select(*kind.words, F.coalesce("root", "id").alias("root"), "first")


def near_duplicates(spark: SparkSession, docs: DataFrame, kind: Kind = NEAR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex digits) and component_id, the smallest doc_id reachable over near links, of every row.

    A null, empty or blank text has fingerprint 0 and is linked like any other. Rows with a null doc_id take part and get
    the least doc_id of their component, null if it has none. Repeated rows each keep a row. An empty table gives none.
    """
    out = pa.schema([("doc_id", pa.int64()), *((w, pa.int64()) for w in kind.words)])

    def run(batches):
        for b in slices(batches, "text"):
            yield record_batch(out, [b.column(0), *fingerprints(texts_of(b, "text"), kind)])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(spark, texts.mapInArrow(run, "doc_id long, " + ", ".join(f"{w} long" for w in kind.words)), "prints")
    known = clustered(spark, rows, kind, "doc_id")
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    named = known.join(least, "root").select(*kind.words, "component_id")
    digits = F.concat(*(F.lower(F.lpad(F.hex(w), 16, "0")) for w in kind.words))
    return rows.join(named.hint("shuffle_hash"), kind.words).select("doc_id", digits.alias("fingerprint"), "component_id")


def one_of_each(spark: SparkSession, docs: DataFrame, kind: Kind = COPIES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component with all its columns: that of the smallest doc_id (nulls last); repeated rows count once.

    Null, empty and blank texts have fingerprint 0 and are copies of each other; an empty table gives no rows. Columns may
    have any names. Rows are written once to block files, which the places of the rows that stay are sent to; texts are
    never shuffled.
    """
    folder = scratch(spark, "copies")
    prints = lambda b: fingerprints(texts_of(b, text_col), kind)
    rows = in_blocks(spark, docs, folder, text_col, id_col, kind.words, prints)
    rows = rows.withColumn("k", F.struct(F.coalesce("id", F.lit((1 << 63) - 1)).alias("id"), "block", "at"))
    known = clustered(spark, rows, kind, "k")
    stay = known.groupBy("root").agg(F.min("first").alias("k")).select("k.block", "k.at")
    return from_blocks(rows, stay, folder, docs.schema)
