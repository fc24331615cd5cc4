"""Token counts, packing and id matrices against the library itself."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import bytebpe, packing, tokencount, tokenids
from tessera.llm.common import get

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


def ids(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB'st 12\n\t  .,<|endoftext>é漢\u0301🙂\x1c\x85"), max_size=60))
def test_both_libraries_agree_and_pieces_add_up(text):
    assert bytebpe.encode(text, PATH) == ids(text)
    parts = list(tokencount.pieces(text, 7))
    assert "".join(parts) == text and sum((ids(p) for p in parts), []) == ids(text)


def test_odd_texts(texts):
    for t in [*texts, " " * 60_000 + "x", "<|endoftext|>" * 5, "a<|endoftext|>\n<|endoftext|>", "\n" * 70_000, "word " * 30_000, "1" * 40_000]:
        assert bytebpe.encode(t or "", PATH) == ids(t)


def test_counts(spark, docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted((str(d), len((t or "").encode()), len(ids(t)), len(ids(t)) > 1024) for d, t in rows)
    got = tokencount.count_tokens(docs, PATH)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()) == want
    assert tokencount.count_tokens(empty, PATH).count() == 0


def test_batches_are_balanced():
    parts = ["x" * n for n in random.Random(1).sample(range(1, 400), 200)]
    groups = list(tokencount.balanced(parts, 1000))
    assert sorted(i for g in groups for i in g) == list(range(200))
    assert all(sum(len(parts[i]) for i in g) <= 1000 for g in groups)


@pytest.fixture(scope="module")
def many(spark, texts):
    rng = random.Random(6)
    rows = [(i, rng.choice(texts)) for i in range(600)] + [(None, "null id"), (3, "again"), (3, "again")]
    rows = [(d, t, "x", 0, "y") for d, t in rows]  # with columns that the operators name too
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, sequence_id int, path string").repartition(5)


def whole(rows, docs, end):
    """Every id of every document lies in one piece, in gapless sequences; returns the used length of each sequence."""
    want = {}
    for d, t in docs:
        own = np.array([*ids(t), end], "<u4")
        want.setdefault(d, []).append(own)
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for d, texts in want.items():
        if len(texts) == 1:
            at = 0
            for start, n, crc, total in sorted(pieces[d]):
                assert start == at and n > 0 and total == len(texts[0]) and crc == zlib.crc32(texts[0][start : start + n].tobytes())
                at += n
            assert at == len(texts[0])
        else:
            assert sum(p[1] for p in pieces[d]) == sum(map(len, texts))
    assert pieces.keys() == want.keys()
    used = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= 1024
    return used


@pytest.mark.parametrize("windows", [2, packing.OPEN_WINDOWS])
def test_packing(spark, many, empty, windows):
    rows = packing.pack(spark, many, PATH, windows=windows).collect()
    used = whole(rows, [tuple(r)[:2] for r in many.collect()], 0)
    assert sum(used.values()) > 0.9 * 1024 * (len(used) - 1)
    assert packing.pack(spark, empty, PATH).count() == 0


def test_packing_groups_of_tasks(spark, many, monkeypatch):
    monkeypatch.setattr(packing, "MERGED_TASKS", 2)
    whole(packing.pack(spark, many, PATH, windows=8).collect(), [tuple(r)[:2] for r in many.collect()], 0)


def test_matrices(spark, many, empty):
    files = tokenids.write_matrices(spark, many, PATH, block_tokens=20_000)
    rows = tokenids.read_segments(spark, files).collect()
    used = whole(rows, [tuple(r)[:2] for r in many.collect()], 50256)
    assert sum(used.values()) > 0.95 * 1024 * (len(used) - files.count())
    for f in files.collect():
        a = np.load(io.BytesIO(get(f.path)))
        positions = tokenids.position_ids(a["position_resets"])
        at = 0
        for r, stop in enumerate(a["row_ends"].tolist()):
            cut = a["cumulative_lengths"][at:stop]
            for lo, hi in zip(cut, cut[1:]):
                assert (positions[r, lo:hi] == np.arange(hi - lo)).all()
            assert (a["ids"][r, cut[-1] :] == 50256).all()
            at = stop
    assert tokenids.read_segments(spark, tokenids.write_matrices(spark, empty, PATH)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_decreasing(lengths):
    got = tokenids.fit(lengths, 16)
    assert sorted((d, s, n) for b in got for d, s, n in b) == sorted((d, s, min(16, n - s)) for d, n in enumerate(lengths) for s in range(0, n, 16))
    bins = []
    for n, _, _ in sorted(((n % 16, -d, 0) for d, n in enumerate(lengths) if n % 16), reverse=True):
        fits = [i for i, free in enumerate(bins) if free >= n]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= n
        else:
            bins.append(16 - n)
    assert len(got) == sum(n // 16 for n in lengths) + len(bins) and all(sum(n for _, _, n in b) <= 16 for b in got)
