"""Token counts: batches balanced by bytes, long texts split where no token can span, lengths only come back."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import SLICE_BYTES, record_batch, sizes_of, slices, texts_of

#: Characters after which a long text is split at the next safe boundary.
PIECE_CHARS = 16_384
#: Bytes handed to the library at once.
BATCH_BYTES = 1 << 18

# A white-space run starts a new pre-token unless it follows white space, so a letter or digit before a space or line
# feed ends its token there in any context.
_SAFE = re.compile(r"(?<=[^\W_])[ \n]")

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task on each core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def pieces(text: str, size: int = PIECE_CHARS):
    """Parts of a text whose token counts add up to the whole text's; an unbroken run is never cut."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def balanced(parts: list[str], limit: int = BATCH_BYTES):
    """Indices of parts in batches of about `limit` bytes, like sizes together."""
    sizes = [len(p.encode()) for p in parts]
    group, size = [], 0
    for i in sorted(range(len(parts)), key=sizes.__getitem__):
        if group and size + sizes[i] > limit:
            yield group
            group, size = [], 0
        group.append(i)
        size += sizes[i]
    if group:
        yield group


def lengths(texts: list[str], path: str) -> np.ndarray:
    tokenizer = _tokenizer(path)
    parts, owner = [], []
    for i, text in enumerate(texts):
        for p in pieces(text):
            parts.append(p)
            owner.append(i)
    counts = np.zeros(len(parts), np.int64)
    for group in balanced(parts):
        counts[group] = [len(e) for e in tokenizer.encode_batch_fast([parts[i] for i in group], add_special_tokens=False)]
    return np.bincount(np.array(owner, np.int64), weights=counts, minlength=len(texts)).astype(np.int64)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text, as the `tokenizers` library gives them for the file `tokenizer`.

    One row per input row, repeated rows included. A null or empty text has 0 bytes and 0 tokens; a null id stays null;
    an empty table gives no rows. No shuffle: each task streams its own rows in bounded batches.
    """

    def run(batches):
        for b in slices(batches, text_col, SLICE_BYTES):
            texts = texts_of(b, text_col)
            n = lengths(texts.to_pylist(), tokenizer)
            yield record_batch(_ARROW, [b.column(0).cast(pa.int64()), sizes_of(texts), n, n > limit])

    return docs.select(id_col, text_col).mapInArrow(run, SCHEMA)
