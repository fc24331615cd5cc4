"""Token ids of the byte-level vocabulary, as the `tokenizers` library gives them for the .json file.

The ranks come from that file's own vocabulary; encoding runs through `tiktoken`, which gives the same ids (tested) in
about a third of the time.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken

from tessera.llm.tokencount import _tokenizer, pieces

# A run this long is left to the other library: the pattern's look-ahead would exhaust the regular-expression stack.
_LONG_SPACE = re.compile(r"\s{50000}")


def _byte_of() -> dict[str, int]:
    """Characters by which the vocabulary file writes bytes: visible Latin-1 as itself, the rest from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    to_byte = _byte_of()
    ranks = {bytes(to_byte[c] for c in t): i for t, i in file["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encode(text: str, path: str) -> list[int]:
    """Ids of a whole text; strings of special tokens inside it count as those tokens, none are added."""
    e = encoding(path)
    if _LONG_SPACE.search(text):
        return _tokenizer(path).encode(text, add_special_tokens=False).ids
    special = any(s in text for s in e.special_tokens_set)
    ids: list[int] = []
    for part in pieces(text):
        ids += e.encode(part, allowed_special="all") if special else e.encode_ordinary(part)
    return ids


def document_ids(text: str, path: str, end: int) -> np.ndarray:
    """Ids of a document followed by its end id."""
    ids = encode(text, path)
    ids.append(end)
    return np.array(ids, np.uint32)
