"""Quality rules: base counts of words, symbols and repetition, and the fertility of public tokeniser vocabularies."""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tessera.llm.common import covered, hashes_of, record_batch, rolling, slices, starts_of, texts_of, words_of

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"

#: Texts of so many tokens are held to an entropy in bits, which then hardly depends on length; shorter ones to a share
#: of the most that their tokens could have.
ENTROPY_TOKENS = 500

#: Bands by language: characters per token (least, most), largest byte-fallback share, least token entropy as a share and
#: in bits. A text out of a band is rejected. Other languages take the bands of the script that most of the text's letters
#: are of; "*" holds for scripts without. Scripts other than Latin have some 0.6 of the characters per token and 0.7 of the
#: entropy of a paragraph of clean prose, and 0.15 more of byte fallback.
BANDS = {
    "en": (1.75, 8.0, 0.10, 0.45, 6.2),
    "de": (1.60, 8.0, 0.10, 0.45, 6.0),
    "fr": (1.50, 8.0, 0.10, 0.45, 5.9),
    "es": (1.45, 8.0, 0.10, 0.45, 5.75),
    "latin": (0.90, 10.0, 0.50, 0.40, 4.0),
    "greek": (0.46, 10.0, 0.15, 0.44, 3.9),
    "cyrillic": (0.47, 10.0, 0.15, 0.43, 3.8),
    "armenian": (0.27, 10.0, 0.31, 0.29, 2.6),
    "georgian": (0.20, 10.0, 0.17, 0.24, 2.2),
    "hebrew": (0.41, 10.0, 0.15, 0.38, 3.4),
    "arabic": (0.49, 10.0, 0.15, 0.46, 4.1),
    "devanagari": (0.31, 10.0, 0.23, 0.35, 3.1),
    "bengali": (0.25, 10.0, 0.32, 0.31, 2.7),
    "tamil": (0.20, 10.0, 0.31, 0.25, 2.2),
    "telugu": (0.20, 10.0, 0.64, 0.26, 2.3),
    "thai": (0.27, 10.0, 0.17, 0.33, 2.9),
    "hangul": (0.20, 10.0, 0.18, 0.45, 4.0),
    "ethiopic": (0.20, 10.0, 1.00, 0.32, 2.8),
    "cjk": (0.24, 10.0, 0.26, 0.54, 4.8),
    "*": (0.20, 10.0, 1.00, 0.24, 2.2),
}

#: First and last code points of each script's letters.
SCRIPTS = (
    ("latin", 0x41, 0x5A), ("latin", 0x61, 0x7A), ("latin", 0xC0, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF), ("*", 0x700, 0x74F), ("arabic", 0x750, 0x77F),
    ("*", 0x780, 0x8FF), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("*", 0xA00, 0xB7F), ("tamil", 0xB80, 0xBFF),
    ("telugu", 0xC00, 0xC7F), ("*", 0xC80, 0xDFF), ("thai", 0xE00, 0xE7F), ("*", 0xE80, 0x109F), ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("ethiopic", 0x1200, 0x139F), ("*", 0x13A0, 0x1DFF), ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF),
    ("*", 0x2C00, 0x2DFF), ("cjk", 0x3040, 0x30FF), ("hangul", 0x3130, 0x318F), ("cjk", 0x3400, 0x9FFF), ("*", 0xA000, 0xABFF),
    ("hangul", 0xAC00, 0xD7AF), ("cjk", 0xF900, 0xFAFF), ("arabic", 0xFB50, 0xFDFF), ("arabic", 0xFE70, 0xFEFC), ("*", 0x10000, 0x1CFFF), ("cjk", 0x20000, 0x3FFFF),
)
_EDGES = np.array([x for _, a, b in SCRIPTS for x in (a, b + 1)], np.uint32)
_NAMES = sorted({name for name, _, _ in SCRIPTS})
_SPANS = np.array([len(_NAMES)] + [x for name, _, _ in SCRIPTS for x in (_NAMES.index(name), len(_NAMES))])

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = ("chars_per_token", "byte_share", "entropy")
_SCHEMA = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), *((m, pa.float64()) for m in MEASURES), ("base_failed", pa.bool_()), ("kept", pa.bool_())])
SCHEMA = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), *(f"{m} double" for m in MEASURES), "base_failed boolean", "kept boolean"])


@lru_cache(maxsize=2)
def _bytes_vocabulary(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _pieces_vocabulary(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, np.fromiter((model.is_byte(i) for i in range(model.get_piece_size())), np.int64, model.get_piece_size())


def _totals(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of `values` between offsets."""
    sums = np.concatenate([np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values, dtype=None if values.dtype.kind == "f" else np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def base_counts(texts: pa.Array, words=None) -> dict[str, np.ndarray]:
    """The five base counts of each text; words are runs without ASCII white space."""
    codes, words_, offsets = words or words_of(texts)
    n = len(texts)
    word_chars = _totals(pc.utf8_length(words_).to_numpy(zero_copy_only=False).astype(np.int64)[codes], offsets)
    raw, at = _flat_bytes(texts)
    is_symbol = np.zeros(256, np.int64)
    is_symbol[list(SYMBOLS)] = 1
    n_symbols = _totals(is_symbol[raw], at)

    lines = pc.split_pattern(texts, "\n")
    ends = lines.offsets.to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(n), np.diff(ends))
    flat = lines.flatten()
    full = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0).to_numpy(zero_copy_only=False)
    same = flat.dictionary_encode()
    key = (owner * max(1, len(same.dictionary)) + same.indices.to_numpy())[full]
    first = np.unique(key, return_index=True)[1]
    n_dup = np.bincount(owner[full], minlength=n) - np.bincount(owner[full][first], minlength=n)

    start = starts_of(offsets, REPEAT_WINDOW)
    hit = np.zeros(len(codes), bool)
    if len(start):
        h = rolling(hashes_of(words_)[codes], REPEAT_WINDOW)[start]
        owner = np.searchsorted(offsets, start, side="right") - 1
        with np.errstate(over="ignore"):
            h = h + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        order = np.argsort(h, kind="stable")
        same_next = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        repeated = np.zeros(len(h), bool)
        repeated[order[1:][same_next]] = True
        repeated[order[:-1][same_next]] = True
        hit = covered(start[repeated], REPEAT_WINDOW, len(codes))
    return {"n_words": np.diff(offsets), "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup, "n_repeat_words": _totals(hit.astype(np.int64), offsets)}


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the lists, and all their items."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return sizes, np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))


def fertility(words, bytes_path: str, pieces_path: str, word_chars: np.ndarray) -> dict[str, np.ndarray]:
    """Characters per token, byte-fallback share, token entropy in bits and token count of each text.

    Both vocabularies break at white space, so each distinct word of the batch is encoded once and texts are measured
    by gathering; no text is cut.
    """
    codes, words_, offsets = words
    n_texts, plain = len(offsets) - 1, words_.to_pylist()
    tokenise = _bytes_vocabulary(bytes_path).encode_ordinary
    count, flat = _joined([tokenise(" " + w) for w in plain])
    at = np.concatenate([[0], np.cumsum(count)])
    n_tokens = _totals(count[codes], offsets)

    model, is_byte = _pieces_vocabulary(pieces_path)
    pieces, piece = _joined(model.encode(plain, num_threads=1) if plain else [])
    fallback = _totals(is_byte[piece], np.concatenate([[0], np.cumsum(pieces)]))
    share = _totals(fallback[codes], offsets) / np.maximum(1, _totals(pieces[codes], offsets))

    each = count[codes]
    spread = np.repeat(at[:-1][codes] - np.concatenate([[0], np.cumsum(each)[:-1]]) if len(each) else each, each)
    token = flat[spread + np.arange(len(spread))]
    owner = np.repeat(np.repeat(np.arange(n_texts), np.diff(offsets)), each)
    keys, found = np.unique(owner * (1 << 17) + token, return_counts=True)
    p = found / n_tokens[keys >> 17]
    entropy = np.bincount(keys >> 17, weights=-p * np.log2(p), minlength=n_texts)
    return {"chars_per_token": word_chars / np.maximum(1, n_tokens), "byte_share": share, "entropy": entropy, "n_tokens": n_tokens}


def script(text: str) -> str:
    """The script that most letters of the text are of; "latin" where there are none."""
    found = np.zeros(len(_NAMES) + 1, np.int64)
    for i in range(0, len(text), 1 << 20):
        points = np.frombuffer(text[i : i + (1 << 20)].encode("utf-32-le"), np.uint32)
        found += np.bincount(_SPANS[np.searchsorted(_EDGES, points, side="right")], minlength=len(found))
    return _NAMES[int(found[:-1].argmax())] if found[:-1].any() else "latin"


def judged(batch: pa.RecordBatch, text_col: str, lang_col: str | None, bytes_path: str, pieces_path: str, bands) -> dict[str, np.ndarray]:
    texts = texts_of(batch, text_col)
    words = words_of(texts)
    m = base_counts(texts, words)
    m |= fertility(words, bytes_path, pieces_path, m["word_chars"])
    m["base_failed"] = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"])
    languages = batch.column(batch.schema.get_field_index(lang_col)).to_pylist() if lang_col else [None] * len(texts)
    chosen = [bands[x] if x in bands else bands.get(script(texts[i].as_py()), bands["*"]) for i, x in enumerate(languages)]
    least, most, share, part, bits = np.array(chosen, float).reshape(-1, 5).T
    floor = np.where(m["n_tokens"] >= ENTROPY_TOKENS, bits, part * np.log2(np.clip(m["n_tokens"], 2, ENTROPY_TOKENS)))
    m["kept"] = ~m["base_failed"] & (m["chars_per_token"] >= least) & (m["chars_per_token"] <= most) & (m["byte_share"] <= share) & (m["entropy"] >= floor)
    return m


def _paths(bytes_path: str | None, pieces_path: str | None) -> tuple[str, str]:
    return bytes_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pieces_path or public_tokenizers.path("piece_bpe_32k.model")


def measure(docs: DataFrame, bytes_path: str | None = None, pieces_path: str | None = None, bands=None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, the base counts, the three measures, base_failed and kept of every row.

    A null or empty text has no words and fails the base rules; a null id stays null; an unknown, null or missing
    language takes the bands of the text's script; repeated rows are judged alike; an empty table gives no rows. No shuffle.
    """
    (a, b), lang = _paths(bytes_path, pieces_path), lang_col if lang_col in docs.columns else None
    rules = bands or BANDS

    def run(batches):
        for batch in slices(batches, text_col):
            m = judged(batch, text_col, lang, a, b, rules)
            yield record_batch(_SCHEMA, [batch.column(0).cast(pa.int64()), *(m[f.name] for f in _SCHEMA if f.name != "doc_id")])

    return docs.select(id_col, text_col, *([lang] if lang else [])).mapInArrow(run, SCHEMA)


def accepted(docs: DataFrame, bytes_path: str | None = None, pieces_path: str | None = None, bands=None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows that the rules keep, with all their columns unchanged.

    Null, empty and short texts go, whatever their other columns; repeated rows stay or go together; columns may have any
    name; an empty table gives no rows.
    """
    (a, b), lang = _paths(bytes_path, pieces_path), lang_col if lang_col in docs.columns else None
    rules = bands or BANDS

    def run(batches):
        for batch in slices(batches, text_col):
            yield batch.filter(pa.array(judged(batch, text_col, lang, a, b, rules)["kept"]))

    return docs.mapInArrow(run, docs.schema)
