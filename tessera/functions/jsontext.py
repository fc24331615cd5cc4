"""Finding one JSON value in model output."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_FENCE = re.compile(r"```(?:json)?\s*\n(.*?)```", re.S)
_MARKS = re.compile(r'\\.|["{}]', re.S)


def _parsed(text: str):
    """(found, value)."""
    try:
        return True, json.loads(text)
    except ValueError:
        return False, None


def balanced(text: str) -> list[str]:
    """For each opening brace the span to the brace that balances it, longest first; braces in strings do not count."""
    spans = []
    for begin in (m.start() for m in re.finditer(r"\{", text)):
        depth, quoted = 0, False
        for m in _MARKS.finditer(text, begin):
            mark = m.group()
            if mark == '"':
                quoted = not quoted
            elif len(mark) == 1 and not quoted:
                depth += 1 if mark == "{" else -1
                if not depth:
                    spans.append(text[begin : m.end()])
                    break
    return sorted(spans, key=len, reverse=True)


def extract_json(text: str):
    """The whole text, else the first fenced block that parses, else the longest balanced object that does."""
    text = text.strip()
    for candidates in ([text], (m.group(1).strip() for m in _FENCE.finditer(text)), balanced(text)):
        for c in candidates:
            found, value = _parsed(c)
            if found:
                return value
    raise ValueError("no JSON value in the text")


def json_in(text: Column) -> Column:
    """Compact JSON of the value in each text, null where there is none."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return None
            try:
                return json.dumps(extract_json(t), ensure_ascii=False, separators=(",", ":"))
            except ValueError:
                return None

        return texts.map(one)

    return run(text)


def tolerant(line: Column) -> Column:
    """Compact JSON of a log line: the whole line, else the part from the first `{` to the last `}`, else null."""
    whole = F.try_parse_json(F.trim(line))
    part = F.try_parse_json(F.regexp_extract(line, r"(?s)\{.*\}", 0))
    return F.to_json(F.coalesce(whole, part))
