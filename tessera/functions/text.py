"""Text expressions with Python's meaning, as built-in Spark columns and as equal SQL fragments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 29 code points that Python's str.split() and str.strip() take as white space; both engines read this class alike.
WS = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: The same code points one by one, for trimming.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
#: Words of two characters or more, for term weights.
TERM = r"[\p{L}\p{N}_]{2,}"
_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/:?#]*)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """str.strip(): looks at the ends only."""
    return F.btrim(col(c), F.lit(SPACES))


def normalise(c: Column | str) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(F.lower(col(c)), f"{WS}+", " "))


def tokens(normalised: Column) -> Column:
    """Words of a normalised text; none for an empty one."""
    return F.when(normalised == "", F.array().cast("array<string>")).otherwise(F.split(normalised, " "))


def falsy(c: Column | str) -> Column:
    """Null where Python takes the string as false."""
    return F.nullif(col(c), F.lit(""))


def host(url: Column | str) -> Column:
    """urllib's hostname: lower case, without user, port and brackets; null where there is none."""
    return F.nullif(F.lower(F.regexp_replace(F.regexp_extract(col(url), _HOST, 1), r"^\[|\]$", "")), F.lit(""))


def bare_host(url: Column | str) -> Column:
    """The host without leading characters of `w.`, however many (so `wx.com` becomes `x.com`)."""
    return F.regexp_replace(host(url), r"^[w.]+", "")


def under_domain(bare: Column, domains) -> Column:
    """Whether a bare host is one of the domains or below one; an unknown host is not."""
    hit = F.lit(False)
    for d in domains:
        hit = hit | (bare == d) | bare.endswith("." + d)
    return F.coalesce(hit, F.lit(False))


def ws_sql(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def normalise_sql(c: str) -> str:
    return ws_sql(f"regexp_replace(lower({c}), '{WS}+', ' ', 'g')")


def bare_host_sql(c: str) -> str:
    return f"regexp_replace(lower(regexp_replace(regexp_extract({c}, '{_HOST}', 1), '^\\[|\\]$', '', 'g')), '^[w.]+', '')"
