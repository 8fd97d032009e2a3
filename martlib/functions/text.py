"""String expressions: cleaning, splitting, casing, matching."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters after which a new word starts when capitalising.
WORD_BREAKS = " \t\n\r[](){}/|<>!?@\"^#$&~_,.:;*%+-"


def initcap_words(col: Column) -> Column:
    """Capitalise each word; punctuation starts a word too, the rest is lower-cased."""
    breaks = "[" + "".join("\\" + c if c in "[]^-\\" else c for c in WORD_BREAKS) + "]"
    pieces = F.split(F.lower(col), f"(?<={breaks})")
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.substr(p, F.lit(2)))),
        "",
    )


def extract(col: Column, pattern: str, group: int = 1) -> Column:
    """First regex match of ``group``, NULL when there is none."""
    return F.when(F.regexp_like(col, F.lit(pattern)), F.regexp_extract(col, pattern, group))


def contains(col: Column, pattern: str) -> Column:
    """True when the regex matches anywhere in the text."""
    return F.regexp_like(col, F.lit(pattern))


def contains_text(col: Column, text: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(col).contains(text.lower())


def split_at(col: Column, sep: str, i: int) -> Column:
    """Element ``i`` (from 0) of the text split on a literal separator; NULL past the end."""
    return F.get(F.split(col, re.escape(sep)), i)


def trim_chars(col: Column, chars: str) -> Column:
    return F.btrim(col, F.lit(chars))


def rtrim_chars(col: Column, chars: str) -> Column:
    return F.rtrim(col, F.lit(chars))


def replace_all(col: Column, replacements: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements applied one after another."""
    for old, new in replacements:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


# Escapes decoded in search URLs, in this order. A plus sign that
# was itself escaped separates values, as the pipe does.
SEARCH_ESCAPES = [("%2B", "|"), ("%7C", "|"), ("%20", " "), ("+", " "), ("%2C", ",")]


def decode_partial(col: Column, replacements: Sequence[tuple[str, str]] = tuple(SEARCH_ESCAPES), trim: str = "|") -> Column:
    """Decode only the listed escapes and trim the separator from both ends."""
    out = replace_all(col, replacements)
    return trim_chars(out, trim) if trim else out


def name_key(col: Column) -> Column:
    """Matching key of a name: trimmed and upper-cased."""
    return F.upper(F.trim(col))


def drop_last(col: Column, n: int) -> Column:
    """Text without its last ``n`` characters."""
    return F.left(col, F.length(col) - n)


def mask_generated(col: Column, prefix: str = "_") -> Column:
    """NULL for generated ids, which start with ``prefix``."""
    return F.when(~col.startswith(prefix), col)


def surrogate_key(*cols: Column | str, null_token: str = "_null_", sep: str = "-") -> Column:
    """md5 of the values joined by ``sep``, with a token in place of NULL."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(null_token)) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))
