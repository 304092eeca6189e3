"""Normalisers, word predicates and offsets.

Offsets are half open and count code points, as ``substring`` and ``length`` do.
The four normalisers differ on purpose; terms normalised by one are only ever
compared with terms normalised by the same.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Letters as the digit spacing sees them: a raw range, which holds some signs and other scripts, too.
LETTERS = "a-zA-ZÀ-ỹ"


@F.pandas_udf(StringType())
def nfc(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Canonical composition; Spark has none."""
    for t in texts:
        yield t.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def norm_ws(text: Column | str) -> Column:
    """Lower case, runs of white space as one blank, none at the ends."""
    return F.lower(F.regexp_replace(F.regexp_replace(_c(text), "(?U)\\s+", " "), "^ | $", ""))


def norm_term(text: Column | str, composed: bool = False) -> Column:
    """Composed, digits and letters set apart, lower case, single blanks.

    ``composed`` tells that the text is composed already, which saves a trip to
    Python; else only texts with combining marks make it.
    """
    own = _c(text)
    if not composed:
        own = F.when(own.rlike("\\p{M}"), nfc(own)).otherwise(own)
    apart = F.regexp_replace(F.regexp_replace(own, f"(\\d)([{LETTERS}])", "$1 $2"), f"([{LETTERS}])(\\d)", "$1 $2")
    return norm_ws(apart)


def norm_synonyms(text: Column | str, pairs: list[tuple[str, str]], composed: bool = False) -> Column:
    """``norm_term``, then each (from, to) in order, on the padded text, and single blanks again."""
    out = F.concat(F.lit(" "), norm_term(text, composed), F.lit(" "))
    for a, b in pairs:
        out = F.replace(out, F.lit(a), F.lit(b))
    return norm_ws(out)


def is_word_char(char: Column | str) -> Column:
    """Underscore, letter or number."""
    return F.coalesce(_c(char).rlike("^[\\p{L}\\p{N}_]$"), F.lit(False))


def outside_word(text: Column | str, start: Column, end: Column) -> Column:
    """No word character touches [start, end) from outside."""
    own = _c(text)
    before = F.when(start > 0, F.substring(own, start, F.lit(1)))
    return ~is_word_char(before) & ~is_word_char(F.substring(own, end + 1, F.lit(1)))


def slice_text(text: Column | str, start: Column, end: Column) -> Column:
    return F.substring(_c(text), start + 1, end - start)


#: Code points of a block.
BLOCK = 256


def blocks_of(text: Column | str) -> Column:
    """The text in pieces of ``BLOCK`` code points, the last may be shorter; one pass."""
    return F.regexp_extract_all(_c(text), F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def slice_blocks(blocks: Column, start: Column, end: Column) -> Column:
    """``slice_text`` by the blocks of a text, for 0 <= start <= end: it looks at those of the
    slice only, where a substring of the text walks to its start from the beginning."""
    first = F.floor(start / BLOCK).cast("int")
    held = F.slice(blocks, first + 1, F.greatest(F.floor((end - 1) / BLOCK).cast("int") - first + 1, F.lit(0)))
    return F.substring(F.array_join(held, ""), (start - first * BLOCK + 1).cast("int"), (end - start).cast("int"))


def overlaps(s: Column, e: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(s, s2) < F.least(e, e2)


def hash_bucket(key: Column, n: int) -> Column:
    """The same pseudo-random number below n in Spark and in other engines."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % n
