"""Text expressions (Column -> Column)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from incident_engine.constants import NA_TOKENS

# ASCII blanks and separators, then the Unicode blanks
WHITESPACE = (
    " \t\n\r\f\v\x1c\x1d\x1e\x1f"
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The longest numeric prefix of a text, as a lenient number parser reads it.
NUMERIC_PREFIX = r"^[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"


def strip(col: Column) -> Column:
    """Remove whitespace on both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def null_if_na(col: Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Turn the not-available tokens into null (S3)."""
    return F.when(~col.isin(*tokens), col)


def hour_label(hour: Column) -> Column:
    """``7`` -> ``07:00``."""
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def zero_padded(number: Column, width: int) -> Column:
    """Pad a non-negative integer to at least ``width`` digits; longer ones stay whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def signed_two_decimals(value: Column) -> Column:
    """``1.5`` -> ``+1.50``; zero and negatives carry no plus."""
    return F.concat(F.when(value > 0, "+").otherwise(""), F.format_string("%.2f", value))


def thousands(number: Column, digits: int = 0) -> Column:
    """``1234567`` -> ``1,234,567``; commas between thousands and ``digits`` decimals."""
    return F.format_number(number, digits)


def first_present(*cols: Column, default: str | None = None) -> Column:
    """First value that is neither null nor empty (C4)."""
    candidates = [F.nullif(c.cast("string"), F.lit("")) for c in cols]
    if default is not None:
        candidates.append(F.lit(default))
    return F.coalesce(*candidates)


def leading_number(col: Column) -> Column:
    """Number at the start of a text, null when there is none."""
    return F.regexp_extract(strip(col), NUMERIC_PREFIX, 0).try_cast("double")


def lower_contains(col: Column, needle: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(col).contains(needle.lower())
