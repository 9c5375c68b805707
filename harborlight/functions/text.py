"""Whitespace rules for log text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_space(text: Column) -> Column:
    """Strip Unicode white space from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    return F.octet_length(F.ltrim(text, F.lit(WHITE_SPACE))) == 0


def starts_with_brace(text: Column) -> Column:
    return F.ltrim(text, F.lit(WHITE_SPACE)).startswith("{")


def or_empty(text: Column) -> Column:
    """NULL as the empty string, the way membership filters compare."""
    return F.coalesce(text, F.lit(""))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
