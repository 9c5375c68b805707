"""Log level extraction: JSON member, then key=value text, then a word in the text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from harborlight.functions.strict_json import json_docs, reads_as_other, strict_str
from harborlight.functions.text import empty_to_null, starts_with_brace, trim_space

# The member names a JSON line may carry its level in, in order.
JSON_LEVEL_KEYS = ["level", "lvl", "severity", "log_level", "loglevel"]

# Fixed value: level in key=value text. The look-behind is an ASCII word
# boundary, so "log_level=" does not match.
LOGFMT_LEVEL = (
    r"(?<![0-9A-Za-z_])(?:level|lvl|severity)[\t\n\f\r ]*=[\t\n\f\r ]*([^\t\n\f\r ]+)"
)

# Words searched in upper-cased text, in order, and what they mean.
LEVEL_WORDS = [
    ("FATAL", "FATAL"),
    ("ERROR", "ERROR"),
    ("WARN", "WARN"),
    ("WARNING", "WARN"),
    ("INFO", "INFO"),
    ("DEBUG", "DEBUG"),
    ("TRACE", "TRACE"),
]
DEFAULT_LEVEL = "INFO"

_LEVEL_FIELDS = ", ".join(f"{k} string" for k in JSON_LEVEL_KEYS)
_TYPED_FIELDS = ", ".join(f"{k} variant" for k in JSON_LEVEL_KEYS)


def level_docs(message: Column) -> Column:
    """The level members of a message that is a JSON object, else NULL."""
    return F.when(starts_with_brace(message), json_docs(trim_space(message), _LEVEL_FIELDS))


def level_from_json(docs: Column, message: Column) -> Column:
    """First key holding a string decides; an empty string decides "none".

    ``docs`` is :func:`level_docs` of the message.  Values that do not read as
    plain text are looked up again with their types.
    """
    doc = F.get(docs, F.lit(0))
    leaves = [doc[k] for k in JSON_LEVEL_KEYS]
    typed = F.get(json_docs(trim_space(message), _TYPED_FIELDS), F.lit(0))
    odd = reduce(lambda a, b: a | b, [F.coalesce(reads_as_other(x), F.lit(False)) for x in leaves])
    level = F.when(odd, F.coalesce(*[strict_str(typed[k]) for k in JSON_LEVEL_KEYS])).otherwise(
        F.coalesce(*leaves)
    )
    return F.when(F.size(docs) == 1, empty_to_null(F.upper(level)))


def level_from_logfmt(message: Column) -> Column:
    # most lines have no "=", and the byte search is far cheaper than the pattern
    raw = F.when(F.contains(message, F.lit("=")), F.regexp_extract(message, LOGFMT_LEVEL, 1))
    return empty_to_null(F.upper(F.btrim(raw, F.lit("\"'"))))


def level_from_words(message: Column) -> Column:
    shouted = F.upper(message)
    (word, level), *rest = LEVEL_WORDS
    found = F.when(F.contains(shouted, F.lit(word)), level)
    for word, level in rest:
        found = found.when(F.contains(shouted, F.lit(word)), level)
    return found.otherwise(DEFAULT_LEVEL)


def level_cascade(docs: Column, message: Column) -> Column:
    return F.coalesce(
        level_from_json(docs, message), level_from_logfmt(message), level_from_words(message)
    )
