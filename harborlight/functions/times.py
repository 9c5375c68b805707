"""RFC 3339 parsing and formatting, durations, time bounds."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: RFC 3339 date-time with an optional fraction.
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{1,2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}:\d{2})$"

# Fixed value: how the zero time prints.
ZERO_TIME_TEXT = "0001-01-01T00:00:00Z"

# Duration units in seconds.
_DURATION_UNITS = {"h": 3600.0, "m": 60.0, "s": 1.0, "ms": 1e-3, "us": 1e-6, "µs": 1e-6, "ns": 1e-9}
_DURATION_PART = re.compile(r"(\d+\.?\d*|\.\d+)(h|ms|m|s|us|µs|ns)")


def parse_rfc3339(text: Column) -> Column:
    """Timestamp of an RFC 3339 text, NULL for anything else.

    The pattern guard is needed because the built-in parser also accepts bare
    dates and other shorthand.
    """
    return F.when(text.rlike(RFC3339), F.try_to_timestamp(F.translate(text, ",", ".")))


def parse_object_time(text: Column) -> Column:
    """As :func:`parse_rfc3339`, with the zero time counting as missing."""
    return F.when(text != ZERO_TIME_TEXT, parse_rfc3339(text))


def rfc3339_text(ts: Column) -> Column:
    """UTC text with trailing fraction zeros cut, as used in identities."""
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def parse_duration(text: str) -> dt.timedelta:
    """``"1h30m"``, ``"1.5h"``, ``"500ms"``, ``"-2s"``, ``"0"``; anything else is a ValueError."""
    sign, body = (-1, text[1:]) if text.startswith("-") else (1, text.removeprefix("+"))
    if body == "0":
        return dt.timedelta()
    parts = _DURATION_PART.findall(body)
    if not parts or "".join(n + u for n, u in parts) != body:
        raise ValueError(f"invalid duration {text!r}; use sums such as 1h30m, 1.5h or 500ms")
    return dt.timedelta(seconds=sign * sum(float(n) * _DURATION_UNITS[u] for n, u in parts))


def utc(moment: dt.datetime) -> dt.datetime:
    """Aware UTC datetime; naive values are taken as UTC."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=dt.timezone.utc)
    return moment.astimezone(dt.timezone.utc)


def instant(moment: dt.datetime) -> Column:
    """A timestamp literal that does not depend on the driver's time zone."""
    micros = (utc(moment) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(
        microseconds=1
    )
    return F.timestamp_micros(F.lit(micros))


def resolve_since(
    since: dt.datetime | None,
    lookback: str | None,
    as_of: dt.datetime | None,
    default_lookback: str | None = None,
) -> dt.datetime | None:
    """Explicit ``since`` wins over ``lookback``, which wins over the default."""
    if since is not None:
        return utc(since)
    text = lookback or default_lookback
    if not text:
        return None
    now = utc(as_of) if as_of is not None else dt.datetime.now(dt.timezone.utc)
    return now - parse_duration(text)


def within(ts: Column, since: dt.datetime | None, until: dt.datetime | None) -> Column | None:
    """Inclusive range predicate, or None when no bound is set."""
    bound: Column | None = None
    if since is not None:
        bound = ts >= instant(since)
    if until is not None:
        upper = ts <= instant(until)
        bound = upper if bound is None else bound & upper
    return bound
