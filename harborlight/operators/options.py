"""Checks on user options. Wrong input raises instead of meaning "no filter"."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Fixed value: a DNS label.
_DNS_LABEL = re.compile(r"^[a-z0-9]([-a-z0-9]{0,61}[a-z0-9])?$")
_LABEL_WORD = r"[^=!<>(),\s]+"
_LABEL_TERMS = {
    "in": re.compile(rf"^({_LABEL_WORD})\s*==?\s*({_LABEL_WORD}|)$"),
    "notin": re.compile(rf"^({_LABEL_WORD})\s*!=\s*({_LABEL_WORD}|)$"),
    "exists": re.compile(rf"^({_LABEL_WORD})$"),
    "absent": re.compile(rf"^!\s*({_LABEL_WORD})$"),
}
_LABEL_SET = re.compile(rf"^({_LABEL_WORD})\s+(in|notin)\s*\(([^()]*)\)$")
_OUTSIDE_SETS = re.compile(r",(?![^()]*\))")

# The ways audit entries can be collected.
AUDIT_METHODS = ["file", "apiserver", "daemonset"]


def non_negative(name: str, value: int | None) -> int | None:
    if value is not None and value < 0:
        raise ValueError(f"{name} cannot be negative")
    return value


def audit_method(method: str | None) -> str | None:
    if not method:
        return None
    if method not in AUDIT_METHODS:
        raise ValueError(f"invalid method {method!r}: must be one of {', '.join(AUDIT_METHODS)}")
    return method


def namespace_list(namespaces: str | Iterable[str] | None) -> list[str]:
    """A comma list or an iterable; names are trimmed and checked; [] means no filter."""
    if namespaces is None:
        return []
    items = namespaces.split(",") if isinstance(namespaces, str) else list(namespaces)
    names = [n.strip() for n in items if n.strip()]
    for name in names:
        if name != "*" and not _DNS_LABEL.match(name):
            raise ValueError(f"invalid namespace {name!r}")
    return names


def pattern(name: str, regex: str | None) -> str | None:
    """A search pattern, or None.

    The engine that will run the pattern checks it, so a typo fails before the job and
    everything that engine knows is accepted.
    """
    if not regex:
        return None
    spark = SparkSession.getActiveSession()
    if spark is not None:
        try:
            spark.range(1).select(F.lit("").rlike(regex)).collect()
        except Exception as err:
            if "PATTERN" not in str(err) and "PatternSyntaxException" not in str(err):
                raise
            raise ValueError(f"invalid {name} {regex!r}: {err}") from err
    return regex


def label_terms(selectors: str | Sequence[str] | None) -> list[tuple[str, str, list[str]]]:
    """Terms (key, test, values) that must all hold, comma-joined or listed.

    ``key=value``, ``key==value``, ``key!=value``, ``key in (a, b)``, ``key notin (a, b)``,
    ``key`` (present) and ``!key`` (absent); the tests are in, notin, exists, absent.
    """
    if not selectors:
        return []
    text = selectors if isinstance(selectors, str) else ",".join(selectors)
    terms = []
    for term in (t.strip() for t in _OUTSIDE_SETS.split(text)):
        listed = _LABEL_SET.match(term)
        if listed:
            values = [v.strip() for v in listed[3].split(",")]
            terms.append((listed[1], listed[2], values))
            continue
        for test, form in _LABEL_TERMS.items():
            found = form.match(term)
            if found:
                terms.append((found[1], test, list(found.groups()[1:])))
                break
        else:
            raise ValueError(f"invalid label selector {term!r}")
    return terms
