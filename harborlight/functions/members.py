"""Members of JSON objects, parsed on demand.

Expressions are built before the parse: each tells which members of the object it reads,
and only those are declared to the parser, which skips all others without building them.
What nobody asks for is neither decoded nor allocated, however large the object is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlight.functions.strict_json import (
    parse_objects,
    pick,
    pick_number,
    strict_str_array,
    text_at,
    texts_at,
    variants_at,
    whole,
)

Builders = Mapping[str, Callable[[], Column]]


@lru_cache(maxsize=64)
def _declared(fields: str) -> T.StructType:
    return T.StructType.fromDDL(fields)


def pruned(fields: str, paths: Iterable[str]) -> str:
    """The DDL of ``fields`` with only the members on ``paths``, in declared order."""

    def keep(struct: T.StructType, wanted: list[list[str]]) -> T.StructType:
        kept = []
        for field in struct:
            below = [p[1:] for p in wanted if p[0] == field.name]
            if below:
                whole_member = any(not p for p in below)
                kind = field.dataType if whole_member else keep(field.dataType, below)
                kept.append(T.StructField(field.name, kind))
        return T.StructType(kept)

    found = keep(_declared(fields), [p.split(".") for p in paths])
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found)


class Members:
    """Reads members of the object in column ``doc`` and remembers which.

    ``source`` names the JSON text.  ``below`` is a member that wraps the object.  Members
    named in ``opened`` are kept as VARIANT values as a whole, and what is read below them
    comes out of those, so that one parse serves both.
    """

    def __init__(self, fields: str, source: str, below: str = "", opened: Sequence[str] = ()) -> None:
        self.fields, self.source, self.below, self.opened = fields, source, below, opened
        self.asked: dict[str, None] = {}

    @property
    def root(self) -> str:
        return f"doc.{self.below}" if self.below else "doc"

    def _ask(self, path: str) -> tuple[Column, str] | None:
        """The VARIANT value that holds ``path`` and the rest of the path, if it is kept open."""
        first, _, rest = path.partition(".")
        if first in self.opened:
            self.asked[first] = None
            return F.col(f"{self.root}.{first}"), rest
        self.asked[path] = None
        return None

    def raw(self, path: str) -> Column:
        self._ask(path)
        return F.col(f"{self.root}.{path}")

    def text(self, path: str) -> Column:
        """The member if it is a JSON string, else NULL."""
        opened = self._ask(path)
        if opened:
            return pick(*opened)
        return text_at(self.root, path, self.source, below=self.below)

    def texts(self, path: str) -> Column:
        """The string elements of an array member; NULL if there are none."""
        opened = self._ask(path)
        if opened:
            return strict_str_array(_array(*opened))
        return texts_at(self.root, path, self.source)

    def count(self, path: str) -> Column:
        """A number as INT."""
        opened = self._ask(path)
        return whole(pick_number(*opened) if opened else F.col(f"{self.root}.{path}"))

    def variants(self, path: str) -> Column:
        """The elements of an array member with their types."""
        opened = self._ask(path)
        return _array(*opened) if opened else variants_at(path, self.source)

    def is_open(self, path: str) -> bool:
        return path.partition(".")[0] in self.opened

    def declared(self) -> str:
        """DDL of what was asked for."""
        first = {p.partition(".")[0] for p in self.asked} & set(self.opened)
        closed = pruned(self.fields, [p for p in self.asked if p not in first])
        fields = ", ".join([*([closed] if closed else []), *(f"{m} variant" for m in sorted(first))])
        return f"{self.below} struct<{fields}>" if self.below else fields


def _array(value: Column, path: str) -> Column:
    return F.try_variant_get(value, f"$.{path}", "array<variant>")


def chosen(builders: Builders, columns: Sequence[str] | None) -> dict[str, Column]:
    """The built expressions of ``columns``, or of all."""
    names = list(builders) if columns is None else [c for c in builders if c in set(columns)]
    return {name: builders[name]() for name in names}


def parse(lines: DataFrame, members: Members, more: str = "") -> DataFrame:
    """``lines`` with ``doc``, holding the members asked for so far; ``more`` are further fields."""
    fields = ", ".join(x for x in (members.declared(), more) if x)
    return parse_objects(lines, F.col(members.source), fields)


def with_sources(columns: Iterable[str], sources: Mapping[str, Sequence[str]]) -> set[str]:
    """``columns`` and, transitively, the columns they are computed from."""
    found: set[str] = set()
    waiting = list(columns)
    while waiting:
        column = waiting.pop()
        if column not in found:
            found.add(column)
            waiting += sources.get(column, ())
    return found
