"""Fill-in-the-middle: documents cut at two unit ends and rearranged around marks.

One ``fullmatch`` of ``(unit)*`` with the regex library keeps every repetition of the
group, so the ends of its captures give the number of units and both cut offsets at once.
The cuts, and whether and how a document is rearranged, follow from a digest of its id, so
they do not depend on partitioning, order or retries.

Prefix, middle and suffix are written as psm (prefix, suffix, middle) or spm (suffix,
prefix, middle), each behind its mark.  A text that holds a mark, or is empty, stays plain;
marks are therefore unambiguous, and :func:`restored` is exact.

Work is row by row in Arrow batches that are split by bytes; the only state of a task is the
text at hand, its captures (a few numbers per unit) and an output batch of about 4 MB.

Defined cases: a null text is empty, n = 0 and plain; a null id is digested as the empty
text after the seed; equal rows are transformed alike; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_BATCH_BYTES = 4 << 20


@dataclass(frozen=True)
class Infill:
    """How documents are cut: the unit, the digest's seed and two shares in percent."""

    unit: str = LINES
    seed: int = 7
    rearranged_percent: int = 100
    spm_percent: int = 50

    def draws(self, doc_id: int | None) -> tuple[int, int, int, int]:
        """Four unsigned 32-bit numbers from the digest of seed and id."""
        named = f"{self.seed}:{'' if doc_id is None else doc_id}"
        digest = hashlib.sha256(named.encode()).digest()
        return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def _cut(pattern, spec: Infill, doc_id: int | None, text: str) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    ends = pattern.fullmatch(text).ends(1)
    n = len(ends)
    first, second, share, order = spec.draws(doc_id)
    marked = PREFIX in text or SUFFIX in text or MIDDLE in text
    if not text or marked or share % 100 >= spec.rearranged_percent:
        return n, "plain", None, None, text
    low, high = sorted((first % (n + 1), second % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (low, high))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if order % 100 < spec.spm_percent:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, a, b - a, output


def infill(
    docs: DataFrame, spec: Infill = Infill(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (null if plain) and output per row."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string())]
        + [("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
    )

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pattern = regex.compile(f"({spec.unit})*+")
        rows, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                doc_id, text = doc_id.as_py(), text.as_py() or ""
                rows.append((doc_id, *_cut(pattern, spec, doc_id, text)))
                held += len(text)
                if held > _BATCH_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return docs.select(F.col(id_column).cast("long"), F.col(text_column)).mapInArrow(transform, OUTPUT)


def restored(output: Column, form: Column) -> Column:
    """The original text, rebuilt from output and form alone."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    second, third, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(second, middle, third))
        .when(form == "spm", F.concat(third, middle, second))
        .otherwise(output)
    )
