"""JSON decoding that keeps value types apart.

A field counts only when its JSON value has the expected type: the number 5 in
a text field is "missing", not ``"5"``.  ``from_json`` turns any value of a
STRING leaf into text, but that text tells most strings apart: only text that
reads as a number, a boolean, an object or an array can have been something
else.  :func:`text_at` looks those few up again with their types; all other
leaves cost one comparison.  Numbers, booleans and nested objects are declared
with their own types, which ``from_json`` already treats strictly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reject what the JSON grammar rejects.
_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def json_docs(text: Column, fields: str) -> Column:
    """Parse ``text`` as an array of its top-level objects.

    The text is wrapped in brackets, so trailing words or a second document
    make the array invalid (NULL) or longer than one: both mean "not one
    object".  ``fields`` is the DDL of the wanted members; others are skipped
    without being built.
    """
    return F.from_json(
        F.concat(F.lit("["), text, F.lit("]")), f"array<struct<{fields}>>", _OPTIONS
    )


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Append columns whose expressions are computed exactly once per row.

    A plain projection is inlined into every later filter, which would re-parse
    the same line for each predicate.  A one-row generator is not, and still
    lets predicates on the other columns move below it.
    """
    struct = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(struct)))


def parse_objects(df: DataFrame, text: Column, fields: str, into: str = "doc") -> DataFrame:
    """Add struct column ``into``; rows that are not exactly one object are dropped."""
    docs = f"_{into}_docs"
    return (
        evaluate_once(df, **{docs: json_docs(text, fields)})
        .where((F.size(docs) == 1) & F.get(F.col(docs), F.lit(0)).isNotNull())
        .withColumn(into, F.get(F.col(docs), F.lit(0)))
        .drop(docs)
    )


# Fixed value: the JSON number grammar.
JSON_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?$"


def _reads_as_other_sql(leaf: str) -> str:
    # range comparisons on the first character: ordinary text is passed without
    # looking at the rest
    return f"""(({leaf} >= '0' AND {leaf} < ':' OR {leaf} >= '-' AND {leaf} < '.')
            AND {leaf} RLIKE r'{JSON_NUMBER}'
        OR {leaf} >= '[' AND {leaf} < r'\\' OR {leaf} >= '{{' AND {leaf} < '|'
        OR {leaf} IN ('true', 'false'))"""


def reads_as_other(leaf: Column) -> Column:
    """The text could come from a JSON value that is not a string."""
    number = ((leaf >= "0") & (leaf < ":")) | ((leaf >= "-") & (leaf < "."))
    nested = ((leaf >= "[") & (leaf < "\\")) | ((leaf >= "{") & (leaf < "|"))
    return (number & leaf.rlike(JSON_NUMBER)) | nested | leaf.isin("true", "false")


def _typed_again_sql(source: str, path: str, ddl_type: str) -> str:
    """The member at ``path`` of the one object in column ``source``, parsed on its own."""
    *parents, name = path.split(".")
    ddl = f"{name} {ddl_type}"
    for parent in reversed(parents):
        ddl = f"{parent} struct<{ddl}>"
    options = ", ".join(f"'{k}', '{v}'" for k, v in _OPTIONS.items())
    docs = f"from_json(concat('[', {source}, ']'), 'array<struct<{ddl}>>', map({options}))"
    return f"get({docs}, 0).{path}"


def text_at(doc: str, path: str, source: str, below: str = "") -> Column:
    """Text leaf ``path`` of struct column ``doc`` if its JSON value is a string, else NULL.

    ``source`` names the JSON text ``doc`` was parsed from; ``below`` is the
    member of it that ``doc`` stands for.
    """
    leaf = f"{doc}.{path}"
    again = _typed_again_sql(source, f"{below}.{path}" if below else path, "variant")
    return F.expr(
        f"""CASE WHEN {_reads_as_other_sql(leaf)}
            THEN CASE WHEN schema_of_variant({again}) = 'STRING'
                THEN CAST({again} AS STRING) END
            ELSE {leaf} END"""
    )


def texts_at(doc: str, path: str, source: str) -> Column:
    """The string elements of an ``array<string>`` leaf, in order; NULL if there are none."""
    items = F.col(f"{doc}.{path}")
    plain = F.filter(items, lambda s: s.isNotNull())
    again = strict_str_array(variants_at(path, source))
    odd = F.expr(f"exists({doc}.{path}, s -> {_reads_as_other_sql('s')})")
    return F.when(odd, again).when(F.size(plain) > 0, plain)


def variants_at(path: str, source: str) -> Column:
    """An array member with its element types, whatever they are."""
    return F.expr(_typed_again_sql(source, path, "array<variant>"))


def strict_str(leaf: Column) -> Column:
    """A VARIANT leaf as text if it is a JSON string, else NULL."""
    return F.when(F.schema_of_variant(leaf) == "STRING", leaf.cast("string"))


def pick(value: Column, path: str) -> Column:
    """A member of a VARIANT value, as text if it is a JSON string."""
    return strict_str(F.try_variant_get(value, f"$.{path}", "variant"))


def pick_bool(value: Column, path: str) -> Column:
    member = F.try_variant_get(value, f"$.{path}", "variant")
    return F.when(F.schema_of_variant(member) == "BOOLEAN", member.cast("boolean"))


def pick_number(value: Column, path: str) -> Column:
    """A numeric member of a VARIANT value as DOUBLE, else NULL."""
    member = F.try_variant_get(value, f"$.{path}", "variant")
    kind = F.schema_of_variant(member)
    numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return F.when(numeric, F.try_variant_get(value, f"$.{path}", "double"))


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def whole(number: Column) -> Column:
    """A DOUBLE truncated to INT; NULL when missing or out of range."""
    return number.try_cast("int")


def strict_str_array(items: Column) -> Column:
    """The string elements of an ``array<variant>``, in order; NULL if there are none."""
    texts = F.filter(F.transform(items, strict_str), lambda s: s.isNotNull())
    return F.when(F.size(texts) > 0, texts)
