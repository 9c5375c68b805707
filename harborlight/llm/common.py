"""Column helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlight.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANK_RUN = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
#: ASCII characters that are neither letters nor digits
NON_ALNUM_RUN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; pure ASCII takes the quick way, with the same result."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def blank_words(text: Column) -> Column:
    """Maximal runs of characters other than space, tab, line feeds and returns."""
    return F.array_remove(F.split(text, BLANK_RUN), "")


def alnum_words(text: Column) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters, letters as written."""
    return F.array_remove(F.split(text, NON_ALNUM_RUN), "")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again, which cuts its lineage."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: a joined side is only broadcast when its stored rows were counted and are no more
BROADCAST_ROWS = 200_000


def checked(small: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``small``, a stored table of narrow rows, marked for broadcast if it is small indeed."""
    return F.broadcast(small) if small.count() <= most_rows else small.hint("merge")
