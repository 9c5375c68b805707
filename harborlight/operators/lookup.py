"""N:1 lookups that broadcast only what was measured to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlight.operators.winners import stored

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# When the file a landed object comes from was written.
FILE_TIME = "file_time"

#: hashes of keys, eight bytes each, that are sent to every task
MAX_BROADCAST_KEYS = 2_000_000

_SALT = "_salt"
_KEY_HASH = "_key_hash"
_VERSION = "_version"


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Count rows and serialized bytes in one map-side aggregation."""
    rows, size = (
        df.select(F.octet_length(F.to_json(F.struct("*"))).alias("b"))
        .agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0)))
        .first()
    )
    return rows <= max_rows and size <= max_bytes


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    broadcast: bool,
    salts: int = 1,
) -> DataFrame:
    """Inner join on unique lookup keys.

    Without the broadcast both sides are shuffled on the keys, whatever Spark estimates: the
    estimate does not see how rows grow by parsing and exploding, and would broadcast them
    through the driver.  AQE then splits the partitions of a hot key on the fact side, in
    batch jobs and stateless streams; where there is no AQE every key can be spread over
    ``salts`` tasks instead, each with its own copy of the lookup row.
    """
    if broadcast:
        return facts.join(F.broadcast(lookup), list(keys))
    lookup = lookup.hint("merge")
    if salts <= 1:
        return facts.join(lookup, list(keys))
    copies = lookup.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = facts.withColumn(
        _SALT, F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
    )
    return spread.join(copies.hint("merge"), [*keys, _SALT]).drop(_SALT)


def reduced(facts: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``facts`` without most rows that a later join with ``lookup`` on ``keys`` would drop.

    Only hashes of the keys are sent out, so many more keys fit than rows with attributes; a
    row whose key merely shares a hash is left to the join.  Beyond ``MAX_BROADCAST_KEYS`` keys
    nothing is dropped here.
    """
    hashes = stored(lookup.select(F.xxhash64(*keys).alias(_KEY_HASH)).distinct(), "lookup-keys")
    if hashes.count() > MAX_BROADCAST_KEYS:
        return facts
    hashed = facts.withColumn(_KEY_HASH, F.xxhash64(*keys))
    return hashed.join(F.broadcast(hashes), _KEY_HASH, "left_semi").drop(_KEY_HASH)


def newest(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """One row per key, the one that is last by ``order``.

    The rank is limited on the map side first, so a key with very many versions sends
    one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*[o.desc_nulls_last() for o in order])
    ranked = df.withColumn(_VERSION, F.row_number().over(window))
    return ranked.where(F.col(_VERSION) == 1).drop(_VERSION)


def version_order(df: DataFrame, resource_version: Column, text: Column) -> list[Column]:
    """Time of the dump where it is known, then the object's version, then its text."""
    dumped = [F.col(FILE_TIME)] if FILE_TIME in df.columns else []
    return [*dumped, resource_version.try_cast("decimal(38,0)"), F.xxhash64(text)]
