"""Joining a large table to a keyed one without betting on the keyed one being small."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# A key is "hot" from this share of the rows on, so there can be at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001


def _leaf_bytes(value: Column, kind: T.DataType) -> list[Column]:
    if isinstance(kind, T.StructType):
        return [b for f in kind for b in _leaf_bytes(value[f.name], f.dataType)]
    if isinstance(kind, T.StringType):
        return [F.coalesce(F.octet_length(value), F.lit(0)) + 16]
    return [F.lit(16)]


def _size(keyed: DataFrame, name: str) -> DataFrame:
    row = sum((b for f in keyed.schema for b in _leaf_bytes(F.col(f.name), f.dataType)), F.lit(0))
    return keyed.agg(F.lit(name).alias("name"), F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("bytes"))


def fits_broadcast(tables: Mapping[str, DataFrame], limit: int = MAX_BROADCAST_BYTES) -> dict[str, bool]:
    """Which of these stored tables are small enough to broadcast, measured in one job.

    The size is text lengths plus 16 bytes per field and row.
    """
    sizes = reduce(DataFrame.unionByName, (_size(df, name) for name, df in tables.items()))
    return {row["name"]: row["bytes"] <= limit for row in sizes.collect()}


def lookup(
    rows: DataFrame,
    keyed: DataFrame,
    on: str,
    how: str = "inner",
    small: bool = False,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` to ``keyed``, whose ``on`` values are unique.

    A table that :func:`fits_broadcast` found ``small`` is broadcast and ``rows`` stays where it is.
    Any other one is shuffled, with hot keys spread over all partitions; see :func:`spread_join`.
    """
    if small:
        return rows.join(F.broadcast(keyed), on, how)
    return spread_join(rows, keyed, on, how, counted)


def hot_hashes(rows: DataFrame, key: str) -> list[int]:
    """Hashes of the keys that fill at least ``HOT_SHARE`` of ``rows``: at most ``1 / HOT_SHARE``.

    One pass over the key column with a bounded buffer per task. It may name a few keys too many,
    never one too few; the list steers the work only and has no part in the result.
    """
    hashes = rows.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h"))
    return hashes.freqItems(["h"], HOT_SHARE).first()[0] or []


def spread_join(
    rows: DataFrame, keyed: DataFrame, on: str, how: str = "inner", counted: DataFrame | None = None
) -> DataFrame:
    """Shuffle join that deals the rows of a hot key out to many partitions.

    Rows of a hot key get a salt, the one matching row of ``keyed`` is repeated for every salt.
    Other keys keep salt 0, so ``keyed`` grows by no more than hot keys times salts. The salt comes
    from the row's content and its partition: a task that is run again deals the same way, and
    identical copies in different partitions are dealt apart. Rows with a null key match nothing
    and are dealt out as well. Keys are told hot by hash; a key that shares the hash of a hot one is
    merely salted too. ``counted`` names a cheaper table to find hot keys in, such as ``rows`` before
    other joins.
    """
    hot = hot_hashes(rows if counted is None else counted, on)

    def _hash_first(df: DataFrame) -> DataFrame:
        # Sorting by a number settles nearly every comparison before the key itself is looked at.
        return df.withColumn("_hash", F.xxhash64(on))

    if not hot and how == "inner":
        return _hash_first(rows).join(_hash_first(keyed), ["_hash", on]).drop("_hash")
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.xxhash64(on).isin(hot) if hot else F.lit(False)
    content = [F.col(c) for c in rows.columns if c != on]
    dealt = F.pmod(F.xxhash64(*content, F.spark_partition_id()), F.lit(salts)).cast("int")
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    left = rows.withColumn("_salt", F.when(F.col(on).isNull() | is_hot, dealt).otherwise(0))
    right = keyed.withColumn("_salt", F.explode(F.when(is_hot, every_salt).otherwise(F.array(F.lit(0)))))
    return _hash_first(left).join(_hash_first(right), ["_hash", "_salt", on], how).drop("_hash", "_salt")
