"""Rendezvous hashing of record keys over weighted shards.

Every shard draws a number for every key; the key goes to the shard with the best draw. A draw
depends on the key and the shard alone, so one more shard takes rows only into itself and one shard
less gives up only its own rows. With ``u`` uniform in (0, 1), ``-w / ln(u)`` wins with a chance in
proportion to the weight ``w``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.common import table
from touchline.session import materialise

SHARDS = 24
_SLOT_BITS = 33  # monotonically_increasing_id: partition above, row within the partition below
_UNIT = 2.0**-53


def equal_weights(shards: int) -> dict[int, float]:
    return {shard: 1.0 for shard in range(shards)}


def _draw(key: Sequence[Column], shard: int, weight: float) -> Column:
    """The draw of one shard. The hash keeps its upper 53 bits, which a double holds exactly."""
    bits = F.shiftrightunsigned(F.xxhash64(*key, F.lit(shard).cast("long")), 11)
    return F.lit(-float(weight)) / F.log((bits.cast("double") + 0.5) * F.lit(_UNIT))


def rendezvous(key: Sequence[str], weights: Mapping[int, float]) -> Column:
    """The shard of a key; of equal draws the smallest shard number wins.

    Null key parts are values like any other: all rows without a key share a shard. Shards of
    weight 0 or less get nothing.
    """
    columns = [F.col(name) for name in key]
    draws = [
        F.struct(_draw(columns, shard, weight).alias("draw"), F.lit(-shard).alias("back"))
        for shard, weight in weights.items()
        if weight > 0
    ]
    if not draws:
        raise ValueError("no shard has a weight above 0")
    best = F.greatest(*draws) if len(draws) > 1 else draws[0]
    return (-best["back"]).cast("int")


def assign_shards(
    df: DataFrame, key: Sequence[str], weights: Mapping[int, float], name: str = "shard"
) -> DataFrame:
    """``df`` with its shard; a projection, no row moves."""
    return df.withColumn(name, rendezvous(key, weights))


def number_slots(df: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Number the rows of every shard from 0 without gaps, and without a task that sees a whole shard.

    The rows are written once with the partition they came in; a row's slot is its position among
    the rows of its shard in that partition plus the shard's rows in the partitions before. Only
    the counts by partition and shard are summed up. The largest group that is sorted in one place
    is what one input split holds of a shard, however hot a key is. Slots follow the input's order,
    so a rerun over the same files and splits gives the same slots. An empty table stays empty; a
    column that is already named like the slot is replaced.
    """
    placed = materialise(
        df.select(
            F.struct(*[F.col(c) for c in df.columns if c.lower() != slot.lower()]).alias("_row"),
            F.col(shard).alias("_shard"),
            F.monotonically_increasing_id().alias("_at"),
        ),
        "slots",
    ).withColumn("_part", F.shiftright("_at", _SLOT_BITS))
    before = W.partitionBy("_shard").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part", "_shard")
        .agg(F.count("*").alias("_rows"))
        .select("_part", "_shard", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    within = W.partitionBy("_part", "_shard").orderBy("_at")
    return (
        placed.withColumn("_within", F.row_number().over(within) - 1)
        .join(offsets, ["_part", "_shard"])
        .select("_row.*", (F.col("_before") + F.col("_within")).alias(slot))
    )


def write_shards(df: DataFrame, path: str, shard: str = "shard", files_per_shard: int = 1) -> None:
    """Write one folder per shard with ``files_per_shard`` files, rows dealt over them by their hash."""
    piece = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(files_per_shard))
    shards = df.select(shard).distinct().count()
    (
        df.withColumn("_piece", piece)
        .repartition(max(1, shards * files_per_shard), shard, "_piece")
        .drop("_piece")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(shard)
        .parquet(path)
    )


def op1_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 24 equal shards, and where they go with one shard more.

    Law ``key``: doc_id and the number of shards decide. A null text counts no bytes (size 8, check
    sum 0); rows without doc_id share one shard; repeated rows each keep a slot of their own.
    """
    text = F.coalesce("text", F.lit(""))
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = assign_shards(documents, ["doc_id"], equal_weights(SHARDS))
    placed = assign_shards(placed, ["doc_id"], equal_weights(SHARDS + 1), "grown_shard")
    return number_slots(placed)
