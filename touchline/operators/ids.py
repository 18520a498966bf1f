"""Surrogate ids."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.operators.joins import fits_broadcast, lookup
from touchline.schemas import MEASURES, ROW_ORDER
from touchline.session import materialise

_SLOT_BITS = 33  # monotonically_increasing_id: partition above, row within the partition below


def dense_ids(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """Number the rows of ``df`` from ``start`` on in the given order, without a global window.

    ``order`` must tell any two rows apart. The rows are range-partitioned, sorted in place and
    written with their partition and position. What remains is one running total over the
    partitions, a table of at most ``spark.sql.shuffle.partitions`` rows. Writing first matters:
    the counts and the positions must come from one and the same partitioning.
    """
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id()),
        f"order-{name}",
    )
    part = F.shiftright("_slot", _SLOT_BITS).alias("_part")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part)
        .agg(F.count("*").alias("_rows"))
        .select("_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) + start).alias("_offset"))
    )
    position = F.col("_slot").bitwiseAND((1 << _SLOT_BITS) - 1)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position)
        .drop("_part", "_offset", "_slot")
    )


def label_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct ``(kind, value)`` over several label columns in one pass over ``df``.

    The combinations are reduced inside each task first, so a label that fills a third of all rows
    leaves a task only once.
    """
    pairs = F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in columns))
    return df.select(*columns).distinct().select(F.inline(pairs)).distinct()


def assign_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Codebook ``(kind, value, code)``: rank of each value in its column, from 0, null is -1.

    All columns are ranked in one go: ids over ``(kind, value)`` minus the first id of the kind.
    """
    return materialise(_ranked_codes(label_values(df, columns)), "codes")


def assign_codes_stable(df: DataFrame, columns: Sequence[str], known: DataFrame) -> DataFrame:
    """As :func:`assign_codes`, but values in the codebook ``known`` keep their code.

    New values are appended after the highest code of their column, in sorted order.
    """
    same = F.col("new.kind").eqNullSafe(F.col("old.kind")) & F.col("new.value").eqNullSafe(F.col("old.value"))
    new = label_values(df, columns).alias("new").join(known.alias("old"), same, "left_anti")
    highest = known.groupBy("kind").agg((F.max("code") + 1).alias("_next"))
    book = known.select("kind", "value", "code").unionByName(_ranked_codes(new, highest))
    return materialise(book, "codes")


def _ranked_codes(values: DataFrame, highest: DataFrame | None = None) -> DataFrame:
    # Nulls sort first. They take part in the numbering and are set to -1 afterwards.
    ranked = dense_ids(values, ["kind", "value"], "_id")
    value = F.col("value")
    first = ranked.groupBy("kind").agg(F.min(F.when(value.isNotNull(), F.col("_id"))).alias("_first"))
    if highest is None:
        first = first.withColumn("_next", F.lit(0))
    else:
        first = first.join(highest, "kind", "left")
    code = F.col("_id") - F.col("_first") + F.coalesce("_next", F.lit(0))
    # `first` has one row per label column.
    return ranked.join(F.broadcast(first), "kind").select(
        "kind", "value", F.when(value.isNull(), -1).otherwise(code).cast("int").alias("code")
    )


def codes_of(book: DataFrame, column: str, key: str) -> DataFrame:
    """The dimension rows ``(key, column)`` of one label column."""
    return book.where(F.col("kind") == column).select(
        F.col("code").alias(key), F.col("value").alias(column)
    )


def attach_codes(
    df: DataFrame, book: DataFrame, keys: Mapping[str, str], small: bool | None = None
) -> DataFrame:
    """Add the key column of every label column in ``keys``; a null label gets -1.

    ``small`` tells whether the codebook may be broadcast; it is measured if not given.
    """
    if small is None:
        small = fits_broadcast({"book": book})["book"]
    rows = df
    for column, key in keys.items():
        dim = codes_of(book, column, key).where(F.col(column).isNotNull())
        rows = lookup(rows, dim, column, "left", small, counted=df)
    return rows.withColumns(
        {key: F.when(F.col(column).isNull(), -1).otherwise(F.col(key)) for column, key in keys.items()}
    )


def order_key(order: Sequence[str] = ROW_ORDER) -> Column:
    return F.struct(*order)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``, ties go to the smallest remaining columns.

    Rows are reduced inside each task before the shuffle.
    """
    return _keep(df, keys, order, F.min)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order``, ties go to the greatest remaining columns."""
    return _keep(df, keys, order, F.max)


def _keep(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], pick: Callable[[Column], Column]
) -> DataFrame:
    # Structs compare field by field, so the order columns come first.
    leading = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in leading]
    if not leading + rest:
        return df.distinct()
    kept = df.groupBy(*keys).agg(pick(F.struct(*leading, *rest)).alias("_row"))
    return kept.select(*keys, "_row.*").select(*df.columns)


def stat_line_ids(df: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """``(stat_line, pstatistics_id)``: distinct measure tuples numbered by first appearance."""
    lines = (
        df.groupBy(line_hash(), *MEASURES)
        .agg(F.min(order_key(order)).alias("_at"))
        .select(*MEASURES, *(F.col(f"_at.{c}").alias(f"_at_{c}") for c in order))
    )
    at = [f"_at_{c}" for c in order]
    numbered = dense_ids(lines, [*at, *MEASURES], "pstatistics_id")
    return numbered.select(F.struct(*MEASURES).alias("stat_line"), "pstatistics_id")


def line_hash() -> Column:
    """A leading group key that settles nearly every comparison of two measure tuples."""
    return F.xxhash64(*MEASURES).alias("_line")


def factorize_stat_line(
    df: DataFrame, order: Sequence[str] = ROW_ORDER, small: bool | None = None
) -> DataFrame:
    """Give every row the number of its measure tuple.

    The tuple is one struct, so nulls inside it compare equal. One tuple may hold a large share of
    the rows (players who never played); the lookup deals such rows out.
    """
    ids = materialise(stat_line_ids(df, order), "stat-lines")
    rows = df.withColumn("stat_line", F.struct(*MEASURES))
    if small is None:
        small = fits_broadcast({"ids": ids})["ids"]
    return lookup(rows, ids, "stat_line", "inner", small).drop("stat_line")
