"""Insert-if-absent and last-record-wins, set-wise."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.ids import dense_ids, keep_first, keep_last
from touchline.operators.star import number_lines
from touchline.schemas import FACT, GRAIN_KEYS, KEY_ORDER, MEASURES
from touchline.session import materialise


def _same(keys: Sequence[str], null_safe: bool) -> Column:
    def same(key: str) -> Column:
        new, old = F.col(f"new.{key}"), F.col(f"old.{key}")
        return new.eqNullSafe(old) if null_safe else new == old

    return reduce(Column.__and__, map(same, keys))


def absent(
    incoming: DataFrame, current: DataFrame, keys: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Rows of ``incoming`` whose key ``current`` lacks.

    Keys without nulls can be compared plainly: rows that are already grouped by them then stay
    where they are.
    """
    old = current.select(*keys).alias("old")
    return incoming.alias("new").join(old, _same(keys, null_safe), "left_anti")


def insert_if_absent(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    null_safe: bool = True,
) -> DataFrame:
    """The rows to append: per new key the first incoming row; known keys stay as they are.

    ``order`` columns decide what is first and are dropped from the result. Duplicates are reduced
    inside each task before anything is shuffled, so the anti join sees one row per key.
    """
    first = keep_first(incoming, keys, order)
    return absent(first, current, keys, null_safe).select(*current.columns)


def scd1(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    null_safe: bool = True,
) -> DataFrame:
    """The whole new table: per key the last incoming row, else the current one.

    A full join by key, so that either side is read once.
    """
    rest = [c for c in current.columns if c not in keys]
    last = keep_last(incoming, keys, order).select(*keys, F.struct(*rest).alias("_row"))
    old = current.select(*keys, F.struct(*rest).alias("_row"))
    both = last.alias("new").join(old.alias("old"), _same(keys, null_safe), "full")
    return both.select(
        *(F.coalesce(f"new.{key}", f"old.{key}").alias(key) for key in keys),
        F.coalesce("new._row", "old._row").alias("_row"),
    ).select(*keys, "_row.*").select(*current.columns)


def prune_to(current: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Rows of ``current`` whose ``column`` is among ``values``; folders of other values are skipped.

    A semi join: Spark reads the values first and prunes the folders at run time, however many there
    are. ``values`` should be a stored table, so that its size is known to the planner.
    """
    wanted = values.where(F.col(column) >= -1)  # true for every key; tells Spark that pruning may pay
    return current.join(wanted, column, "left_semi").select(*current.columns)


def new_facts(touched: DataFrame, rows: DataFrame) -> DataFrame:
    """Fact rows to append, numbered from 0: grains that ``touched`` lacks.

    ``rows`` has one row per grain and is partitioned by it, so only the keys of ``touched`` move.
    """
    new = absent(rows, touched, GRAIN_KEYS, null_safe=False)
    return dense_ids(new, KEY_ORDER, "pstatistics_id").select(*FACT.names)


def new_lines(current: DataFrame, lines: DataFrame) -> DataFrame:
    """Fact rows to append, numbered from 0: measure tuples that ``current`` lacks.

    ``lines`` has one row per tuple. A stored tuple keeps its row and its id, whatever load it came
    with; tuples are compared as a whole, nulls included, with a hash leading.
    """
    line = lambda df: df.withColumns({"_line": F.xxhash64(*MEASURES), "_tuple": F.struct(*MEASURES)})
    new = line(lines).alias("new").join(line(current).alias("old"), _same(["_line", "_tuple"], True), "left_anti")
    return number_lines(new.drop("_line", "_tuple"))


def upserted_facts(touched: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What an upsert writes, as known and fresh rows: incoming rows win.

    Known grains keep their id, and only those are written whose measures change; fresh ones are numbered
    from 0. ``rows`` has one row per grain and is partitioned by it, so only ``touched`` moves.
    """
    old = touched.select(*GRAIN_KEYS, "pstatistics_id", F.struct(*MEASURES).alias("_old"))
    new = rows.select(*GRAIN_KEYS, F.struct(*MEASURES).alias("_new"))
    both = new.join(old, GRAIN_KEYS, "left").where(~F.col("_new").eqNullSafe(F.col("_old")))
    both = materialise(both.select("pstatistics_id", *GRAIN_KEYS, "_new.*"), "upserted-facts")
    known = both.where(F.col("pstatistics_id").isNotNull())
    fresh = both.where(F.col("pstatistics_id").isNull()).drop("pstatistics_id")
    return known.select(*FACT.names), dense_ids(fresh, KEY_ORDER, "pstatistics_id").select(*FACT.names)


def last_rows(deltas: DataFrame, order: str) -> DataFrame:
    """Of the rows with one id the one of the highest ``order``; reduced in the map task."""
    keys = ["season_id", "pstatistics_id"]
    rest = [c for c in FACT.names if c not in keys]
    last = deltas.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return last.select(*keys, "_row.*").select(*FACT.names)


def overlaid(base: DataFrame, last: DataFrame) -> DataFrame:
    """``base`` with the rows of ``last`` in place of its own with the same id, and those that it lacks."""
    keys = ["season_id", "pstatistics_id"]
    return base.join(last.select(*keys), keys, "left_anti").select(*FACT.names).unionByName(last)
