"""Key rules. Spark tables do not enforce them, so they are counted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_primary_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """Per table: how many keys occur more than once, and how many rows have no key."""

    def rule(name: str) -> DataFrame:
        key = F.col(keys[name])
        counts = tables[name].groupBy(key.alias("key")).agg(F.count("*").alias("rows"))
        return counts.agg(
            F.count_if((F.col("rows") > 1) & F.col("key").isNotNull()).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("rows"))), F.lit(0)).alias("null_keys"),
        ).select(F.lit(name).alias("table_name"), "duplicate_keys", "null_keys")

    return reduce(DataFrame.unionByName, (rule(name) for name in keys))


def check_foreign_keys(
    fact: DataFrame, dims: Mapping[str, DataFrame], keys: Sequence[tuple[str, str]]
) -> DataFrame:
    """Per dimension: fact rows whose key the dimension lacks.

    The fact is counted by key first; only one row per key meets the dimension.
    """

    def rule(name: str, key: str) -> DataFrame:
        counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
        orphans = counts.join(dims[name].select(key), key, "left_anti")
        return orphans.agg(
            F.count("*").alias("orphan_keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows")
        ).select(F.lit(name).alias("table_name"), "orphan_keys", "orphan_rows")

    return reduce(DataFrame.unionByName, (rule(*pair) for pair in keys))
