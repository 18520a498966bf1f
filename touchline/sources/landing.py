"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _csv_writer(df: DataFrame):
    return df.write.option("header", True).option("quote", '"').option("escape", '"')


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header; nulls become empty cells. Inputs are never rewritten in place."""
    _csv_writer(df).mode(mode).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, nulls written out."""
    df.write.option("ignoreNullFields", False).mode(mode).json(path)


def as_messages(df: DataFrame) -> DataFrame:
    """One JSON text per row, nulls written out."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def publish(df: DataFrame, path: str) -> None:
    """Land messages as text files that the shot stream can pick up."""
    as_messages(df).write.mode("append").text(path)


def publish_kafka(df: DataFrame, servers: str, topic: str = "shots") -> None:
    """Send messages to a topic; needs Spark's Kafka connector on the class path.

    Messages carry no key, so the broker spreads them and one busy match cannot fill a partition.
    """
    (
        as_messages(df)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def write_lake(df: DataFrame, path: str) -> None:
    """Parquet by season; replaces the seasons that occur in ``df`` and leaves the others.

    The rebalance keeps files large: without it every task would write a file for every season. A
    season far bigger than the rest is split over several tasks at run time.
    """
    (
        df.hint("rebalance", "season")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("season")
        .parquet(path)
    )


def export_season_csv(df: DataFrame, path: str) -> None:
    """CSV by season. The season stays a column of the files; the folder repeats it.

    Rows that come from the lake already lie together by season, so no shuffle is asked for.
    """
    (
        _csv_writer(df.withColumn("season_of_file", F.col("season")))
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("season_of_file")
        .csv(path)
    )


def load_league_table(df: DataFrame, league: str, path: str) -> None:
    """Append the rows of one league to its own table."""
    df.where(F.col("league") == league).write.mode("append").parquet(path)


def load_league_jdbc(df: DataFrame, league: str, url: str, table: str, **properties: str) -> None:
    """The same into a database table; needs the database's JDBC driver on the class path."""
    df.where(F.col("league") == league).write.mode("append").jdbc(url, table, properties=properties)
