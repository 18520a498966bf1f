"""The shot stream: messages in, event table out."""

from __future__ import annotations

import uuid
from collections.abc import Collection
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from touchline.operators.events import RAW_MESSAGE, bad_events, shot_rows, valid_events
from touchline.schemas import SHOT
from touchline.sources import commits

_BATCH = [T.StructField("stream_id", T.StringType()), T.StructField("batch_id", T.LongType())]
_BAD = T.StructType([T.StructField(RAW_MESSAGE, T.StringType()), *_BATCH])
# Matches that the Bloom filter of a row group is sized for; more make it less sharp.
MATCHES = 10_000
# Seconds for which replaced parts stay.
RETENTION = 86_400.0


def kafka_messages(
    spark: SparkSession, servers: str, topic: str = "shots", starting: str = "latest", **options: str
) -> DataFrame:
    """Messages of a topic; needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
        .select("value")
    )


def file_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Messages landed as text files, one per line."""
    reader = spark.readStream.schema("value string")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def _log(table: str) -> str:
    return f"{table}/log"


def _write_part(rows: DataFrame, bad: DataFrame, table: str) -> str:
    """Write events and unusable messages as a new part, which no reader sees yet."""
    part = uuid.uuid4().hex
    (
        rows.select(*SHOT.names)
        .hint("rebalance", "season", "league")
        .sortWithinPartitions("season", "league", "match_id")
        .write.partitionBy("season", "league")
        .option("parquet.bloom.filter.enabled#match_id", "true")
        .option("parquet.bloom.filter.expected.ndv#match_id", MATCHES)
        .parquet(f"{table}/events/part={part}")
    )
    bad.select(*_BAD.names).hint("rebalance").write.parquet(f"{table}/bad/part={part}")
    return part


def write_batch(batch: DataFrame, batch_id: int, table: str, stream_id: str) -> None:
    """Write one micro-batch as a part of its own and commit it.

    A batch counts from its commit on, with events and unusable messages alike. One that is replayed
    after a crash takes the place of what it committed before, so nothing is stored twice; one that was
    merged meanwhile is known by its number and not written again. Within the part events lie by season,
    league and match: the match view then reads the folders and row groups of one match instead of the
    whole table. The parsed rows are kept for the second write, so that no message is read or parsed
    twice. :func:`compact` merges the parts of many batches.
    """
    spark = batch.sparkSession

    def merged(state: commits.State) -> bool:
        return batch_id <= state.marks.get(stream_id, -1)

    if merged(commits.state(spark, _log(table))):
        return
    rows = batch.persist()
    try:
        label = {"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("long")}
        part = _write_part(valid_events(rows), bad_events(rows).withColumns(label), table)
    finally:
        rows.unpersist()

    def added(state: commits.State) -> commits.State | None:
        if merged(state):
            return None
        earlier = {p.id for p in state.parts if (p.stream, p.batch) == (stream_id, batch_id)}
        rest = state.without(earlier)
        return replace(rest, parts=(*rest.parts, commits.Part(part, stream_id, batch_id)))

    commits.commit(spark, _log(table), added)


def compact(spark: SparkSession, table: str, retention: float = RETENTION) -> int:
    """Merge the parts of all committed batches into one; the number of batches merged.

    Run it by the day or the hour, beside streams and readers: a reader then opens a few large parts and
    those of the batches since, not every batch there ever was. Rows are written once more, never again
    after that. The merge counts once it is committed; if a batch was replayed or merged by somebody else
    meanwhile, nothing is committed and 0 returned. Replaced parts are deleted by a later call, when
    ``retention`` seconds have passed, so frames that were planned before still find their files.
    """
    before = commits.state(spark, _log(table))
    batches = [p for p in before.parts if p.stream is not None]
    merged = 0
    if batches:
        ids = {p.id for p in batches}
        part = _write_part(*(_read(spark, table, p, ids) for p in ("events", "bad")), table)

        def swapped(state: commits.State) -> commits.State | None:
            if not ids <= set(state.ids):
                return None
            last: dict[str, int] = dict(state.marks)
            for p in batches:
                last[p.stream] = max(p.batch, last.get(p.stream, -1))
            rest = state.without(ids)
            return replace(rest, parts=(*rest.parts, commits.Part(part)), marks=last)

        if commits.commit(spark, _log(table), swapped):
            merged = len(batches)
    commits.clean(spark, _log(table), [f"{table}/events", f"{table}/bad"], retention)
    return merged


def without_repeats(rows: DataFrame, within: str) -> DataFrame:
    """``rows`` of a stream (see :func:`shot_rows`) without shots whose id came before.

    The time of a shot is its match's date. An id is remembered until a shot comes that is more than
    ``within`` later, so the state is bounded by the shots of that long, whatever the stream's age. Shots
    that are that much older than the latest one are late and dropped. Unusable messages and shots without
    a date are kept as they are; for that the stream is parsed in a branch of its own.
    """
    time = F.try_to_timestamp("date")
    dated = F.coalesce(F.col("id").isNotNull() & time.isNotNull(), F.lit(False))
    known = rows.where(dated).withColumn("_time", time).withWatermark("_time", within)
    return known.dropDuplicatesWithinWatermark(["id"]).drop("_time").unionByName(rows.where(~dated))


def start_shot_stream(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str | None = None,
    once_within: str | None = None,
) -> StreamingQuery:
    """Start parsing ``messages`` into ``table``.

    Batches carry the id that the checkpoint keeps for the query: restarting from the checkpoint
    continues the numbering, a new checkpoint can never replace what an older one wrote.
    ``available_now`` stops after what is there; ``interval`` (``"1 minute"``) gathers messages for
    that long, which keeps the event table's files large. ``once_within`` drops shots that come again; see
    :func:`without_repeats`.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_batch(batch, batch_id, table, stream_id)

    rows = shot_rows(messages)
    writer = (
        (rows if once_within is None else without_repeats(rows, once_within))
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval is not None:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def run_shot_stream(
    messages: DataFrame, table: str, checkpoint: str, timeout: int | None = None, once_within: str | None = None
) -> None:
    """Parse what has arrived so far, then return.

    If that takes more than ``timeout`` seconds, the stream is stopped and TimeoutError raised; what
    its finished batches stored stays, and a new run from the same checkpoint goes on after them.
    """
    query = start_shot_stream(messages, table, checkpoint, available_now=True, once_within=once_within)
    if query.awaitTermination(timeout) is False:
        query.stop()
        raise TimeoutError(f"the stream into {table} did not end within {timeout} s")


_PARTS = {"events": SHOT, "bad": _BAD}


def _read(spark: SparkSession, table: str, kind: str, ids: Collection[str]) -> DataFrame:
    """The rows of some parts, as one scan."""
    schema = _PARTS[kind]
    if not ids:
        return spark.createDataFrame([], schema)
    with_part = T.StructType([*schema, T.StructField("part", T.StringType())])
    reader = spark.read.schema(with_part).option("basePath", f"{table}/{kind}")
    return reader.parquet(*(f"{table}/{kind}/part={i}" for i in sorted(ids))).select(*schema.names)


def scan_events(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The event table. Filters on season and league skip folders, on match skip row groups: by their
    range, as rows lie by match, and by their Bloom filter where ranges of several parts overlap.

    The frame reads the parts of the last commit, or those of an earlier ``version`` (see
    :func:`versions`), and goes on reading them whatever is committed after it was made. Replaced parts
    are deleted once their retention has ended.
    """
    return _read(spark, table, "events", commits.state(spark, _log(table), version).ids)


def scan_bad_events(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """Messages the stream could not use; as for :func:`scan_events`."""
    return _read(spark, table, "bad", commits.state(spark, _log(table), version).ids)


def versions(spark: SparkSession, table: str) -> list[int]:
    """The commits that can still be read, oldest first."""
    return commits.versions(spark, _log(table))
