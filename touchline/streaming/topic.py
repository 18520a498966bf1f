"""Topics without a broker: messages with key, partition and offset in files, read as a stream.

A topic is a table that changes by commits. Publishing adds a part and gives every message the next offset
of its partition. The stream's position is the number of the last commit it has read, so a restart from a
checkpoint goes on in the middle of the topic, and a batch that is replayed reads the same messages.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from touchline.operators.ids import dense_ids
from touchline.session import materialise
from touchline.sources import commits
from touchline.sources.commits import Part, State
from touchline.sources.tables import log_of

FORMAT = "landed_topic"
# Larger messages are refused, as a broker does.
MAX_BYTES = 1_000_000
# Bytes of a file that one task reads, and bytes of messages in a row group; a row group is read whole.
SPLIT = 4_000_000
ROW_GROUP = 8_000_000
SCHEMA = "key string, value string, partition int, offset long"


def publish_to_topic(messages: DataFrame, path: str, partitions: int = 4) -> int:
    """Append ``messages`` (key, value) to the topic; how many."""
    part = _published(messages, path, partitions)
    return 0 if part is None else messages.sparkSession.read.parquet(part).count()


def publish_with_report(
    messages: DataFrame, path: str, partitions: int = 4, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """Append what can be sent, and tell of every row what became of it.

    key, partition and offset of the rows that were sent, and key and ``error`` of those that were refused:
    rows without a value, and values of more than ``max_bytes`` bytes. The report is as distributed as the
    rows; it is made of what was committed, so a row that it calls sent is in the topic.
    """
    size = F.octet_length("value")
    error = F.when(size.isNull(), "no value").when(size > max_bytes, F.concat(size.cast("string"), F.lit(" bytes")))
    judged = materialise(messages.select("key", "value", error.alias("error")), "topic-messages")
    part = _published(judged.where("error is null").select("key", "value"), path, partitions)
    schema = "key string, partition int, offset long, error string"
    refused = judged.where("error is not null").selectExpr("key", "int(null) as partition", "bigint(null) as offset", "error")
    if part is None:
        return messages.sparkSession.createDataFrame([], schema).unionByName(refused)
    sent = messages.sparkSession.read.schema(SCHEMA).parquet(part)
    return sent.select("key", "partition", "offset", F.lit(None).cast("string").alias("error")).unionByName(refused)


def _published(messages: DataFrame, path: str, partitions: int) -> str | None:
    """Append the messages; the folder they are in, None if there are none.

    A key's messages go to one partition, in the order they came in; those without key go by their value.
    Offsets go on without gaps after those of earlier commits; if another process publishes at once, its
    offsets come before or after.
    """
    spark = messages.sparkSession
    where = F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(partitions)).cast("int")
    rows = messages.select("key", "value", where.alias("partition"), F.monotonically_increasing_id().alias("at"))
    numbered = materialise(dense_ids(rows, ["partition", "at"], "id"), "topic-rows")
    counts = {
        r.partition: (r.first, r.rows)
        for r in numbered.groupBy("partition").agg(F.min("id").alias("first"), F.count("*").alias("rows")).collect()
    }
    if not counts:
        return None

    def raised(state: State) -> State:
        return replace(state, marks=state.marks | {str(p): state.marks.get(str(p), 0) + n for p, (_, n) in counts.items()})

    # Offsets are claimed first; the part counts once it is written and committed.
    claimed = commits.commit(spark, f"{path}/_offsets", raised)
    shift = F.create_map(
        *(F.lit(x).cast("long") for p, (first, n) in counts.items() for x in (p, claimed.marks[str(p)] - n - first))
    )
    offset = F.col("id") + shift[F.col("partition").cast("long")]
    part = uuid.uuid4().hex
    whole = numbered.select("key", "value", "partition", offset.alias("offset"))
    whole = whole.hint("rebalance", "partition").sortWithinPartitions("partition", "offset")
    whole.write.option("parquet.block.size", ROW_GROUP).parquet(f"{path}/part={part}")
    commits.commit(
        spark, log_of(path), lambda s: replace(s, parts=(*s.parts, Part(part, order=s.version + 1)), marks=claimed.marks)
    )
    return f"{path}/part={part}"


def _topic_source() -> type[DataSource]:
    """The data source; made here so that it travels to Spark's Python processes as it is."""
    schema, name, split = SCHEMA, FORMAT, SPLIT

    class File(InputPartition):
        """The row groups of a file that begin in a range of its bytes."""

        def __init__(self, path: str, start: int, end: int):
            self.path, self.start, self.end = path, start, end

    class Reader(DataSourceStreamReader):
        def __init__(self, path: str):
            local = "://" not in path
            self.path = f"file://{path.removeprefix('file:')}" if local else path

        def _store(self):
            from pyarrow import fs

            return fs.FileSystem.from_uri(self.path)

        def _state(self) -> dict:
            import json

            from pyarrow import fs

            store, root = self._store()
            found = store.get_file_info(fs.FileSelector(f"{root}/_log", allow_not_found=True))
            last = max((f.base_name for f in found if f.base_name.isdigit()), default=None)
            if last is None:
                return {"version": 0, "parts": []}
            with store.open_input_stream(f"{root}/_log/{last}") as stream:
                return json.loads(stream.read())

        def initialOffset(self) -> dict:
            return {"version": 0}

        def latestOffset(self) -> dict:
            return {"version": self._state()["version"]}

        def partitions(self, start: dict, end: dict) -> list[File]:
            from pyarrow import fs

            store, root = self._store()
            wanted = [p["id"] for p in self._state()["parts"] if start["version"] < p["order"] <= end["version"]]
            found = (f for i in wanted for f in store.get_file_info(fs.FileSelector(f"{root}/part={i}")))
            files = [f for f in found if f.base_name.endswith(".parquet")]
            return [File(f.path, start, start + split) for f in files for start in range(0, f.size, split)]

        def read(self, partition: File):
            import pyarrow.parquet as pq

            store, _ = self._store()
            with store.open_input_file(partition.path) as file:
                parquet = pq.ParquetFile(file)
                wanted = []
                for group in range(parquet.num_row_groups):
                    first = parquet.metadata.row_group(group).column(0)
                    begin = first.dictionary_page_offset or first.data_page_offset
                    if partition.start <= begin < partition.end:
                        wanted.append(group)
                for group in wanted:
                    yield from parquet.iter_batches(row_groups=[group], columns=["key", "value", "partition", "offset"])

        def commit(self, end: dict) -> None:
            """Messages stay in the topic; other streams may still want them."""

    class Topic(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def streamReader(self, schema) -> DataSourceStreamReader:
            return Reader(self.options["path"])

    return Topic


def topic_messages(spark: SparkSession, path: str) -> DataFrame:
    """The topic as a stream of key, value, partition and offset, from its beginning or a checkpoint on.

    The topic must be in a store that Arrow's readers reach (a shared folder, HDFS, S3 and the like).
    """
    spark.dataSource.register(_topic_source())
    return spark.readStream.format(FORMAT).load(path)
