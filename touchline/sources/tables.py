"""Tables that change by commits.

A table is a folder of parts and a log that names the current ones (see :mod:`commits`). Small tables are
rewritten as a whole or get parts added. A load that depends on what it read says which version that was:
if another load committed first, nothing is changed and it reads again. So two loads at once end like one
after the other.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.sources import commits
from touchline.sources.commits import Part, State

# Seconds for which replaced parts stay for readers that opened them.
RETENTION = 86_400.0
# A table that has so many parts becomes one part when more is added.
MOST_PARTS = 16


def log_of(path: str) -> str:
    return f"{path}/_log"


def current_version(spark: SparkSession, path: str) -> int:
    """The number of the last commit, 0 for none. Looks at names only."""
    known = commits.versions(spark, log_of(path))
    return known[-1] if known else 0


def read_parts(spark: SparkSession, path: str, schema: T.StructType, parts: list[Part]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*(f"{path}/part={p.id}" for p in parts)).select(*schema.names)


def read_version(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The table as of its last commit, or of an earlier ``version``; later commits don't change the frame."""
    return read_parts(spark, path, schema, list(commits.state(spark, log_of(path), version).parts))


def written(df: DataFrame, path: str) -> tuple[str, int]:
    """Write a part that no reader sees yet; its id and number of rows."""
    part, seen = uuid.uuid4().hex, Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/part={part}")
    return part, seen.get["rows"]


def _committed(spark: SparkSession, path: str, part: str, expected: int | None, replaces: set[str] | None) -> bool:
    def change(state: State) -> State | None:
        if expected is not None and state.version != expected:
            return None
        rest = state.without(set(state.ids) if replaces is None else replaces)
        return replace(rest, parts=(*rest.parts, Part(part)))

    done = commits.commit(spark, log_of(path), change) is not None
    commits.clean(spark, log_of(path), [path], RETENTION)
    return done


def replace_version(df: DataFrame, path: str, expected: int | None = None) -> bool:
    """Make ``df``, which may read the table, its whole content.

    False, and nothing changed, if the last version isn't ``expected`` any more.
    """
    part, _ = written(df, path)
    return _committed(df.sparkSession, path, part, expected, None)


def append_version(df: DataFrame, path: str, expected: int | None = None) -> bool:
    """Add rows. False, and nothing changed, if the last version isn't ``expected`` any more.

    Without rows nothing is committed.
    """
    spark = df.sparkSession
    before = commits.state(spark, log_of(path))
    if expected is not None and before.version != expected:
        return False
    if len(before.parts) >= MOST_PARTS:
        whole = read_parts(spark, path, df.schema, list(before.parts)).unionByName(df)
        return replace_version(whole, path, before.version) or (expected is None and append_version(df, path))
    part, rows = written(df, path)
    return not rows or _committed(spark, path, part, expected, set())


def create_empty(spark: SparkSession, path: str) -> None:
    """A table without rows, if there is none yet."""
    commits.commit(spark, log_of(path), lambda state: State() if state.version == 0 else None)


def reserve(spark: SparkSession, path: str, count: int, first: int = 0) -> int:
    """The first of ``count`` numbers that nobody has had; numbering begins with ``first``."""

    def raised(state: State) -> State | None:
        return replace(state, marks={"next": state.marks.get("next", first) + count}) if count else None

    after = commits.commit(spark, log_of(path), raised)
    if after is None:
        return commits.state(spark, log_of(path)).marks.get("next", first)
    return after.marks["next"] - count
