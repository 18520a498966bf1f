"""Session helper and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from touchline.sources.paths import delete

_CHECKPOINT_KEY = "spark.checkpoint.dir"
# Temporary folders of local sessions, by application.
_local_dirs: dict[str, str] = {}


def local_session(app: str = "touchline", cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark. Clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TOUCHLINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; the session itself is left as it
    is. A cluster session without it is refused: a folder on one machine would lose data with that
    machine. Whether a named folder is shared (a mount may well be) is for the cluster to say.
    """
    context = spark.sparkContext
    named = context.getConf().get(_CHECKPOINT_KEY) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="touchline-")
    return _local_dirs[context.applicationId]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, grouped by application so that it can be cleaned up."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/touchline/{app}/{label}-{uuid.uuid4().hex[:12]}"


# What the current block has written; a thread or task that runs beside it has a value of its own.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete what :func:`materialise` wrote inside this block once the block is left.

    For jobs that have written their results by then. Without it intermediate tables stay below the
    shared folder, because a lazy result may still read them.
    """
    written: list[str] = []
    outer = _written.set(written)
    try:
        yield
    finally:
        _written.reset(outer)
        for path in written:
            delete(spark, path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and survives lost executors. Unlike a row checkpoint the copy is Parquet, so
    later steps still read only the columns they need.
    """
    path = fresh_dir(df.sparkSession, label)
    if (written := _written.get()) is not None:
        written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
