"""Looking at folders through Hadoop's file layer, which knows every store Spark can write to."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return fs.exists(hadoop_path)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none if there is no such folder."""
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def changed_at(spark: SparkSession, path: str) -> dict[str, float]:
    """Names directly below ``path`` with the time, in seconds, at which each was last changed."""
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(hadoop_path)}


def read_small(spark: SparkSession, path: str) -> str:
    """The content of one small file."""
    fs, hadoop_path = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, content: str) -> bool:
    """Create a small file as a whole; False if there is one already, which then stays as it is.

    Of several processes that try at once one succeeds, and nobody sees half of the content: it is
    written beside and then moved to its place by a step that fails if the place is taken. On a local
    disk that is a hard link, elsewhere the store's rename, as on HDFS; a store whose rename replaces
    what is there needs one writer at a time.
    """
    fs, hadoop_path = _open(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    _, beside = _open(spark, f"{path}.{uuid.uuid4().hex}.new")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() != "file":
            return not fs.exists(hadoop_path) and fs.rename(beside, hadoop_path)
        os.link(beside.toUri().getPath(), hadoop_path.toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        fs.delete(beside, False)
