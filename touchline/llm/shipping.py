"""Code for the executors: operators with Python parts need this package there."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, the way ``--py-files`` does.

    Spark serves the archive from the driver; executors that are started later fetch it too.
    """
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix=f"{package.name}-code-")
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
    _sent.add(context.applicationId)


def with_package(job: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``job(spark, ...)`` that sends the package first."""

    @wraps(job)
    def run(spark: SparkSession, *args) -> DataFrame:
        send_package(spark)
        return job(spark, *args)

    return run
