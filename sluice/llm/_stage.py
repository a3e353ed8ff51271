"""Lineage cuts as written tables, and Arrow functions that executors can import."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

import sluice
from sluice.session import scratch_path

_shipped: set[str] = set()


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again.

    A lost executor costs a re-read, not the work before it. The folder is
    new for every call; the platform's checkpoint clean-up owns its lifetime.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, size: str) -> Iterator[None]:
    """What runs meanwhile hands rows to Python workers in batches that end at the row which fills ``size``."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(sluice.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="sluice-src-"), "sluice_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("sluice", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def arrow_map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package's modules importable in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)
