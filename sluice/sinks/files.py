"""Small file-system helpers over Spark's own Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    """(file system, path) of a path text."""
    p = hadoop_path(spark, path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file as a whole."""
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Names ``a=1/b=2`` of the partition folders ``depth`` levels below ``path``
    (one listing per parent folder, never of files)."""
    fs, _ = file_system(spark, path)
    names = [""]
    for _ in range(depth):
        found = []
        for n in names:
            here = hadoop_path(spark, f"{path}/{n}")
            if fs.exists(here):
                found += [f"{n}/{f.getPath().getName()}" for f in fs.listStatus(here)
                          if f.isDirectory() and "=" in f.getPath().getName()]
        names = found
    return [n.lstrip("/") for n in names]
