"""Folders of stored tables, through the file system that Spark itself uses for the path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of the ``<column>=<value>`` folders directly under ``path`` (none: no such
    path), as they stand in the names."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """``(path, bytes)`` of every file under ``path``."""
    fs, p = _at(spark, path)
    found, out = fs.listFiles(p, True), []
    while found.hasNext():
        s = found.next()
        out.append((s.getPath().toString(), s.getLen()))
    return out


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
