"""The few file operations Spark's readers and writers do not offer."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _path(spark, path)
    return fs.exists(location)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, location = _path(spark, path)
    if not fs.exists(location):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(location))


def count(spark: SparkSession, path: str) -> int:
    """How many children a folder has; their names stay where they are."""
    fs, location = _path(spark, path)
    return len(fs.listStatus(location)) if fs.exists(location) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, location = _path(spark, path)
    fs.delete(location, True)


def make(spark: SparkSession, path: str) -> None:
    """A folder that stands for a fact."""
    fs, location = _path(spark, path)
    fs.mkdirs(location)


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, by one listing."""
    fs, location = _path(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(location) or [])


def committed(spark: SparkSession, path: str) -> list[str]:
    """Folders in ``path`` whose writer has finished, by one listing."""
    fs, location = _path(spark, f"{path}/*/_SUCCESS")
    found = fs.globStatus(location) or []
    return sorted(status.getPath().getParent().getName() for status in found)
