"""File-system questions asked through Hadoop, so that any storage Spark can read works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), location


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as the catalog shows it."""
    system, location = _resolve(spark, path)
    return system.makeQualified(location).toString()


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a single file, or a folder whose writer left its mark of success, is at this path.

    Some committers move files straight into place, so a folder without the mark may hold a part.
    """
    system, location = _resolve(spark, path)
    if not system.exists(location):
        return False
    if system.getFileStatus(location).isFile():
        return True
    return any(s.getPath().getName() == "_SUCCESS" for s in system.listStatus(location))


def delete(spark: SparkSession, path: str) -> None:
    system, location = _resolve(spark, path)
    system.delete(location, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    system, location = _resolve(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(location) if s.isDirectory())
