"""Folders of the shared file system: publish a whole folder at once, and remove what is no longer needed."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _located(spark: SparkSession, path: str):
    """The file system of a path and the path as Hadoop names it; any store that Spark reads will do."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _located(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder; one that is not there is none."""
    files, place = _located(spark, path)
    files.delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    files, place = _located(spark, path)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a hidden folder beside ``path`` and rename it to ``path``.

    Readers of the parent see all of it or nothing. What was published before stays as it is.
    """
    if exists(spark, path):
        return
    parent, name = path.rsplit("/", 1)
    hidden = f"{parent}/_{name}"
    remove(spark, hidden)
    write(hidden)
    files, place = _located(spark, path)
    if not files.rename(_located(spark, hidden)[1], place):
        raise OSError(f"could not publish {path}")


def write_parquet(df: DataFrame) -> Callable[[str], None]:
    return lambda path: df.write.mode("overwrite").parquet(path)
