"""JDBC tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], split_column: str | None = None,
    lower: str | int | None = None, upper: str | int | None = None, splits: int = 1,
) -> DataFrame:
    """A table over JDBC. With ``split_column`` and its bounds, ``splits`` tasks read ranges of it."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if split_column is not None:
        reader = (reader.option("partitionColumn", split_column).option("lowerBound", str(lower))
                  .option("upperBound", str(upper)).option("numPartitions", splits))
    return reader.load()


def overwrite_table(df: DataFrame, url: str, table: str, properties: dict[str, str], writers: int = 8) -> None:
    """Replace a curated table; at most ``writers`` connections are open at a time."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**properties).option(
        "numPartitions", writers).option("truncate", "true").mode("overwrite").save()
