"""The hourly Parquet archive of the raw layer."""
from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = ("year", "month", "day", "hour")


def archive_columns(raw: DataFrame) -> DataFrame:
    """Add zero-padded path columns of the ingest hour."""
    forms = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return raw.withColumns({name: F.date_format("ingested_at", form) for name, form in forms.items()})


def archive_range(raw: DataFrame, start: datetime, end: datetime, root: str) -> None:
    """Write the rows of ``[start, end)`` by hour. Hours written before are replaced, others stay,
    hours without rows make no folder."""
    wanted = raw.filter((F.col("ingested_at") >= F.lit(start)) & (F.col("ingested_at") < F.lit(end)))
    # Even output files, however the rows were spread over tasks.
    (archive_columns(wanted).hint("rebalance", *PARTS).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
     .partitionBy(*PARTS).parquet(root))


def archive_hour(raw: DataFrame, moment: datetime, root: str) -> None:
    start = moment.replace(minute=0, second=0, microsecond=0)
    archive_range(raw, start, start + timedelta(hours=1), root)


def hours_between(start: datetime, end: datetime) -> Column:
    """Partition filter for ``[start, end)``: plain comparisons on the path columns."""
    first, last = start, end - timedelta(microseconds=1)
    year, month, day, hour = (F.col(c) for c in PARTS)

    def stamp(m: datetime, form: str) -> str:
        return m.strftime(form)

    low = [stamp(first, f) for f in ("%Y", "%m", "%d", "%H")]
    high = [stamp(last, f) for f in ("%Y", "%m", "%d", "%H")]

    def bound(values: list[str], after: bool) -> Column:
        columns, out = (year, month, day, hour), None
        for column, value in reversed(list(zip(columns, values))):
            beyond = column > value if after else column < value
            here = (column >= value if after else column <= value) if out is None else (
                beyond | ((column == value) & out))
            out = here
        return out

    return bound(low, True) & bound(high, False)


def scan_archive(spark: SparkSession, root: str, start: datetime, end: datetime) -> DataFrame:
    """Archived rows of ``[start, end)``; only the folders of those hours are listed for reading."""
    schema = ("transaction_id string, payload string, topic string, `partition` int, `offset` bigint, "
              "ingested_at timestamp, year string, month string, day string, hour string")
    rows = spark.read.schema(schema).parquet(root).filter(hours_between(start, end))
    return rows.filter((F.col("ingested_at") >= F.lit(start)) & (F.col("ingested_at") < F.lit(end))).drop(*PARTS)
