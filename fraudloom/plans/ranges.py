"""Exact running totals and exact cuts over a whole table, without one task holding all rows."""
from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudloom.plans.hot_keys import SAMPLES_PER_SEGMENT, SEGMENT, in_segments
from fraudloom.session import checkpoint_root

RANGE = "range_id"
ROWS_PER_RANGE = 50_000
LEAST_PREFIX = 4  # hex digits: 65,536 buckets


def balanced_size(rows: int, least: int) -> int:
    """Rows for one task when ranges and rows per range grow alike: the square root of all rows."""
    return max(least, isqrt(rows))


def prefix_digits(rows: int) -> int:
    """Hex digits of a hash prefix that leaves about the square root of all rows to a bucket."""
    return max(LEAST_PREFIX, -(-isqrt(max(rows, 1)).bit_length() // 4))


def with_ranges(df: DataFrame, value: str, rows: int, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Number consecutive ranges of ``value`` (distinct per row) of about equal size.

    The cut points come from a hash-chosen subset; they set the balance, not the result. Ranges and
    rows per range both grow with the square root of the table.
    """
    size = balanced_size(rows, rows_per_range)
    if rows <= size:
        return df.withColumn(RANGE, F.lit(0))
    checkpoint_root(df.sparkSession)
    every = max(1, size // SAMPLES_PER_SEGMENT)
    # About the root of the rows are picked; every 32nd of them in order is a cut. They go to the rows as a
    # table in two levels and not as literals, so neither the plan nor a row's search grows with them.
    picked = df.where(F.pmod(F.xxhash64(value), F.lit(every)) == 0).agg(F.sort_array(F.collect_list(value)).alias("picked"))
    cuts = picked.select(
        F.lit(0).alias("_all"),
        F.array_distinct(F.filter("picked", lambda _, i: i % SAMPLES_PER_SEGMENT == SAMPLES_PER_SEGMENT - 1)).alias("cuts")).checkpoint()
    return in_segments(df.withColumn("_all", F.lit(0)), "_all", F.col(value), cuts).drop("_all", "is_hot").withColumnRenamed(SEGMENT, RANGE)


def running_totals(df: DataFrame, value: str, columns: tuple[str, ...], rows: int,
                   rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``<column>_upto``: sums over all rows with an equal or higher ``value``."""
    ranged = with_ranges(df, value, rows, rows_per_range)
    above = Window.orderBy(F.col(RANGE).desc()).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    bases = ranged.groupBy(RANGE).agg(*[F.sum(c).alias(c) for c in columns]).select(
        RANGE, *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_base") for c in columns])
    inside = Window.partitionBy(RANGE).orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.select("*", *[F.sum(c).over(inside).alias(f"{c}_in") for c in columns])
    return summed.join(F.broadcast(bases), RANGE).select(
        *df.columns, *[(F.col(f"{c}_in") + F.col(f"{c}_base")).alias(f"{c}_upto") for c in columns])


def smallest_share(df: DataFrame, group: str, hashed: Column, share: tuple[int, int], rows: int) -> DataFrame:
    """Per ``group``, the hash below or at which exactly ``floor(share * rows)`` of its rows lie.

    Counts per hash prefix find the bucket with the cut; only that bucket is sorted. ``group`` has few
    values. Result: ``group, cut`` (null when the share is empty).
    """
    num, den = share
    keyed = df.select(group, hashed.alias("hash")).withColumn("bucket", F.substring("hash", 1, prefix_digits(rows)))
    in_order = Window.partitionBy(group).orderBy("bucket")
    wanted = F.floor(F.sum("rows").over(Window.partitionBy(group)) * num / den).cast("bigint")
    edges = (
        keyed.groupBy(group, "bucket").agg(F.count("*").alias("rows"))
        .withColumn("upto", F.sum("rows").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("wanted", wanted)
        .filter((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("rows") < F.col("wanted")))
        .select(group, "bucket", (F.col("wanted") - F.col("upto") + F.col("rows")).alias("take"))
    )
    place = F.row_number().over(Window.partitionBy(group).orderBy("hash"))
    return (
        keyed.join(F.broadcast(edges), [group, "bucket"])
        .withColumn("place", place).filter(F.col("place") == F.col("take"))
        .select(group, F.col("hash").alias("cut"))
    )
