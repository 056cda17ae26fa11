"""Ordered per-key work when one key may hold a large share of all rows.

A window partitioned by a key puts every row of that key into one task. Here a key with more rows than
a task should hold is cut into consecutive ranges ("segments") of its order, and each segment receives
the last rows of the segments before it as context. A window over (key, segment) then sees the same
bounded history as a window over the key alone.

Cut points come from a hash-chosen subset of rows. They only decide where segments begin: every row
stays, and the result does not depend on them.
"""
from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fraudloom.session import checkpoint_root

SEGMENT = "segment"
IS_CONTEXT = "is_context"
SAMPLES_PER_SEGMENT = 32
SEGMENTS_PER_LIMIT = 4  # small enough that hashing them to partitions comes out even
MIN_HOT_ROWS = 50_000
ROWS_PER_TASK = 100_000


@dataclass(frozen=True)
class Segmented:
    """Rows with segments and context, or the input unchanged when no key is hot."""

    rows: DataFrame
    keys: tuple[str, ...]
    hot: DataFrame | None = None  # own rows of the hot keys with their segment
    total: int = 0  # rows of the input

    @property
    def split(self) -> bool:
        return self.hot is not None


def partitions_hint(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def in_bounded_tasks(rows: DataFrame, keys: tuple[str, ...], total: int) -> DataFrame:
    """``rows`` by ``keys`` in tasks of about ``ROWS_PER_TASK`` once there are more of them than cores.

    Tasks that are joined by bytes of the shuffle hold many times these in the sorts and windows that follow.
    """
    wanted = -(-total // ROWS_PER_TASK)
    return rows.repartition(wanted, *keys) if wanted > rows.sparkSession.sparkContext.defaultParallelism else rows


def hot_limit(spark: SparkSession, total: int, floor: int) -> int:
    """Rows one key may hold in one task: a quarter of a mean shuffle partition, at least ``floor``.

    At most ``4 * partitions`` keys can exceed it, which bounds every table broadcast below.
    """
    return max(floor, total // (4 * partitions_hint(spark)))


def position_in(cuts: Column, value: Column, most: int) -> Column:
    """How many of the sorted ``cuts`` are <= ``value``, by binary search."""
    steps = F.array(*[F.lit(1 << bit) for bit in range(max(1, most).bit_length() - 1, -1, -1)])

    def step(found: Column, jump: Column) -> Column:
        return F.when(F.get(cuts, found + jump - 1) <= value, found + jump).otherwise(found)

    return F.aggregate(steps, F.lit(0), step)


def in_segments(df: DataFrame, key: str, place: Column, cuts: DataFrame) -> DataFrame:
    """Add ``is_hot`` and the segment of each row.

    The search has two levels: a row meets every ``step``-th cut of its key first, and then only the
    cuts of that part, so that it never carries a list longer than about the root of all its cuts.
    """
    most = cuts.agg(F.max(F.size("cuts")).alias("most")).first()["most"] or 1
    step = max(1, isqrt(most))
    coarse = cuts.select(key, F.filter("cuts", lambda _, i: i % step == step - 1).alias("coarse"))
    parts = F.sequence(F.lit(0), F.call_function("div", F.size("cuts"), F.lit(step)).cast("int"))
    fine = cuts.select(key, "cuts", F.explode(parts).alias("part")).select(
        key, "part", F.slice("cuts", F.col("part") * step + 1, F.lit(step)).alias("fine"))
    found = df.join(F.broadcast(coarse), key, "left").withColumn("is_hot", F.col("coarse").isNotNull())
    part = F.when(F.col("is_hot"), position_in(F.col("coarse"), place, most // step + 1))
    found = found.withColumn("part", part).drop("coarse").join(F.broadcast(fine), [key, "part"], "left")
    at = F.col("part") * step + position_in(F.col("fine"), place, step)
    return found.withColumn(SEGMENT, F.when(F.col("is_hot"), at).otherwise(0)).drop("part", "fine")


def segment_hot_keys(
    df: DataFrame, key: str, order: tuple[str, ...], history: int, context_columns: tuple[str, ...],
    hot_rows: int | None = None,
) -> Segmented:
    """Cut hot keys of ``df`` into segments and add the ``history`` rows before each as context.

    ``order`` must be unique per key. ``hot_rows`` overrides the size limit (tests). The check is one
    job over the key column that returns a single row.
    """
    spark = df.sparkSession
    counts = df.groupBy(key).agg(F.count("*").alias("rows"))
    top = counts.agg(F.max("rows").alias("largest"), F.sum("rows").alias("total")).first()
    limit = hot_rows or hot_limit(spark, top["total"] or 0, MIN_HOT_ROWS)
    if (top["largest"] or 0) <= limit:
        return Segmented(df, (key,), total=top["total"] or 0)

    checkpoint_root(spark)
    hot = counts.filter((F.col("rows") > limit) & F.col(key).isNotNull()).select(key)
    place = F.struct(*order)
    every = max(1, limit // (SAMPLES_PER_SEGMENT * SEGMENTS_PER_LIMIT))
    cuts = (
        df.join(F.broadcast(hot), key, "left_semi")
        .filter(F.pmod(F.xxhash64(key, *order), F.lit(every)) == 0)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(place)).alias("picked"))
        .select(key, F.filter("picked", lambda _, i: i % SAMPLES_PER_SEGMENT == SAMPLES_PER_SEGMENT - 1)
                .alias("cuts"))
        .checkpoint()
    )
    placed = in_segments(df, key, place, cuts)
    hot_rows_only = placed.filter("is_hot").select(key, SEGMENT, *context_columns)

    # Rows before each segment, and the later segments that still need rows of this one: normally
    # the next one only, more when segments are shorter than the history.
    up_to_here = Window.partitionBy(key).orderBy(SEGMENT)
    sizes = (
        hot_rows_only.groupBy(key, SEGMENT).agg(F.count("*").alias("rows"))
        .withColumn("end", F.sum("rows").over(up_to_here.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start", F.col("end") - F.col("rows"))
    )
    routes = (
        sizes.withColumn("later", F.collect_list(F.struct(SEGMENT, "start")).over(
            up_to_here.rowsBetween(1, history)))
        .select(key, F.col(SEGMENT).alias("source"), "end", F.explode("later").alias("target"))
        .select(key, "source", F.col(f"target.{SEGMENT}").alias("target"),
                (F.col("target.start") - F.col("end")).alias("gap"))
        .filter(F.col("gap") < history)
        .checkpoint()
    )
    from_end = Window.partitionBy(key, SEGMENT).orderBy(*[F.col(c).desc() for c in order])
    context = (
        hot_rows_only.withColumn("back", F.row_number().over(from_end))
        .filter(F.col("back") <= history)
        .withColumnRenamed(SEGMENT, "source")
        .join(F.broadcast(routes), [key, "source"])
        .filter(F.col("back") + F.col("gap") <= history)
        .withColumn(SEGMENT, F.col("target"))
        .select(key, SEGMENT, *context_columns, F.lit(True).alias(IS_CONTEXT))
    )
    rows = placed.drop("is_hot").withColumn(IS_CONTEXT, F.lit(False))
    return Segmented(rows.unionByName(context, allowMissingColumns=True), (key, SEGMENT), hot_rows_only, top["total"])


def running_base(hot_rows: DataFrame, key: str, group: str) -> DataFrame:
    """Rows of each (key, group) in earlier segments, one row per segment where the group occurs."""
    before = Window.partitionBy(key, group).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    return (
        hot_rows.groupBy(key, SEGMENT, group).agg(F.count("*").alias("rows"))
        .withColumn("base", F.sum("rows").over(before))
        .filter(F.col("base").isNotNull())
        .select(key, SEGMENT, group, "base")
    )
