"""Customer profiles kept up to date from mergeable states of days.

A refresh reads the processed rows of the days that changed, replaces those days' states and merges states,
which are a row per user and day. Counts, sums, sums of squares, first and last times, the name and the
distinct cities and devices merge exactly, so those columns equal a full rebuild. The 95th percentile
comes from quantile sketches: exact up to about ``SKETCH_K`` amounts of a user, beyond that within about
``RANK_ERROR`` of the rank.

A state row does not grow with the rows of its day: the sketch is bounded, and distinct values are rows of a
table of their own, counted without copying rows per count.
"""
from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudloom.functions.exact import cents, half_up, money, std_from
from fraudloom.operators.curated import HIGH_QUANTILE, fraud_rate_pct, join_customer_fraud

SKETCH_K = 1600
RANK_ERROR = 0.005
DAY = "state_date"
KINDS = ("city", "device")


def day_states(processed: DataFrame) -> DataFrame:
    """One mergeable row per user and day."""
    c = cents(F.col("amount"))
    wide = c.cast("decimal(19,0)")
    named = F.when(F.col("user_name").isNotNull(), F.struct("event_time", "transaction_id", "user_name"))
    return processed.groupBy("user_id", F.to_date("event_time").alias(DAY)).agg(
        F.count("*").alias("n"), F.count("amount").alias("amounts"), F.sum(wide).cast("decimal(38,0)").alias("cents"),
        F.sum((wide * wide).cast("decimal(28,0)")).cast("decimal(38,0)").alias("squares"), F.max("amount").alias("max_amount"),
        F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"), F.min(named).alias("named"),
        F.kll_sketch_agg_bigint(c, SKETCH_K).alias("sketch"),
    )


def day_values(processed: DataFrame) -> DataFrame:
    """The distinct cities and devices of each user and day, a row each."""
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("value")) for kind in KINDS])
    rows = processed.select("user_id", F.to_date("event_time").alias(DAY), *KINDS).distinct()
    return rows.select("user_id", DAY, F.inline(pairs)).where(F.col("value").isNotNull()).distinct()


def refresh_days(spark: SparkSession, processed: DataFrame, root: str, first: date, last: date) -> None:
    """Replace the states of the days from ``first`` to ``last``; only their rows are read.

    Days without rows keep what they had: processed rows are never removed.
    """
    begin, end = (F.lit(str(d)).cast("timestamp") for d in (first, last + timedelta(days=1)))
    rows = processed.where((F.col("event_time") >= begin) & (F.col("event_time") < end))
    for name, states in (("states", day_states(rows)), ("values", day_values(rows))):
        (states.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(DAY).parquet(f"{root}/{name}"))


def profile_from_states(states: DataFrame, values: DataFrame, fraud: DataFrame, as_of: Column) -> DataFrame:
    """The customer profile of merged states, with the columns of ``customer_profile``."""
    n = F.sum("amounts")
    sketch = F.kll_merge_agg_bigint(F.when(F.col("amounts") > 0, F.col("sketch")), SKETCH_K)
    base = states.groupBy("user_id").agg(
        F.min("named")["user_name"].alias("user_name"), F.sum("n").alias("txn_count"),
        money(half_up(F.sum("cents").cast("decimal(38,0)"), F.nullif(n, F.lit(0)))).alias("avg_amount"),
        std_from(n, F.sum("cents").cast("decimal(38,0)"), F.sum("squares").cast("decimal(38,0)")).alias("std_amount"),
        F.when(n > 0, money(F.kll_sketch_get_quantile_bigint(sketch, F.lit(HIGH_QUANTILE)))).alias("p95_amount"),
        F.max("max_amount").alias("max_amount"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
    )
    counts = [F.count_if(F.col("kind") == kind).alias(name) for kind, name in zip(KINDS, ("distinct_cities", "distinct_devices"))]
    spread = values.select("user_id", "kind", "value").distinct().groupBy("user_id").agg(*counts)
    joined = join_customer_fraud(base.join(spread, "user_id", "left").fillna(0, ["distinct_cities", "distinct_devices"]), fraud)
    return joined.withColumns({
        "fraud_rate_pct": fraud_rate_pct(F.col("fraud_txns"), F.col("txn_count")), "computed_at": as_of})


def read_profile(spark: SparkSession, root: str, fraud: DataFrame, as_of: Column) -> DataFrame:
    return profile_from_states(spark.read.parquet(f"{root}/states"), spark.read.parquet(f"{root}/values"), fraud, as_of)
