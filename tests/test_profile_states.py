"""Profiles from day states against the profile of all rows."""
from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from fraudloom.operators import curated, profile_states

ROWS = ("transaction_id string, user_id string, user_name string, amount decimal(14,2), city string, device string, "
        "event_time timestamp")
START = datetime(2026, 1, 1)
AS_OF = "2026-02-01 00:00:00"
EXACT = ["user_id", "user_name", "txn_count", "avg_amount", "std_amount", "max_amount", "first_seen", "last_seen",
         "distinct_cities", "distinct_devices", "fraud_txns", "fraud_rate_pct"]


def rows(rng, n, days, users=4):
    return [(f"t{rng.random()}", f"U{rng.randint(0, users)}", rng.choice([None, "Ann", "Bea"]),
             rng.choice([None, Decimal(rng.randint(1, 10**7)) / 100, Decimal("999999999999.99")]), rng.choice([None, "Pune", "Delhi"]),
             rng.choice([None, "a", "b", "c"]), START + timedelta(days=rng.randint(0, days - 1), seconds=rng.randint(0, 86399)))
            for _ in range(n)]


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_refreshed_states_give_the_profile_of_all_rows(spark, tmp_path):
    rng, root = random.Random(5), str(tmp_path)
    old, new = rows(rng, 300, 4), rows(rng, 80, 2)
    new = [(*r[:6], r[6] + timedelta(days=3)) for r in new]  # the last day again, and a day after it
    table = spark.createDataFrame(old + new + [("t", "U9", None, None, None, None, START)], ROWS)
    fraud = spark.createDataFrame([(old[0][0], old[0][1]), (old[0][0], old[0][1])], "transaction_id string, user_id string")
    first = spark.createDataFrame(old + [("t", "U9", None, None, None, None, START)], ROWS)
    profile_states.refresh_days(spark, first, root, date(2026, 1, 1), date(2026, 1, 4))
    before = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "states").rglob("*.parquet")}
    for _ in range(2):  # a refresh that runs again changes nothing
        profile_states.refresh_days(spark, table, root, date(2026, 1, 4), date(2026, 1, 5))
    got = profile_states.read_profile(spark, root, fraud, F.lit(AS_OF))
    want = curated.customer_profile(table, fraud, F.lit(AS_OF))
    assert set(got.columns) == set(want.columns)
    assert sorted_rows(got.select(*EXACT)) == sorted_rows(want.select(*EXACT))
    assert sorted_rows(got.select("user_id", "p95_amount")) == sorted_rows(want.select("user_id", "p95_amount"))
    after = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "states").rglob("*.parquet")}
    assert sum(after.get(name) == at for name, at in before.items()) >= 3  # the other days' files
    plan = curated.customer_profile(table, fraud, F.lit(AS_OF))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_quantile_of_many_amounts_is_within_the_stated_rank(spark):
    n = 60_000
    table = spark.range(n).select(
        F.col("id").cast("string").alias("transaction_id"), F.lit("U").alias("user_id"), F.lit("Ann").alias("user_name"),
        (F.pmod(F.col("id") * 7919, F.lit(n)) + 1).cast("decimal(14,2)").alias("amount"), F.lit("Pune").alias("city"), F.lit("a").alias("device"),
        (F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval((F.col("id") % 9).cast("int"))).alias("event_time"))
    none = spark.createDataFrame([], "transaction_id string, user_id string")
    got = profile_states.profile_from_states(
        profile_states.day_states(table), profile_states.day_values(table), none, F.lit(AS_OF)).first()
    assert abs(float(got["p95_amount"]) - 0.95 * n) <= profile_states.RANK_ERROR * n
