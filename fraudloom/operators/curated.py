"""Curated tables, views and reports over the processed and fraud layers."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudloom.functions.exact import cents, half_up, mean_money, money, percent, std_money
from fraudloom.operators.ingest import injected

# Tier limits in percent, band limits in money, quantile and sizes of the reports.
TIER_HIGH, TIER_MEDIUM = 25, 10
SPEND_LIMITS = (500, 1000, 2000)
HIGH_QUANTILE = 0.95
QUANTILE_ACCURACY = 100_000


def _clock(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def fraud_rate_pct(fraud_txns: Column, txn_count: Column) -> Column:
    return percent(fraud_txns, txn_count, 2)


def risk_tier(rate: Column) -> Column:
    return F.when(rate >= TIER_HIGH, "HIGH").when(rate >= TIER_MEDIUM, "MEDIUM").otherwise("LOW")


def spend_band(average: Column) -> Column:
    low, mid, high = SPEND_LIMITS
    return (F.when(average < low, f"<{low}").when(average < mid, f"{low}-{mid}")
            .when(average < high, f"{mid}-{high}").otherwise(f"{high}+"))


def _since(processed: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Whole days from ``days`` before ``as_of`` on. The time column stays bare for pushdown."""
    first = F.date_sub(F.to_date(as_of), days).cast("timestamp")
    return processed.filter(F.col("event_time") >= first).withColumn("window_date", F.to_date("event_time"))


def merchant_metrics(processed: DataFrame, as_of: Column, days: int = 1) -> DataFrame:
    """Per merchant and day: volume, outcome and flags. Complete days, so a refresh never shrinks one.

    ``updated_at`` is the clock ``as_of``.
    """
    return _since(processed, as_of, days).groupBy("merchant", "window_date").agg(
        F.max("merchant_category").alias("merchant_category"),
        F.count("*").alias("txn_count"),
        F.sum("amount").cast("decimal(18,2)").alias("total_amount"),
        mean_money(F.col("amount")).alias("avg_amount"),
        F.count_if(F.col("status") == "SUCCESS").alias("success_count"),
        F.count_if(F.col("status") == "FAILED").alias("failed_count"),
        F.count_if("is_flagged").alias("fraud_count"),
    ).withColumn("updated_at", as_of)


def customer_metrics(processed: DataFrame, as_of: Column, days: int = 1) -> DataFrame:
    """Per user and day: volume, spread and flags; ``updated_at`` is the clock ``as_of``.

    Rows shrink to one per city first, and devices are counted apart, so no row is copied per count.
    """
    rows, day = _since(processed, as_of, days), ("user_id", "window_date")
    by_city = rows.groupBy(*day, "city").agg(
        F.count("*").alias("n"), F.count("amount").alias("amounts"), F.sum("amount").alias("total"),
        F.count_if("is_flagged").alias("flagged"))
    total = F.sum("total")
    base = by_city.groupBy(*day).agg(
        F.sum("n").alias("txn_count"),
        total.cast("decimal(18,2)").alias("total_amount"),
        money(half_up((total * 100).cast("decimal(38,0)"), F.nullif(F.sum("amounts"), F.lit(0)))).alias("avg_amount"),
        F.count("city").alias("distinct_cities"),
        F.sum("flagged").alias("fraud_count"),
    )
    devices = rows.select(*day, "device").distinct().groupBy(*day).agg(F.count("device").alias("distinct_devices"))
    same = base["user_id"].eqNullSafe(devices["user_id"]) & base["window_date"].eqNullSafe(devices["window_date"])
    return base.join(devices, same).select(
        *[base[c] for c in ("user_id", "window_date", "txn_count", "total_amount", "avg_amount", "distinct_cities")],
        "distinct_devices", "fraud_count", as_of.alias("updated_at"))


def fraud_by_user(fraud: DataFrame) -> DataFrame:
    """Distinct flagged transactions per user."""
    return fraud.groupBy("user_id").agg(F.countDistinct("transaction_id").alias("fraud_txns"))


def join_customer_fraud(customers: DataFrame, fraud: DataFrame) -> DataFrame:
    """Per-user aggregates with their fraud count, zero where there is none."""
    return customers.join(fraud_by_user(fraud), "user_id", "left").fillna({"fraud_txns": 0})


def join_fraud_merchant(fraud: DataFrame, processed: DataFrame) -> DataFrame:
    """Fraud rows with the merchant of their transaction."""
    return fraud.join(processed.select("transaction_id", "merchant"), "transaction_id", "left")


def fraud_by_merchant(fraud: DataFrame, processed: DataFrame) -> DataFrame:
    """Distinct flagged transactions per merchant. One row per transaction enters the join."""
    flagged = fraud.select("transaction_id").distinct()
    return (join_fraud_merchant(flagged, processed)
            .groupBy("merchant").agg(F.count("*").alias("fraud_txns")))


def join_merchant_fraud(merchants: DataFrame, by_merchant: DataFrame) -> DataFrame:
    """Per-merchant aggregates with their fraud count, zero where there is none."""
    return merchants.join(by_merchant, "merchant", "left").fillna({"fraud_txns": 0})


def customer_profile(processed: DataFrame, fraud: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Per-user spending baseline and fraud rate; ``computed_at`` is the clock ``as_of``."""
    amount = F.col("amount")
    quantile = F.percentile_approx(cents(amount), HIGH_QUANTILE, QUANTILE_ACCURACY)
    named = F.when(F.col("user_name").isNotNull(), F.struct("event_time", "transaction_id"))
    # Distinct counts apart, of rows that shrink to one per city and device first: no row is copied per count.
    base = processed.groupBy("user_id").agg(
        F.min_by("user_name", named).alias("user_name"),
        F.count("*").alias("txn_count"),
        mean_money(amount).alias("avg_amount"),
        std_money(amount).alias("std_amount"),
        money(quantile).alias("p95_amount"),
        F.max("amount").alias("max_amount"),
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
    )
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("value")) for kind in ("city", "device")])
    values = processed.select("user_id", "city", "device").distinct().select("user_id", F.inline(pairs)).distinct()
    spread = values.groupBy("user_id").agg(
        F.count_if((F.col("kind") == "city") & F.col("value").isNotNull()).alias("distinct_cities"),
        F.count_if((F.col("kind") == "device") & F.col("value").isNotNull()).alias("distinct_devices"),
    )
    joined = join_customer_fraud(base.join(spread, "user_id"), fraud)
    return joined.withColumns({
        "fraud_rate_pct": fraud_rate_pct(F.col("fraud_txns"), F.col("txn_count")), "computed_at": _clock(as_of)})


def merchant_aggregate(processed: DataFrame) -> DataFrame:
    """Per merchant: most frequent category (ties by name), count, total, average."""
    by_category = processed.groupBy("merchant", "merchant_category").agg(
        F.count("*").alias("n"), F.count("amount").alias("amounts"), F.sum("amount").alias("total"))
    total = F.sum("total")
    common = F.min_by("merchant_category", F.when(
        F.col("merchant_category").isNotNull(), F.struct((-F.col("n")).alias("n"), "merchant_category")))
    return by_category.groupBy("merchant").agg(
        common.alias("merchant_category"),
        F.sum("n").alias("txn_count"),
        total.cast("decimal(18,2)").alias("total_amount"),
        money(half_up((total * 100).cast("decimal(38,0)"), F.nullif(F.sum("amounts"), F.lit(0))))
        .alias("avg_amount"),
    )


def merchant_risk(processed: DataFrame, fraud: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Per-merchant volume, fraud rate and tier; ``computed_at`` is the clock ``as_of``."""
    joined = join_merchant_fraud(merchant_aggregate(processed), fraud_by_merchant(fraud, processed))
    rated = joined.withColumn("fraud_rate_pct", fraud_rate_pct(F.col("fraud_txns"), F.col("txn_count")))
    return rated.withColumns({"risk_tier": risk_tier(F.col("fraud_rate_pct")), "computed_at": _clock(as_of)})


def top_risky_merchants(risk: DataFrame, k: int = 5) -> DataFrame:
    return (risk.orderBy(F.col("fraud_rate_pct").desc(), "merchant").limit(k)
            .select("merchant", "txn_count", "fraud_txns", "fraud_rate_pct", "risk_tier"))


def executive_summary(processed: DataFrame) -> DataFrame:
    success = F.count_if(F.col("status") == "SUCCESS")
    return processed.agg(
        F.count("*").alias("total_transactions"),
        success.alias("successful"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        percent(success, F.count("*"), 2).alias("success_rate_pct"),
        mean_money(F.col("amount")).alias("avg_amount"),
        F.count_if("is_flagged").alias("flagged_transactions"),
    )


def fraud_by_rule(fraud: DataFrame) -> DataFrame:
    return (fraud.groupBy("rule_triggered", "severity")
            .agg(F.count("*").alias("events"), F.sum("amount").cast("decimal(18,2)").alias("amount_at_risk"))
            .orderBy(F.col("events").desc(), "rule_triggered", "severity"))


def latest_alerts(fraud: DataFrame, k: int = 20) -> DataFrame:
    """The newest alerts."""
    return (fraud.orderBy(F.col("detected_at").desc(), "transaction_id", "rule_triggered").limit(k)
            .select("detected_at", "severity", "rule_triggered", "user_id", "amount", "reason"))


def top_merchants_volume(processed: DataFrame, k: int = 10) -> DataFrame:
    return (processed.groupBy("merchant")
            .agg(F.count("*").alias("txns"), F.sum("amount").cast("decimal(18,2)").alias("total"))
            .orderBy(F.col("txns").desc(), "merchant").limit(k))


def txns_by_city(processed: DataFrame) -> DataFrame:
    return (processed.groupBy("city").agg(F.count("*").alias("txns"))
            .orderBy(F.col("txns").desc(), "city"))


def layer_counts(raw: DataFrame, processed: DataFrame, rejected: DataFrame, fraud: DataFrame) -> DataFrame:
    """Row counts of the four layers."""
    named = {"raw": raw, "processed": processed, "rejected": rejected, "fraud_events": fraud}
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("layer"), "rows")
             for name, df in named.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def demo_stats(processed: DataFrame, rejected: DataFrame, fraud: DataFrame, k: int = 12) -> dict[str, DataFrame]:
    """Summary, alerts by rule and newest alerts of the light profile."""
    success = F.count_if(F.col("status") == "SUCCESS")
    summary = processed.agg(
        F.count("*").alias("total"),
        success.alias("success"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.count_if("is_flagged").alias("flagged"),
        mean_money(F.col("amount")).alias("avg_amount"),
        F.coalesce(percent(success, F.count("*"), 1), F.lit(0.0)).alias("success_rate"),
    )
    refused = rejected.agg(F.count("*").alias("rejected"))
    return {
        # One row each: this pairs two scalars.
        "summary": summary.withColumn("one", F.lit(1)).join(refused.withColumn("one", F.lit(1)), "one").drop("one"),
        "by_rule": fraud.groupBy("rule_triggered", "severity").agg(F.count("*").alias("events"))
        .orderBy(F.col("events").desc(), "rule_triggered", "severity"),
        "recent": latest_alerts(fraud, k),
    }


def upsert_daily(target: DataFrame, daily: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``target`` with the rows of ``daily`` replacing those of equal key. ``daily`` has unique keys."""
    return target.join(daily.select(*keys), list(keys), "left_anti").unionByName(daily)


def write_daily(daily: DataFrame, path: str) -> None:
    """Replace the days present in ``daily`` and leave the others."""
    (daily.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("window_date").parquet(path))


def join_detection(raw: DataFrame, fraud: DataFrame) -> DataFrame:
    """Injected and detected transactions per ground-truth scenario."""
    # Both sides shrink to distinct ids first, so redelivered copies do not meet in one join task.
    wanted = (raw.select(injected(F.col("payload")).alias("injected_scenario"), "transaction_id")
              .filter(F.col("injected_scenario").isNotNull()).distinct())
    caught = fraud.select("transaction_id").distinct().withColumn("hit", F.lit(1))
    return (wanted.join(caught, "transaction_id", "left")
            .groupBy("injected_scenario")
            .agg(F.count("transaction_id").alias("injected"), F.count("hit").alias("detected"))
            .orderBy("injected_scenario"))


def city_membership(events: DataFrame, cities: DataFrame) -> DataFrame:
    """Events whose city is in the reference table (ten rows)."""
    return events.join(F.broadcast(cities.select("city")), "city", "left_semi")
