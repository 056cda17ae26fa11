"""The dashboard cards: thin queries over the layers and curated tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudloom.functions.exact import int_div, percent
from fraudloom.operators.curated import latest_alerts, spend_band


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def _count_by(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(name)).orderBy(F.col(name).desc(), column)


def _hourly(df: DataFrame, time: str, name: str) -> DataFrame:
    return df.groupBy(F.date_trunc("hour", time).alias("hour")).agg(F.count("*").alias(name)).orderBy("hour")


def _top(df: DataFrame, by: str, key: str, k: int, *columns: str) -> DataFrame:
    return df.orderBy(F.col(by).desc(), key).limit(k).select(*columns)


def success_rate(processed: DataFrame) -> DataFrame:
    good = F.count_if(F.col("status") == "SUCCESS")
    return processed.agg(percent(good, F.count("*"), 1).alias("success_rate_pct"))


def avg_payment(processed: DataFrame) -> DataFrame:
    total = (F.sum("amount") * 100).cast("decimal(38,0)")
    n = F.nullif(F.count("amount"), F.lit(0))
    return processed.agg(int_div(total * 2 + n * 100, n * 200).alias("avg_payment"))


def amount_at_risk(fraud: DataFrame) -> DataFrame:
    return fraud.agg(F.round(F.sum("amount"), 0).cast("bigint").alias("amount_at_risk"))


def risk_by_rule(fraud: DataFrame) -> DataFrame:
    return (fraud.groupBy("rule_triggered")
            .agg(F.round(F.sum("amount"), 0).cast("bigint").alias("amount_at_risk"))
            .orderBy(F.col("amount_at_risk").desc(), "rule_triggered"))


def avg_fraud_rate(profile: DataFrame) -> DataFrame:
    # Rates have two decimals: summing them as hundredths keeps the mean exact.
    hundredths = F.sum(F.round(F.col("fraud_rate_pct") * 100).cast("bigint"))
    n = F.nullif(F.count("fraud_rate_pct"), F.lit(0))
    tenths = int_div(hundredths * 2 + n * 10, n * 20)
    return profile.agg((tenths.cast("double") / 10.0).alias("avg_fraud_rate_pct"))


def spend_bands(profile: DataFrame) -> DataFrame:
    return (profile.groupBy(spend_band(F.col("avg_amount")).alias("spend_band"))
            .agg(F.count("*").alias("users")).orderBy("spend_band"))


def city_spread(profile: DataFrame, at_least: int = 5) -> DataFrame:
    return (profile.filter(F.col("distinct_cities") >= at_least)
            .select("user_id", "distinct_cities", "distinct_devices", "fraud_rate_pct")
            .orderBy(F.col("distinct_cities").desc(), "user_id"))


Card = Callable[[DataFrame], DataFrame]

EXECUTIVE: dict[str, Card] = {
    "total": lambda p: _count(p, "total"),
    "success_rate": success_rate,
    "failed": lambda p: _count(p.filter(F.col("status") == "FAILED"), "failed"),
    "flagged": lambda p: _count(p.filter("is_flagged"), "flagged"),
    "avg_payment": avg_payment,
    "status": lambda p: _count_by(p, "status", "count"),
    "hourly_volume": lambda p: _hourly(p, "event_time", "transactions"),
    "top_merchants": lambda p: _count_by(p, "merchant", "transactions").limit(10),
    "city": lambda p: _count_by(p, "city", "transactions"),
}

OPERATIONS: dict[str, Card] = {
    "fraud_total": lambda f: _count(f, "fraud_events"),
    "critical": lambda f: _count(f.filter(F.col("severity") == "CRITICAL"), "critical"),
    "amount_at_risk": amount_at_risk,
    "fraud_rule": lambda f: _count_by(f, "rule_triggered", "events"),
    "fraud_severity": lambda f: _count_by(f, "severity", "events"),
    "fraud_trend": lambda f: _hourly(f, "detected_at", "events"),
    "risk_by_rule": risk_by_rule,
    "recent_alerts": lambda f: latest_alerts(f, 20),
}

RISK_BY_CUSTOMER: dict[str, Card] = {
    "users_profiled": lambda c: _count(c, "users"),
    "avg_fraud_rate": avg_fraud_rate,
    "top_fraud_users": lambda c: _top(c, "fraud_rate_pct", "user_id", 10, "user_id", "txn_count",
                                      "avg_amount", "fraud_txns", "fraud_rate_pct"),
    "spend_bands": spend_bands,
    "city_spread": city_spread,
}

RISK_BY_MERCHANT: dict[str, Card] = {
    "high_risk_merchants": lambda m: _count(m.filter(F.col("risk_tier") == "HIGH"), "merchants"),
    "risk_tiers": lambda m: _count_by(m, "risk_tier", "merchants"),
    "top_fraud_merchants": lambda m: _top(m, "fraud_rate_pct", "merchant", 15, "merchant",
                                          "merchant_category", "txn_count", "fraud_rate_pct", "risk_tier"),
}
