"""Pipeline-health panels as windowed aggregates; they run on batch frames and on streams."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds of the latency histogram in seconds, and the panels' quantiles.
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0)
QUANTILES = (0.5, 0.95, 0.99)


def per_minute(df: DataFrame, time: str, name: str, *by: str) -> DataFrame:
    """Rows per minute (and per ``by``)."""
    return (df.groupBy(F.window(time, "1 minute").alias("w"), *by).agg(F.count("*").alias(name))
            .select(F.col("w.start").alias("minute"), *by, name))


def throughput(processed: DataFrame) -> DataFrame:
    return per_minute(processed, "processed_at", "txns")


def rejections(rejected: DataFrame) -> DataFrame:
    return per_minute(rejected, "rejected_at", "rejected")


def alerts(fraud: DataFrame) -> DataFrame:
    return per_minute(fraud, "detected_at", "alerts")


def alerts_by_rule(fraud: DataFrame) -> DataFrame:
    return per_minute(fraud, "detected_at", "alerts", "rule_triggered")


def throughput_vs_alerts(processed: DataFrame, fraud: DataFrame) -> DataFrame:
    """Both series by minute, zero where one has no rows."""
    return throughput(processed).join(alerts(fraud), "minute", "full").fillna(0, ["txns", "alerts"])


BOUNDS = [f"le_{i}" for i in range(len(BUCKETS))]
PANE = "1 minute"


def bucket_counts(latencies: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Cumulative histogram per time window: rows at or below each bound, and all rows."""
    counts = [F.count_if(F.col("seconds") <= bound).alias(name) for name, bound in zip(BOUNDS, BUCKETS)]
    return (latencies.groupBy(F.window("observed_at", width).alias("w")).agg(*counts, F.count("seconds").alias("observed"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *BOUNDS, "observed"))


def sliding(panes: DataFrame, panes_per_window: int = 5) -> DataFrame:
    """Histograms of windows of several panes that start a pane apart. Histograms add up, so what is
    dealt to the windows is a row per pane and not a row per latency."""
    pane = F.expr(f"INTERVAL {PANE}")
    back = F.explode(F.sequence(F.lit(0), F.lit(panes_per_window - 1)))
    start = (F.col("window_start") - F.col("back") * pane).alias("window_start")
    dealt = panes.withColumn("back", back).select(start, *BOUNDS, "observed")
    sums = [F.sum(c).alias(c) for c in (*BOUNDS, "observed")]
    return dealt.groupBy("window_start").agg(*sums).withColumn("window_end", F.col("window_start") + panes_per_window * pane)


def bucket_quantile(q: float) -> Column:
    """Quantile from the histogram, linear inside a bucket.

    The lowest bucket starts at zero; a rank above the last bound yields the last bound.
    """
    rank = F.col("observed") * q
    value = F.lit(BUCKETS[-1])
    for i in range(len(BUCKETS) - 1, -1, -1):
        low = BUCKETS[i - 1] if i else 0.0
        below = F.col(f"le_{i - 1}") if i else F.lit(0)
        inside = F.nullif(F.col(f"le_{i}") - below, F.lit(0))
        point = F.lit(low) + (BUCKETS[i] - low) * ((rank - below) / inside)
        value = F.when(F.col(f"le_{i}") >= rank, point).otherwise(value)
    return F.when(F.col("observed") > 0, value)


def percentiles(histograms: DataFrame, quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """Quantiles in milliseconds of each histogram."""
    made = [F.round(bucket_quantile(q) * 1000, 1).alias(f"p{round(q * 100)}_ms") for q in quantiles]
    return histograms.select("window_start", "window_end", *made)


def latency_percentiles(latencies: DataFrame, quantiles: tuple[float, ...] = QUANTILES, slide: bool = True) -> DataFrame:
    """Quantiles per window of five minutes, one beginning each minute with ``slide``."""
    histograms = sliding(bucket_counts(latencies, PANE)) if slide else bucket_counts(latencies)
    return percentiles(histograms, quantiles)


def p99(latencies: DataFrame) -> DataFrame:
    return latency_percentiles(latencies, (0.99,), slide=False)


def running_counts(gated: DataFrame) -> list[Column]:
    """Metrics to attach with ``DataFrame.observe``; they come for free with the job that is running."""
    accepted = F.size("failed_checks") == 0
    return [F.count_if(accepted).alias("accepted"), F.count_if(~accepted).alias("rejected")]


def flagged_count() -> Column:
    """The same for events that passed the gate and were judged."""
    return F.count_if("is_flagged").alias("flagged")
