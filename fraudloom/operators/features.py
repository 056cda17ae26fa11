"""Stateful per-user features as window functions.

The work has two steps. ``history_columns`` reads what a row needs from the rows before it (counts,
exact sums, previous values). ``derive_features`` turns these into the eleven features with plain
column expressions. The streaming job fills the same history columns from keyed state and calls the
same second step, so batch and stream cannot drift apart.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudloom.functions import clock
from fraudloom.functions.exact import cents, half_up, money
from fraudloom.functions.geo import haversine_km
from fraudloom.plans.hot_keys import IS_CONTEXT, SEGMENT, in_bounded_tasks, running_base, segment_hot_keys
from fraudloom.schemas import FEATURES, LIGHT_FEATURES, STATUS_TAIL

# History length, window lengths.
HISTORY = 200
LIGHT_HISTORY = 100
HOUR_US = 3600 * clock.SECOND_US
MINUTE_US = 60 * clock.SECOND_US

USER = "user_id"
INPUTS = ("seq", "event_us", "amount", "merchant", "device", "city", "latitude", "longitude", "status")
HISTORY_COLUMNS = (
    "prior_hour", "prior_minute", "hist_n", "hist_cents", "hist_spread", "merchant_prior",
    "prev_us", "prev_device", "prev_city", "prev_latitude", "prev_longitude", "recent_statuses",
)


def order_columns(order: str) -> tuple[str, ...]:
    """``event_time``: by time, ties by arrival. ``arrival``: as the events came in."""
    if order not in ("event_time", "arrival"):
        raise ValueError(f"unknown order {order!r}")
    return ("event_us", "seq") if order == "event_time" else ("seq",)


def _counts_by_time(rows: DataFrame, keys: tuple[str, ...], history: int) -> DataFrame:
    """Remembered events at most an hour and a minute back (both ends included), in time order.

    Earlier events minus those that are too old. Both are frames that only grow, so a row costs the
    same however many events its hour holds.
    """
    by_time = Window.partitionBy(*keys).orderBy(F.col("event_us").asc_nulls_first())

    def recent(span: int) -> Column:
        too_old = F.count("event_us").over(by_time.rangeBetween(Window.unboundedPreceding, -span - 1))
        return F.least(F.col("_before") - too_old, F.lit(history))

    return rows.select("*", recent(HOUR_US).alias("prior_hour"), recent(MINUTE_US).alias("prior_minute"))


NEVER = -(2**62)  # a time that no span reaches
ROWS_AT_ONCE = 4096


def _count_in_blocks(keys: tuple[str, ...], history: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Count, for rows sorted by key and arrival, the remembered times within a span of each row.

    Rows come in blocks; the times and the key of the last ``history`` rows are carried to the next.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, tail, tail_rows = None, np.full(history, NEVER), 0  # rows of the last key at the end of ``tail``
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [batch.column(k) for k in keys]
            first_key = tuple(c[0].as_py() for c in columns)
            changes = np.zeros(n, bool)
            for c in columns:
                same = pc.equal(c.slice(1), c.slice(0, n - 1))
                both_null = pc.and_(c.slice(1).is_null(), c.slice(0, n - 1).is_null())
                changes[1:] |= ~pc.fill_null(same, both_null).to_numpy(zero_copy_only=False)
            begins = np.where(changes, np.arange(n), 0)
            begins = np.maximum.accumulate(begins)  # where each row's key begins in this block
            known = np.arange(n) - begins
            if first_key == last_key:
                known[begins == 0] += tail_rows
            times = np.concatenate([tail, pc.fill_null(batch.column("event_us"), NEVER).to_numpy()])
            found = np.empty((2, n), np.int32)
            frames = np.lib.stride_tricks.sliding_window_view(times[:-1], history)
            reach = np.arange(history, 0, -1)
            for at in range(0, n, ROWS_AT_ONCE):
                part = slice(at, at + ROWS_AT_ONCE)
                age = times[history:][part, None] - frames[part]
                mine = reach <= known[part, None]
                for k, span in enumerate((HOUR_US, MINUTE_US)):
                    found[k, part] = ((age <= span) & mine).sum(1)
            last_key = tuple(c[n - 1].as_py() for c in columns)
            tail, tail_rows = times[-history:].copy(), min(history, int(known[-1]) + 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found[0]), pa.array(found[1])], [*batch.schema.names, "prior_hour", "prior_minute"])

    return count


def _counts_by_arrival(rows: DataFrame, keys: tuple[str, ...], by: list[Column], history: int) -> DataFrame:
    """The same in arrival order, where a remembered event may also lie in the future.

    The rows come from windows over the same keys, so each key's rows lie in one partition already.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("prior_hour", T.IntegerType()), T.StructField("prior_minute", T.IntegerType())])
    in_order = rows.sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys], *by)
    return in_order.mapInArrow(_count_in_blocks(keys, history), schema)


def history_columns(
    txns: DataFrame, history: int, order: str, hot_rows: int | None, tail: int = STATUS_TAIL
) -> DataFrame:
    by = order_columns(order)
    context = max(history, tail)
    seg = segment_hot_keys(txns, USER, by, context, INPUTS, hot_rows)
    rows = seg.rows
    if seg.split:
        own = ~F.col(IS_CONTEXT)
        base = running_base(seg.hot, USER, "merchant")
        # Visit counts of earlier segments travel as rows without a time: they sort before all others.
        rows = rows.withColumn("visits", F.when(own, F.lit(1)).otherwise(0).cast("bigint"))
        rows = rows.unionByName(
            base.select(USER, SEGMENT, "merchant", F.col("base").alias("visits"),
                        F.lit(True).alias(IS_CONTEXT)),
            allowMissingColumns=True,
        )
    else:
        rows = rows.withColumn("visits", F.lit(1).cast("bigint"))
    rows = in_bounded_tasks(rows, seg.keys, seg.total)

    ranked = [F.col(c).asc_nulls_first() for c in by]
    per_merchant = Window.partitionBy(*seg.keys, "merchant").orderBy(*ranked)
    per_user = Window.partitionBy(*seg.keys).orderBy(*ranked)
    earlier = per_user.rowsBetween(Window.unboundedPreceding, -1)

    c = cents(F.col("amount")).cast("decimal(19,0)")
    # Each select is one window pass; all passes share one exchange on the keys.
    rows = rows.select(
        "*",
        F.count("event_us").over(earlier).alias("_before"),
        F.count("amount").over(earlier).alias("_n"),
        F.coalesce(F.sum(c).over(earlier).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")).alias("_sum"),
        F.coalesce(F.sum((c * c).cast("decimal(28,0)")).over(earlier).cast("decimal(38,0)"),
                   F.lit(0).cast("decimal(38,0)")).alias("_squares"),
        F.lag("event_us").over(per_user).alias("prev_us"),
        F.lag("device").over(per_user).alias("prev_device"),
        F.lag("city").over(per_user).alias("prev_city"),
        F.lag("latitude").over(per_user).alias("prev_latitude"),
        F.lag("longitude").over(per_user).alias("prev_longitude"),
    )
    rows = rows.select(
        "*",
        F.lag("_n", history).over(per_user).alias("_n0"),
        F.lag("_sum", history).over(per_user).alias("_sum0"),
        F.lag("_squares", history).over(per_user).alias("_squares0"),
        F.collect_list("status").over(per_user.rowsBetween(1 - tail, 0)).alias("recent_statuses"),
    )
    if order == "event_time":
        rows = _counts_by_time(rows, seg.keys, history)

    zero = F.lit(0).cast("decimal(38,0)")
    total = (F.col("_sum") - F.coalesce("_sum0", zero)).cast("decimal(38,0)")
    squares = (F.col("_squares") - F.coalesce("_squares0", zero)).cast("decimal(38,0)")
    rows = rows.select(
        "*",
        (F.col("_n") - F.coalesce("_n0", F.lit(0))).alias("hist_n"),
        total.alias("hist_cents"),
        squares.alias("_hist_squares"),
    )
    spread = F.col("hist_n") * F.col("_hist_squares") - F.col("hist_cents") * F.col("hist_cents")
    rows = rows.withColumn("hist_spread", spread.cast("decimal(38,0)"))
    # Late, because it needs another sort: the exchange above already keeps (user, merchant) together.
    visits = F.sum("visits").over(per_merchant.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.select("*", (visits - F.col("visits")).alias("merchant_prior"))
    if order == "arrival":
        rows = _counts_by_arrival(rows, seg.keys, ranked, history)
    if seg.split:
        rows = rows.filter(~F.col(IS_CONTEXT))
    return rows.select(*txns.columns, *HISTORY_COLUMNS)


def derive_features(rows: DataFrame, tail: int = STATUS_TAIL) -> DataFrame:
    """The features from a transaction and its history columns.

    ``amount_value``, where there is one, stands in for an amount that no money column holds.
    """
    amount, n = F.col("amount"), F.col("hist_n")
    mean_cents = F.when(n > 0, half_up(F.col("hist_cents"), F.greatest(n, F.lit(1))))
    deviation = (n * cents(amount).cast("decimal(19,0)") - F.col("hist_cents")).cast("double")
    if "amount_value" in rows.columns:
        deviation = F.coalesce(deviation, n * F.col("amount_value") * 100 - F.col("hist_cents").cast("double"))
    zscore = F.when(
        (n >= 2) & (F.col("hist_spread") > 0),
        F.round(deviation / F.sqrt(F.col("hist_spread").cast("double")), 4),
    ).otherwise(F.lit(0.0))

    def changed(column: str) -> Column:
        before = F.col(f"prev_{column}")
        return before.isNotNull() & ~before.eqNullSafe(F.col(column))

    gap = F.call_function("div", F.col("event_us") - F.col("prev_us"), F.lit(clock.SECOND_US))
    km = haversine_km(*[F.col(c) for c in ("prev_latitude", "prev_longitude", "latitude", "longitude")])
    made = {
        "txns_last_hour": F.col("prior_hour").cast("int"),
        "avg_amount_30d": F.coalesce(money(mean_cents), amount),
        "amount_zscore": zscore,
        "merchant_frequency": (F.col("merchant_prior") + 1).cast("int"),
        "device_changed": changed("device"),
        "location_changed": changed("city"),
        "payment_velocity": F.col("prior_minute").cast("int"),
        "is_weekend": clock.is_weekend(F.col("local_us")),
        "is_night": clock.is_night(F.col("local_us")),
        "seconds_since_prev": gap,
        "km_from_prev": F.round(km, 2),
    }
    kept = [c for c in rows.columns if c not in HISTORY_COLUMNS]
    statuses = F.col("recent_statuses").alias("recent_statuses", metadata={"tail": tail})
    return rows.select(*kept, *[made[name].alias(name) for name in FEATURES], statuses)


def add_features(
    txns: DataFrame, history: int = HISTORY, order: str = "event_time", hot_rows: int | None = None,
    tail: int = STATUS_TAIL,
) -> DataFrame:
    """Transactions with the eleven features and the last ``tail`` statuses (current one included)."""
    return derive_features(history_columns(txns, history, order, hot_rows, tail), tail)


def add_light_features(txns: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """The seven features of the light profile, over a history of 100."""
    full = add_features(txns, LIGHT_HISTORY, hot_rows=hot_rows)
    dropped = [c for c in FEATURES if c not in LIGHT_FEATURES]
    return full.drop(*dropped)
