"""Features against a replay, on boundaries, and with hot users cut into segments."""
from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from samples import DELHI, PUNE, frame, txn
from fraudloom.operators import features
from fraudloom.plans.hot_keys import segment_hot_keys
from fraudloom.schemas import CITIES, FEATURES
from replay import NAMES, replay

DAY = 86_400


def random_rows(n: int, users: list[str], seed: int, shuffled: bool) -> list[tuple]:
    rng = random.Random(seed)
    rows, at = [], 0.0
    for seq in range(n):
        at += rng.choice([0, 0.5, 7, 20, 60, 400, 3600])
        city = rng.choice([*CITIES, None])
        place = CITIES.get(city, (None, None))
        back = rng.choice([0, 0, 90, 4000]) if shuffled else 0
        rows.append(txn(seq, at - back, user_id=rng.choice(users), amount=rng.choice([10, 25.5, 99.99, 4000]),
                        merchant=f"M{rng.randrange(4)}", device=rng.choice(["a", "b", None]), city=city,
                        latitude=place[0], longitude=place[1], status=rng.choice(["SUCCESS", "FAILED"])))
    return rows


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


def close(a, b):
    return a == b or (isinstance(a, float) and abs(a - b) < 1e-3)


@pytest.mark.parametrize("order", ["event_time", "arrival"])
def test_equal_to_replay(spark, order):
    # Three of four events belong to one user, with more than 200 of them.
    df = frame(spark, random_rows(900, ["U1", "U1", "U1", "U2"], 5, True))
    key = (lambda r: (r["event_us"], r["seq"])) if order == "event_time" else (lambda r: r["seq"])
    want = replay(sorted(as_dicts(df), key=key))
    for row in features.add_features(df, order=order).collect():
        got = tuple(row[n] for n in NAMES)
        assert all(close(a, b) for a, b in zip(got, want[row["seq"]])), (row["seq"], got, want[row["seq"]])


@pytest.mark.parametrize("order", ["event_time", "arrival"])
@pytest.mark.parametrize("history,hot_rows", [(200, 32), (200, 150), (5, 20), (64, 40)])
def test_segments_do_not_change_results(spark, order, history, hot_rows):
    df = frame(spark, random_rows(1200, ["U1", "U1", "U1", "U2", "U3"], 9, True))
    whole = features.add_features(df, history, order)
    cut = features.add_features(df, history, order, hot_rows=hot_rows)
    assert whole.exceptAll(cut).count() == 0 and cut.exceptAll(whole).count() == 0


def test_segments_split_ties_and_stay_small(spark):
    rows = [txn(i, 0, user_id="U1" if i % 3 else f"V{i}") for i in range(6000)]  # one instant
    df = frame(spark, rows)
    seg = segment_hot_keys(df, "user_id", ("event_us", "seq"), 200, features.INPUTS, hot_rows=300)
    sizes = [r["count"] for r in seg.hot.groupBy("segment").count().collect()]
    assert sum(sizes) == 4000 and len(sizes) > 8 and max(sizes) < 900
    whole, cut = features.add_features(df), features.add_features(df, hot_rows=300)
    assert whole.exceptAll(cut).count() == 0


def test_no_hot_user_keeps_the_plan_simple(spark):
    df = frame(spark, random_rows(50, ["U1", "U2"], 1, False))
    assert not segment_hot_keys(df, "user_id", ("seq",), 200, features.INPUTS).split


def one(spark, rows, seq, **kw):
    return features.add_features(frame(spark, rows), **kw).filter(F.col("seq") == seq).first()


def test_windows_include_their_limits(spark):
    row = one(spark, [txn(0, 0), txn(1, 3540), txn(2, 3600)], 2)
    assert (row["txns_last_hour"], row["payment_velocity"]) == (2, 1)
    row = one(spark, [txn(0, 0), txn(1, 3539.999999), txn(2, 3600.000001)], 2)
    assert (row["txns_last_hour"], row["payment_velocity"]) == (1, 0)


def test_same_time_counts_only_earlier_arrivals(spark):
    rows = [txn(0, 0), txn(1, 0)]
    assert one(spark, rows, 0)["payment_velocity"] == 0
    assert one(spark, rows, 1)["payment_velocity"] == 1


def test_history_is_the_last_two_hundred(spark):
    rows = [txn(i, i, amount=1000 if i < 4 else 10) for i in range(205)]
    row = one(spark, rows, 204)
    assert float(row["avg_amount_30d"]) == 10.0 and row["txns_last_hour"] == 200
    assert row["merchant_frequency"] == 205  # visits are not limited


def test_arrival_order_counts_events_from_the_future(spark):
    rows = [txn(0, 100), txn(1, 0)]
    row = one(spark, rows, 1, order="arrival")
    assert row["payment_velocity"] == 1 and row["seconds_since_prev"] == -100


def test_first_event(spark):
    row = one(spark, [txn(0)], 0)
    assert row["seconds_since_prev"] is None and row["km_from_prev"] is None
    assert float(row["avg_amount_30d"]) == 500.0 and row["amount_zscore"] == 0.0
    assert row["merchant_frequency"] == 1 and not row["device_changed"] and not row["location_changed"]


def test_null_device_and_city(spark):
    rows = [txn(0, device=None, city=None), txn(1, 1), txn(2, 2, device=None, city=None)]
    assert not one(spark, rows, 1)["device_changed"] and not one(spark, rows, 1)["location_changed"]
    assert one(spark, rows, 2)["device_changed"] and one(spark, rows, 2)["location_changed"]


def test_distance_pune_delhi(spark):
    row = one(spark, [txn(0), txn(1, 300, latitude=DELHI[0], longitude=DELHI[1])], 1)
    assert 1000 < row["km_from_prev"] < 1300
    assert one(spark, [txn(0), txn(1, 1, latitude=None)], 1)["km_from_prev"] is None
    assert PUNE != DELHI


def test_local_clock_decides_night_and_weekend(spark):
    start = txn(0)[4]
    night = start - start % (DAY * 1_000_000) + DAY * 1_000_000  # midnight, Friday
    rows = [txn(i, local_us=night + round(h * 3_600_000_000)) for i, h in enumerate([1, 4.999, 5, 22.999, 23, 24, 72])]
    got = {r["seq"]: (r["is_night"], r["is_weekend"]) for r in features.add_features(frame(spark, rows)).collect()}
    assert [got[i][0] for i in range(7)] == [True, True, False, False, True, True, True]
    assert [got[i][1] for i in (0, 4, 5, 6)] == [False, False, True, False]


def test_recent_statuses_end_with_the_current_one(spark):
    rows = [txn(i, i, status="FAILED" if i < 11 else "PENDING") for i in range(12)]
    assert one(spark, rows, 11)["recent_statuses"] == ["FAILED"] * 9 + ["PENDING"]


def test_columns(spark):
    df = frame(spark, [txn(0)])
    assert features.add_features(df).columns == [*df.columns, *FEATURES, "recent_statuses"]
