"""The gate: single failures, their order, and the text readers against Python's own."""
from __future__ import annotations

import math
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from fraudloom.functions.clock import parse_common_iso, parse_iso
from fraudloom.operators import ingest, quality
from fraudloom.schemas import EVENT_SCHEMA

NOW_US = 1_767_268_800_000_000  # 2026-01-01 12:00 UTC
GOOD = {
    "transaction_id": "t1", "user_id": "U1", "merchant": "Cab", "merchant_category": "Ride", "city": "Pune",
    "device": "phone", "amount": "500", "status": "SUCCESS", "upi_handle": "someone@bank",
    "latitude": "18.52", "longitude": "73.85", "event_time": "2026-01-01T11:59:00+00:00",
}
CASES = [
    ({}, []),
    ({"transaction_id": None}, ["MISSING_TRANSACTION_ID"]),
    ({"user_id": ""}, ["MISSING_USER_ID"]),
    ({"amount": None}, ["NULL_AMOUNT"]),
    ({"amount": "-10"}, ["NON_POSITIVE_AMOUNT"]),
    ({"amount": "0"}, ["NON_POSITIVE_AMOUNT"]),
    ({"amount": "-inf"}, ["NON_POSITIVE_AMOUNT"]),
    ({"amount": "nan"}, []),
    ({"amount": "inf"}, []),
    ({"amount": "1_000"}, []),
    ({"amount": "1d"}, ["NON_NUMERIC_AMOUNT"]),
    ({"amount": "abc"}, ["NON_NUMERIC_AMOUNT"]),
    ({"merchant": ""}, ["MISSING_MERCHANT"]),
    ({"upi_handle": "notahandle"}, ["INVALID_UPI_HANDLE"]),
    ({"upi_handle": "a@b"}, ["INVALID_UPI_HANDLE"]),
    ({"upi_handle": None}, ["INVALID_UPI_HANDLE"]),
    ({"status": "success"}, ["INVALID_STATUS"]),
    ({"city": "Atlantis"}, ["INVALID_CITY"]),
    ({"city": None}, ["INVALID_CITY"]),
    ({"event_time": "yesterday"}, ["INVALID_TIMESTAMP"]),
    ({"event_time": None}, ["INVALID_TIMESTAMP"]),
    ({"event_time": "2026-01-02T12:00:00+00:00"}, ["FUTURE_TIMESTAMP"]),
    ({"event_time": "2026-01-01T12:00:00+00:00"}, []),
    ({"event_time": "2026-01-01T12:00:00.000001"}, ["FUTURE_TIMESTAMP"]),
    ({"transaction_id": "", "user_id": None, "amount": None, "city": "x"},
     ["MISSING_TRANSACTION_ID", "MISSING_USER_ID", "NULL_AMOUNT", "INVALID_CITY"]),
]


def event_frame(spark, overrides):
    names = [f.name for f in EVENT_SCHEMA.fields]
    rows = [tuple({**GOOD, **o}.get(n) for n in names) + (i,) for i, o in enumerate(overrides)]
    return spark.createDataFrame(rows, EVENT_SCHEMA.simpleString()[7:-1].replace(":", " ") + ", seq int")


def test_each_check_and_their_order(spark):
    gated = quality.gate(event_frame(spark, [c[0] for c in CASES]), F.lit(NOW_US))
    got = [r["failed_checks"] for r in gated.orderBy("seq").collect()]
    assert got == [c[1] for c in CASES]


def test_light_gate_merges_amount_checks(spark):
    overrides = [{}, {"amount": None}, {"amount": "-1"}, {"amount": "x"}, {"upi_handle": "bad"}]
    gated = quality.gate(event_frame(spark, overrides), F.lit(NOW_US), "light")
    got = [r["failed_checks"] for r in gated.orderBy("seq").collect()]
    assert got == [[], ["INVALID_AMOUNT"], ["INVALID_AMOUNT"], ["INVALID_AMOUNT"], []]


TIMES = [
    "2026-01-03", "20260103", "2026-01-03T10", "2026-01-03T10:20", "2026-01-03 10:20:30", "2026-01-03T10:20:30Z",
    "2026-01-03T10:20:30.5", "2026-01-03T10:20:30,123456789", "2026-01-03T102030+0530", "20260103T1020-03:30",
    "2026-01-03T01:00:00+05:30", "2026-01-03T01:00:00-23:59", "2026-01-03T01:00:00+23:59:59.999999", "2026-W01-1",
    "2026W017", "2020-W53-7", "2026-W54-1", "2026-02-30", "2026-13-01", "2026-01-03T24:01", "2026-01-03T10:60",
    "2026-01-03T10:20:61", "2026", "T12:00", "12:00", "2026-1-3", "", "not-a-time", "0000-01-01", "0001-01-01",
    "2026-01-03T10:2030", "2026-0103", "2026-01-03T10:20:30+25:00", "2026-01-03x10:20", "2024-02-29T23:59:59.999999+00:00",
    "2026-01-03T10:20:30+05:30",
]


def python_iso(text):
    if not text:
        return None
    try:
        at = datetime.fromisoformat(text)
    except ValueError:
        return None
    aware = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    whole = (at.replace(tzinfo=timezone.utc) - epoch)
    micros = lambda d: (d.days * 86400 + d.seconds) * 1_000_000 + d.microseconds
    return micros(aware - epoch), micros(whole)


def test_iso_reader_equals_python(spark):
    df = spark.createDataFrame([(t,) for t in TIMES], "t string").select(
        "t", parse_iso(F.col("t")).alias("full"), parse_common_iso(F.col("t")).alias("common"))
    for row in df.collect():
        want = python_iso(row["t"])
        got = (row["full"]["event_us"], row["full"]["local_us"])
        assert got == (want or (None, None)), row["t"]
        if row["common"] is not None:
            assert tuple(row["common"]) == want, row["t"]


NUMBERS = ["1", "-1.5", "+2", ".5", "5.", "1e3", "1E-2", "1_000.5", "1__0", "_1", "1d", "1f", "0x10", "", " 7 ", "nan",
           "NaN", "Infinity", "-inf", "infinit", "1e", "1,000", "12abc", "e5", "."]


def test_number_reader_equals_python(spark):
    df = spark.createDataFrame([(t,) for t in NUMBERS], "t string").select("t", quality.number(F.col("t")).alias("n"))
    for row in df.collect():
        try:
            want = float(row["t"])
        except ValueError:
            want = None
        if want is not None and math.isnan(want):
            assert math.isnan(row["n"])
        else:
            assert row["n"] == want, row["t"]


@pytest.mark.parametrize("text,error", [
    ('{"transaction_id": "t1"', "malformed JSON"), ("[1]", "not a JSON object"), ("5", "not a JSON object"),
    ('[{"transaction_id": "t1"}]', "not a JSON object"), ("", "not a JSON object"), (None, "not a JSON object"),
    ('{"transaction_id": "t1", "other": {"a": 1}}', None), ("  {}", None),
])
def test_only_json_objects_are_events(spark, text, error):
    df = spark.createDataFrame([(text, "raw", 0, 1, None)],
                               "value string, topic string, partition int, offset bigint, ingested_at timestamp")
    flat = ingest.parse(df)
    assert flat.first()["error"] == error
    assert ingest.dead_letters(flat).count() == (error is not None)
    assert ingest.raw_rows(flat).count() == (error is None)


def test_report_shortens_raw_text(spark):
    df = spark.createDataFrame([("x" * 500, "raw", 0, 1, None)],
                               "value string, topic string, partition int, offset bigint, ingested_at timestamp")
    row = ingest.dlq_report(ingest.dead_letters(ingest.parse(df))).first()
    assert len(row["raw"]) == 200 and row["error"] == "not a JSON object"
    foreign = spark.createDataFrame([("{}", 3)], "value string, offset bigint")
    assert ingest.dlq_report(foreign).first().asDict() == {"offset": 3, "error": "unknown", "raw": ""}
