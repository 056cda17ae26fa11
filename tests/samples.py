"""Small frames and constants that test modules share."""
from __future__ import annotations

from decimal import Decimal

DATA = "/root/testdata/sf0.001"
START_US = 1_767_258_000_000_000  # 2026-01-01 09:00 UTC, a Thursday
PUNE, DELHI = (18.5204, 73.8567), (28.7041, 77.1025)

TXN_SCHEMA = (
    "transaction_id string, user_id string, seq bigint, event_us bigint, local_us bigint, "
    "amount decimal(14,2), merchant string, device string, city string, latitude double, "
    "longitude double, status string"
)


def txn(seq: int, seconds: float = 0, **over) -> tuple:
    """One transaction of user U1 in Pune; ``seconds`` after the start."""
    at = START_US + round(seconds * 1_000_000)
    row = {
        "transaction_id": f"t{seq}", "user_id": "U1", "seq": seq, "event_us": at, "local_us": at,
        "amount": 500, "merchant": "Cab", "device": "phone", "city": "Pune", "latitude": PUNE[0],
        "longitude": PUNE[1], "status": "SUCCESS", **over,
    }
    row["amount"] = None if row["amount"] is None else Decimal(str(row["amount"])).quantize(Decimal("0.01"))
    return tuple(row.values())


def frame(spark, rows):
    return spark.createDataFrame(rows, TXN_SCHEMA)
