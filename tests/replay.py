"""A plain replay of one user's events, one at a time, for comparison."""
from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

NAMES = ("txns_last_hour", "payment_velocity", "avg_amount_30d", "amount_zscore", "merchant_frequency",
         "device_changed", "location_changed", "seconds_since_prev", "km_from_prev")


def distance(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = (math.sin((q - p) / 2) ** 2
         + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2)
    return 12742.0 * math.asin(math.sqrt(h))


def replay(rows: list[dict], history: int = 200) -> dict[int, tuple]:
    """Features by ``seq`` for rows in the given order."""
    users: dict[str, list[dict]] = {}
    out = {}
    for row in rows:
        before = users.setdefault(row["user_id"], [])
        last, recent = (before[-1] if before else None), before[-history:]
        cents = [int(r["amount"] * 100) for r in recent]
        ages = [row["event_us"] - r["event_us"] for r in recent]
        n, total = len(cents), sum(cents)
        spread = n * sum(c * c for c in cents) - total * total
        now = int(row["amount"] * 100)
        average = (Decimal(total) / n).quantize(Decimal(1), ROUND_HALF_UP) / 100 if n else row["amount"]
        z = round((n * now - total) / math.sqrt(spread), 4) if n > 1 and spread > 0 else 0.0
        km = None
        if last and None not in (last["latitude"], row["latitude"]):
            km = round(distance((last["latitude"], last["longitude"]), (row["latitude"], row["longitude"])), 2)
        out[row["seq"]] = (
            sum(a <= 3_600_000_000 for a in ages), sum(a <= 60_000_000 for a in ages), average, z,
            sum(r["merchant"] == row["merchant"] for r in before) + 1,
            bool(last) and last["device"] is not None and last["device"] != row["device"],
            bool(last) and last["city"] is not None and last["city"] != row["city"],
            int((row["event_us"] - last["event_us"]) / 1_000_000) if last else None, km,
        )
        before.append(row)
    return out
