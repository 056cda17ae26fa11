"""Fraud rules over the engineered features, as column expressions.

Limits are numbers, or come from a table of periods: then each event is judged by the limits that were
valid at its time.
"""
from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudloom.functions.exact import cents
from fraudloom.plans.hot_keys import position_in
from fraudloom.schemas import FINDING, STATUS_TAIL


@dataclass(frozen=True)
class Thresholds:
    """Rule limits. The defaults are fixed values."""

    velocity: int = 4
    speed_kmh: float = 800.0
    distance_km: float = 200.0
    zscore: float = 5.0
    times_average: int = 20
    failed_burst: int = 3
    score: float = 0.8
    score_medium: float = 0.88
    score_high: float = 0.95


DEFAULT = Thresholds()
NAMES = tuple(f.name for f in fields(Thresholds))
LIMITS = "_limits"
MOST_PERIODS = 10_000


class RulesTable:
    """Limits with periods of validity: rows ``valid_from`` (timestamp, inclusive) and any fields of
    ``Thresholds``. A period ends where the next begins; before the first the defaults hold, and so they do
    for fields that a row leaves null. Of rows with one ``valid_from`` the last in ``revision`` order counts,
    or with the highest values where the table has no such column.

    The table is an index for every event: its periods, at most ``MOST_PERIODS``, become one sorted row that
    is broadcast and searched by halves. A stream reads the table again with each micro-batch.
    """

    def __init__(self, table: DataFrame) -> None:
        given = [n for n in NAMES if n in table.columns]
        kinds = {f.name: "int" if f.type == "int" else "double" for f in fields(Thresholds)}
        limits = F.struct(*[
            F.coalesce(F.col(n).cast(kinds[n]) if n in given else F.lit(None), F.lit(getattr(DEFAULT, n))).alias(n) for n in NAMES])
        order = F.struct("revision", limits) if "revision" in table.columns else limits
        periods = table.where(F.col("valid_from").isNotNull()).groupBy(F.unix_micros("valid_from").alias("from_us")).agg(
            F.max_by(limits, order).alias("limits"))
        found = periods.agg(F.count("*").alias("n"), F.max("limits.failed_burst").alias("burst")).first()
        if found["n"] > MOST_PERIODS:
            raise ValueError(f"{found['n']} periods of rules; at most {MOST_PERIODS} are broadcast")
        self.n = found["n"]
        self.failed_burst = max(DEFAULT.failed_burst, found["burst"] or 0)
        self.index = periods.agg(F.sort_array(F.collect_list(F.struct("from_us", "limits"))).alias("_periods")).withColumn("_one", F.lit(1))

    def attach(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the struct ``LIMITS`` that holds at ``event_us``."""
        joined = rows.withColumn("_one", F.lit(1)).join(F.broadcast(self.index), "_one", "left").drop("_one")
        begins = F.transform("_periods", lambda p: p["from_us"])
        place = position_in(begins, F.col("event_us"), max(1, self.n))
        default = F.struct(*[F.lit(getattr(DEFAULT, n)).alias(n) for n in NAMES])
        return joined.withColumn(LIMITS, F.coalesce(F.get("_periods", place - 1)["limits"], default)).drop("_periods")

    @staticmethod
    def columns() -> Thresholds:
        """The limits of each row."""
        return Thresholds(**{n: F.col(LIMITS)[n] for n in NAMES})

# Rule names in the order findings are listed, with their severity.
SEVERITIES = {
    "IMPOSSIBLE_TRAVEL": "CRITICAL",
    "VELOCITY": "HIGH",
    "HIGH_VALUE": "HIGH",
    "NEW_DEVICE": "MEDIUM",
    "REPEATED_FAILURES": "MEDIUM",
}


def statuses_needed(limits: Thresholds | RulesTable) -> int:
    """Statuses a row must remember, the current one included."""
    return max(STATUS_TAIL, limits.failed_burst + 1)


def amount_value(columns: list[str]) -> Column:
    """The amount as a double, also where no money column holds it."""
    exact = F.col("amount").cast("double")
    return F.coalesce(exact, "amount_value") if "amount_value" in columns else exact


def speed_kmh() -> Column:
    seconds = F.col("seconds_since_prev")
    return F.when(seconds > 0, F.col("km_from_prev") / (seconds / 3600.0))


def conditions(limits: Thresholds = DEFAULT, value: Column | None = None) -> dict[str, Column]:
    """When each rule fires. Never null. ``value`` stands in where the amount is null."""
    average = cents(F.col("avg_amount_30d"))
    enough = cents(F.col("amount")) >= average * limits.times_average
    if value is not None:
        enough = F.coalesce(enough, value >= F.col("avg_amount_30d").cast("double") * limits.times_average)
    multiple = (average > 0) & enough
    statuses, burst = F.col("recent_statuses"), limits.failed_burst
    before = F.slice(statuses, F.greatest(F.size(statuses) - burst, F.lit(1)), burst)
    failed = (F.size(statuses) > burst) & F.forall(before, lambda s: s == "FAILED")
    found = {
        "IMPOSSIBLE_TRAVEL": (F.col("km_from_prev") > limits.distance_km) & (speed_kmh() > limits.speed_kmh),
        "VELOCITY": F.col("payment_velocity") >= limits.velocity,
        "HIGH_VALUE": (F.col("amount_zscore") >= limits.zscore) | multiple,
        "NEW_DEVICE": F.col("device_changed") & F.col("location_changed"),
        "REPEATED_FAILURES": (F.col("status") == "SUCCESS") & failed,
    }
    return {rule: F.coalesce(when, F.lit(False)) for rule, when in found.items()}


def _number(value: Column, places: int = 0, grouped: bool = False) -> Column:
    """Fixed-point text, ties to even."""
    text = F.format_number(value, places)
    return text if grouped else F.replace(text, F.lit(","), F.lit(""))


def reasons(limits: Thresholds = DEFAULT, light: bool = False, amount: Column | None = None) -> dict[str, Column]:
    """The text of each finding."""
    amount = F.col("amount").cast("double") if amount is None else amount
    lit, col = F.lit, F.col
    rupee = "Rs." if light else "₹"
    travel = F.concat(
        _number(col("km_from_prev")), lit(" km in "), col("seconds_since_prev").cast("string"), lit("s (~"),
        _number(speed_kmh()), lit(" km/h)"), lit("" if light else " between consecutive txns"))
    value = F.concat(
        lit(rupee), _number(amount, 0, True), lit(f" vs 30d avg {rupee}"),
        _number(col("avg_amount_30d").cast("double"), 0, True), lit(" (z="),
        _number(col("amount_zscore"), 1), lit(")"))
    city = F.coalesce("city", lit("None"))
    device = (F.concat(lit("new device in new city '"), city, lit("'")) if light else
              F.concat(lit("new device '"), F.coalesce("device", lit("None")), lit("' in new city '"), city,
                       lit("'")))
    return {
        "IMPOSSIBLE_TRAVEL": travel,
        "VELOCITY": F.concat(col("payment_velocity").cast("string"), lit(" transactions within 60 seconds")),
        "HIGH_VALUE": value,
        "NEW_DEVICE": device,
        "REPEATED_FAILURES": F.concat(
            lit(limits.failed_burst).cast("string"), lit(f" consecutive failures before {'' if light else 'a '}success")),
    }


def score_severity(score: Column, limits: Thresholds = DEFAULT) -> Column:
    return (F.when(score >= limits.score_high, "HIGH")
            .when(score >= limits.score_medium, "MEDIUM").otherwise("LOW"))


def evaluate(
    features: DataFrame, limits: Thresholds | RulesTable = DEFAULT, score_col: str | None = None, light: bool = False
) -> DataFrame:
    """Add ``findings``, ``rule_flagged`` (rules only), ``ml_flagged`` and ``is_flagged``.

    A null score gives no finding, so that a missing model leaves the rules working.
    """
    remembered = features.schema["recent_statuses"].metadata.get("tail", STATUS_TAIL)
    if limits.failed_burst >= remembered:
        raise ValueError(f"failed_burst={limits.failed_burst} needs features with tail > {limits.failed_burst}")
    if isinstance(limits, RulesTable):
        return _evaluated(limits.attach(features), limits.columns(), score_col, light).drop(LIMITS)
    return _evaluated(features, limits, score_col, light)


def _evaluated(features: DataFrame, limits: Thresholds, score_col: str | None, light: bool) -> DataFrame:
    value = amount_value(features.columns)
    text = reasons(limits, light, value)
    made = [
        F.when(when, F.struct(F.lit(rule).alias("rule"), F.lit(SEVERITIES[rule]).alias("severity"),
                              text[rule].alias("reason")))
        for rule, when in conditions(limits, value).items()
    ]
    ml_flagged = F.lit(False)
    if score_col:
        score = F.col(score_col)
        ml_flagged = F.coalesce(score >= limits.score, F.lit(False))
        made.append(F.when(ml_flagged, F.struct(
            F.lit("ML_SCORE").alias("rule"), score_severity(score, limits).alias("severity"),
            F.concat(F.lit("model fraud probability "), _number(score, 2)).alias("reason"))))
    findings = F.array_compact(F.array(*made)).cast("array<" + FINDING.simpleString() + ">")
    by_rule = F.exists("findings", lambda f: f["rule"] != "ML_SCORE")
    return (
        features.withColumn("findings", findings)
        .withColumns({"rule_flagged": by_rule, "ml_flagged": ml_flagged,
                      "is_flagged": F.size("findings") > 0})
    )
