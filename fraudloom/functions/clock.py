"""Time text and clock fields, independent of the session time zone."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fraudloom.functions.exact import int_div

SECOND_US = 1_000_000
HOUR_US = 3_600 * SECOND_US
DAY_US = 24 * HOUR_US

# Fixed value: calendar date, optional clock, optional offset, in extended or basic ISO form.
ISO_FORM = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:.(\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d+))?)?)?"
    r"(?:(Z)|([+-])(\d{2})(?:(:?)(\d{2})(?:\13(\d{2})(?:[.,](\d+))?)?)?)?)?$"
)
ISO_PARTS = "$1-$3-$4|$5|$7|$8|$9|$11|$12|$14|$15|$16"
# Fixed value: the form nearly all events have.
COMMON_FORM = r"^(?!0000)\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?[+-]\d{2}:\d{2}$"
# Fixed value: ISO year and week, optional weekday.
WEEK_FORM = r"^(\d{4})(-?)W(\d{2})(?:\2(\d))?"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _week_to_calendar(text: Column) -> Column:
    """Rewrite a leading ISO week date as a calendar date; null if there is no such week."""
    year = F.regexp_extract(text, WEEK_FORM, 1)
    week = F.regexp_extract(text, WEEK_FORM, 3).try_cast("int")
    day = F.coalesce(F.nullif(F.regexp_extract(text, WEEK_FORM, 4), F.lit("")), F.lit("1")).try_cast("int")
    fourth = F.concat(year, F.lit("-01-04")).try_cast("date")
    monday = F.date_sub(fourth, F.weekday(fourth))
    found = F.date_add(monday, (week - 1) * 7 + day - 1)
    last_week = F.weekofyear(F.concat(year, F.lit("-12-28")).try_cast("date"))
    ok = week.between(1, last_week) & day.between(1, 7)
    return F.when(ok, F.concat(F.date_format(found, "yyyy-MM-dd"), F.regexp_replace(text, WEEK_FORM, "")))


def _micros(digits: Column) -> Column:
    return F.rpad(F.substring(digits, 1, 6), 6, "0")


def _read_parts(part: Column) -> Column:
    def piece(i: int, default: str) -> Column:
        return F.coalesce(F.nullif(F.get(part, F.lit(i)), F.lit("")), F.lit(default))

    clock = F.concat(
        piece(0, ""), F.lit(" "), piece(1, "00"), F.lit(":"), piece(2, "00"), F.lit(":"),
        piece(3, "00"), F.lit("."), _micros(piece(4, "0")), F.lit("Z"),
    )
    hours, minutes, seconds = (piece(i, "0").cast("bigint") for i in (6, 7, 8))
    size = (hours * 3600 + minutes * 60 + seconds) * SECOND_US + _micros(piece(9, "0")).cast("bigint")
    shift = F.when(piece(5, "+") == "-", -size).otherwise(size)
    # A missing date must not reach the cast: Spark reads a bare clock as today.
    usable = part.isNotNull() & (hours < 24) & (minutes < 60) & (seconds < 60) & ~piece(0, "").startswith("0000")
    local = F.when(usable, F.unix_micros(clock.try_cast("timestamp")))
    return F.struct(local.alias("local_us"), shift.alias("shift_us"))


def parse_iso(text: Column) -> Column:
    """``struct(event_us, local_us)`` of ISO-8601 text; both null if it is not one.

    ``local_us`` is the wall clock written in the text, ``event_us`` the instant. Text without an
    offset is UTC. The zone is applied by arithmetic: Spark's own cast stops at offsets of 18 hours.
    """
    def split_parts(day: Column) -> Column:
        return F.when(day.rlike(ISO_FORM), F.split(F.regexp_replace(day, ISO_FORM, ISO_PARTS), r"\|"))

    def instant(read: Column) -> Column:
        return F.struct((read["local_us"] - read["shift_us"]).alias("event_us"), read["local_us"].alias("local_us"))

    calendar = bind(text, lambda t: F.when(t.rlike(WEEK_FORM), _week_to_calendar(t)).otherwise(t))
    parts = bind(calendar, split_parts)
    return bind(bind(parts, _read_parts), instant)


def parse_common_iso(text: Column) -> Column:
    """``parse_iso`` for the common form, null for all else: two casts and no string work."""
    local = F.concat(F.substring(text, F.lit(1), F.length(text) - 6), F.lit("Z"))
    event_us, local_us = (F.unix_micros(t.try_cast("timestamp")) for t in (text, local))
    read = F.struct(event_us.alias("event_us"), local_us.alias("local_us"))
    return F.when(text.rlike(COMMON_FORM) & event_us.isNotNull() & local_us.isNotNull(), read)


def iso_utc(event_us: Column) -> Column:
    """Instant as ISO text in UTC (needs a UTC session)."""
    return F.date_format(F.timestamp_micros(event_us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def is_weekend(local_us: Column) -> Column:
    days = int_div(local_us - F.pmod(local_us, F.lit(DAY_US)), F.lit(DAY_US))
    return F.pmod(days + 3, F.lit(7)) >= 5


def is_night(local_us: Column) -> Column:
    hour = int_div(F.pmod(local_us, F.lit(DAY_US)), F.lit(HOUR_US))
    return (hour >= 23) | (hour < 5)
