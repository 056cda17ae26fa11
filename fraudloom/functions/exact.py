"""Rounding on integers, so that ties never depend on float noise."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(num: Column, den: Column) -> Column:
    """Integer division, truncating toward zero."""
    return F.call_function("div", num, den)


def half_up(num: Column, den: Column) -> Column:
    """``num / den`` to the nearest integer, ties up; for num >= 0 and den > 0."""
    return int_div(num * 2 + den, den * 2)


def cents(amount: Column) -> Column:
    return (amount * 100).cast("bigint")


def money(whole_cents: Column, precision: int = 14) -> Column:
    hundred = F.lit(100).cast("decimal(3,0)")
    return (whole_cents.cast("decimal(20,0)") / hundred).cast(f"decimal({precision},2)")


def mean_money(amount: Column, precision: int = 14) -> Column:
    """Aggregate: average of a money column to two places; null on no rows."""
    total = (F.sum(amount) * 100).cast("decimal(38,0)")
    return money(half_up(total, F.nullif(F.count(amount), F.lit(0))), precision)


def std_money(amount: Column) -> Column:
    """Aggregate: population standard deviation to two places.

    Deviations are taken from the whole-cent mean ``m``: the sum of their squares is
    ``sum(c * c) - 2 * m * sum(c) + n * m * m`` in exact integers, so nothing large is subtracted in
    doubles. Up to 5 * 10^9 amounts below 10^12 fit 38 digits.
    """
    c = cents(amount).cast("decimal(19,0)")
    total = F.sum(c).cast("decimal(38,0)")
    return std_from(F.count(amount), total, F.sum((c * c).cast("decimal(28,0)")).cast("decimal(38,0)"))


def std_from(count: Column, total: Column, squares: Column) -> Column:
    """The same from the number of amounts, the sum of their cents and of the squares of these."""
    n = F.nullif(count, F.lit(0))
    mean = int_div(total, n).cast("decimal(15,0)")
    whole = n.cast("decimal(10,0)")

    def product(*factors: Column) -> Column:
        made = factors[0]
        for factor in factors[1:]:
            made = (made * factor).cast("decimal(38,0)")
        return made

    apart = (squares - product(mean, total)).cast("decimal(38,0)")
    apart = (apart - (product(mean, total) - product(mean, mean, whole)).cast("decimal(38,0)")).cast("decimal(38,0)")
    rest = (total - product(mean, whole)).cast("double")
    spread = F.greatest(apart.cast("double") - rest * rest / n, F.lit(0.0))
    return F.round(F.sqrt(spread / n) / 100, 2)


def percent(num: Column, den: Column, places: int = 2) -> Column:
    """``100 * num / den`` rounded half up to ``places``; null when ``den`` is zero."""
    scale = 10**places
    return half_up(num * (100 * scale), F.nullif(den, F.lit(0))).cast("double") / float(scale)


def whole_money(total: Column) -> Column:
    """A money total rounded half up to whole units."""
    return F.round(total, 0).cast("decimal(18,0)")
