"""Small column expressions shared by the marts, the plan and the reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def weekday_number(date: Column) -> Column:
    """Monday 1 to Sunday 7, as BIGINT."""
    return (F.weekday(date) + 1).cast("bigint")


def day_type(date: Column) -> Column:
    return F.when(F.weekday(date) >= 5, F.lit("Weekend")).otherwise(F.lit("Weekday"))


def week_start(date: Column) -> Column:
    """The Monday of the date's week, as DATE."""
    return F.trunc(date, "week")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is null for a zero denominator."""
    return F.try_divide(numerator, denominator)


def display_round(value: Column, digits: int) -> Column:
    """Round half away from zero on the scaled double, which keeps ties such as 1.005 low."""
    scale = float(10**digits)
    return F.round(value * scale, 0) / scale


def fixed_text(value: Column, digits: int = 1, thousands: bool = False) -> Column:
    """Number text with a fixed count of decimals; ties go to the even digit."""
    text = F.format_number(value, digits)
    return text if thousands else F.replace(text, F.lit(","), F.lit(""))


def at_least_zero(value: Column) -> Column:
    """Clip below at zero; null stays null, which a bare ``greatest`` would not keep."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))
