"""Calendar parts and period labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ISO weekday names, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def month_of(ts: Column) -> Column:
    return F.month(ts).cast("int")


def hour_of(ts: Column) -> Column:
    return F.hour(ts).cast("int")


def iso_weekday(ts: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return (F.weekday(ts) + F.lit(1)).cast("int")


def weekday_name(number: Column) -> Column:
    """English name of an ISO weekday number, NULL outside 1..7."""
    names = F.array(*[F.lit(n) for n in WEEKDAYS])
    return F.when(number.between(1, 7), F.element_at(names, F.when(number.between(1, 7), number)))


def period_ordinal(year: Column, month: Column) -> Column:
    """Months since year 0."""
    return (year * F.lit(12) + month - F.lit(1)).cast("bigint")


def period_key(year: Column, month: Column) -> Column:
    """``YYYY-MM``"""
    return F.format_string("%d-%02d", year.cast("bigint"), month.cast("int"))


def first_day(year: Column, month: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def period_label(year: Column, month: Column) -> Column:
    """``Jan 2024``"""
    return F.date_format(first_day(year, month), "MMM yyyy")


def period_long_label(year: Column, month: Column) -> Column:
    """``January 2024``"""
    return F.date_format(first_day(year, month), "MMMM yyyy")
