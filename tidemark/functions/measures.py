"""Counts and rates shared by the roll-ups and by the checks on them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rate_pct(numerator: Column, denominator: Column) -> Column:
    """Percentage rounded to two digits in binary floating point; NULL for an empty base.

    Scaling before rounding to an integer keeps ties identical everywhere the rate is
    recomputed (23 of 4000 is 0.57), which the tolerance check relies on.
    """
    hundred = F.lit(100.0)
    return F.round(hundred * numerator / F.nullif(denominator, F.lit(0)) * hundred) / hundred


def share(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as a double, NULL when there is nothing to share."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double") * F.lit(100.0))


def count_where(condition: Column) -> Column:
    """Rows for which ``condition`` is true, as BIGINT."""
    return F.count(F.when(condition, F.lit(1)))


def outcome_measures(key: Column, arrest: Column) -> list[Column]:
    """The three measures every roll-up carries."""
    total, arrests = F.count(key), F.count(F.when(arrest, key))
    return [total.alias("total_crimes"), arrests.alias("total_arrests"),
            rate_pct(arrests, total).alias("arrest_rate")]


def grid_bin(c: Column, scale: float) -> Column:
    """Lower corner of the grid cell that holds ``c``."""
    return F.floor(c * F.lit(scale)).cast("double") / F.lit(scale)
