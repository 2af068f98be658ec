"""Selections over the cubes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import calendar as cal
from ..spec import FilterSpec, ordinal, period_text


class UnsupportedFilter(ValueError):
    """The selection names a column the cube does not have."""


def metric(f: FilterSpec, total: str | Column = "total_crimes",
           arrests: str | Column = "total_arrests") -> Column:
    """The counted measure: all records, those with an arrest, or those without."""
    total = F.col(total) if isinstance(total, str) else total
    arrests = F.col(arrests) if isinstance(arrests, str) else arrests
    if f.arrest is None:
        return total
    return arrests if f.arrest else total - arrests


def unsupported(cube: DataFrame, f: FilterSpec) -> list[str]:
    """Filters of ``f`` that cannot be applied to ``cube``."""
    missing = [c for c in ("district", "community_area")
               if getattr(f, c) is not None and c not in cube.columns]
    if "month" not in cube.columns and (f.start or f.end):
        missing.insert(0, "period")
    return missing


def in_period(f: FilterSpec) -> Column:
    """Inclusive month range. The bare year bounds are implied and reach the Parquet scan."""
    year, months = F.col("year"), cal.period_ordinal(F.col("year"), F.col("month"))
    keep = F.lit(True)
    if f.start:
        keep = keep & (year >= ordinal(f.start) // 12) & (months >= ordinal(f.start))
    if f.end:
        keep = keep & (year <= ordinal(f.end) // 12) & (months <= ordinal(f.end))
    return keep


def in_dimensions(cube: DataFrame, f: FilterSpec, skip: tuple[str, ...] = ()) -> Column:
    """Equality on every chosen dimension the cube has, the period and year aside."""
    keep = F.lit(True)
    for name in ("district", "community_area", "primary_type"):
        wanted = getattr(f, name)
        if wanted is not None and name in cube.columns and name not in skip:
            keep = keep & (F.col(name) == wanted)
    if f.domestic is not None and "domestic" not in skip:
        keep = keep & (F.col("domestic") == int(f.domestic))
    return keep


def in_scope(cube: DataFrame, f: FilterSpec) -> Column:
    """Period and year."""
    keep = in_period(f) if "month" in cube.columns else F.lit(True)
    return keep if f.year is None else keep & (F.col("year") == f.year)


def apply_filter(cube: DataFrame, f: FilterSpec, skip: tuple[str, ...] = (),
                 ignore_unsupported: bool = False) -> DataFrame:
    """Rows of ``cube`` in the selection.

    A filter on a column the cube lacks is an error, unless it is to be ignored (the time
    cube has no place, the year cube no month; a caller then reports ``unsupported``).
    """
    missing = unsupported(cube, f)
    if missing and not ignore_unsupported:
        raise UnsupportedFilter(f"not available at this grain: {', '.join(missing)}")
    return cube.where(in_scope(cube, f) & in_dimensions(cube, f, skip))


def period_bounds(cube: DataFrame) -> DataFrame:
    """One row: first and last month as ordinals and as ``YYYY-MM``."""
    months = cal.period_ordinal(F.col("year"), F.col("month"))
    text = lambda c: cal.period_key(F.floor(F.col(c) / 12), F.col(c) % 12 + 1)
    return (cube.agg(F.min(months).alias("low"), F.max(months).alias("high"))
            .select("low", "high", text("low").alias("low_period"), text("high").alias("high_period")))


def resolve(cube: DataFrame, f: FilterSpec) -> FilterSpec:
    """``f`` with its period clamped to the cube's range (one row is read)."""
    bounds = period_bounds(cube).first()
    if bounds["low"] is None:
        return f
    return f.resolved(period_text(bounds["low"]), period_text(bounds["high"]))


def matching_total(cube: DataFrame, f: FilterSpec, low: str, high: str) -> DataFrame:
    """One row: records in the selection, and whether and by what it is narrowed."""
    active = f.active(low, high)
    total = apply_filter(cube, f).agg(
        F.coalesce(F.sum(metric(f)), F.lit(0)).cast("bigint").alias("matching"))
    return total.select("matching", F.lit(bool(active)).alias("is_filtered"),
                        F.lit(",".join(active)).alias("active_filters"))
