"""Gold roll-ups and the cubes the interactive analytics run on.

All group by few distinct values, so the map side reduces each task's rows to at most one
per group before anything is shuffled, however skewed the groups are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import calendar as cal
from ..functions.measures import count_where, grid_bin, outcome_measures, rate_pct
from ..spec import ModelSpec
from .standardize import area_district, cube_community, cube_district


def outcome_rollup(silver: DataFrame, keys: list[Column]) -> DataFrame:
    """Records, arrests and arrest rate by ``keys``."""
    return silver.groupBy(*keys).agg(*outcome_measures(F.col("crime_id"), F.col("arrest")))


def monthly_rollup(silver: DataFrame) -> DataFrame:
    return outcome_rollup(silver, [
        F.col("year"), cal.month_of(F.col("date")).alias("month"), F.col("primary_type")])


def area_rollup(silver: DataFrame, m: ModelSpec) -> DataFrame:
    return outcome_rollup(silver, [
        F.col("year"), area_district(F.col("district"), m).alias("district")])


def outcome_by_type(silver: DataFrame) -> DataFrame:
    return outcome_rollup(silver, [F.col("year"), F.col("primary_type"), F.col("domestic")])


def time_rollup(silver: DataFrame) -> DataFrame:
    """By ISO weekday and hour; the weekday's name is added after the aggregation."""
    by_number = outcome_rollup(silver, [
        cal.iso_weekday(F.col("date")).alias("day_of_week_number"),
        cal.hour_of(F.col("date")).alias("hour_of_day")])
    return by_number.select(
        "day_of_week_number",
        cal.weekday_name(F.col("day_of_week_number")).alias("day_of_week"),
        "hour_of_day", "total_crimes", "total_arrests", "arrest_rate")


def grid_rollup(silver: DataFrame, m: ModelSpec) -> DataFrame:
    """By grid cell, for records with both coordinates."""
    located = silver.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return outcome_rollup(located, [
        grid_bin(F.col("latitude"), m.bin_scale).alias("lat_bin"),
        grid_bin(F.col("longitude"), m.bin_scale).alias("long_bin")])


# Gold tables in build order: name (a fixed value), roll-up, grain.
GOLD: dict[str, tuple[Callable[[DataFrame, ModelSpec], DataFrame], tuple[str, ...]]] = {
    "gold_monthly_crime_trends": (
        lambda s, m: monthly_rollup(s), ("year", "month", "primary_type")),
    "gold_area_crime_summary": (area_rollup, ("year", "district")),
    "gold_arrest_analysis": (
        lambda s, m: outcome_by_type(s), ("year", "primary_type", "domestic")),
    "gold_time_patterns": (
        lambda s, m: time_rollup(s), ("day_of_week_number", "day_of_week", "hour_of_day")),
    "gold_crime_hotspots": (grid_rollup, ("lat_bin", "long_bin")),
}


def gold_tables(silver: DataFrame, m: ModelSpec) -> dict[str, DataFrame]:
    return {name: build(silver, m) for name, (build, _) in GOLD.items()}


# What is counted in one pass over Silver: the Gold grains themselves, without the weekday's name, which follows from
# the number. Calendar, codes and grid bound their groups, so that a task sends few rows however many it reads; a common
# finer grain has nearly a group for each row.
PARENTS: dict[str, tuple[str, ...]] = {
    name: tuple(c for c in grain if c != "day_of_week") for name, (_, grain) in GOLD.items()}


def parent_rollups(silver: DataFrame, m: ModelSpec, sign: Column | None = None) -> DataFrame:
    """Additive counts at the grains of Gold, ``parent`` naming the table, in one pass over Silver.

    With ``sign`` (1 or -1 for a row) they are changes of the counts. Groups are bounded by calendar, codes and
    grid, and each task reduces its rows to them first. Columns that are not of a grain are NULL. The area table's
    districts are normalised already; a row without both coordinates has no bins.
    """
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    one = F.when(F.col("crime_id").isNotNull(), F.lit(1) if sign is None else sign)
    rows = silver.select(
        F.col("year"), cal.month_of(F.col("date")).alias("month"), F.col("primary_type"), F.col("domestic"),
        cal.iso_weekday(F.col("date")).alias("day_of_week_number"), cal.hour_of(F.col("date")).alias("hour_of_day"),
        area_district(F.col("district"), m).alias("district"),
        F.when(located, grid_bin(F.col("latitude"), m.bin_scale)).alias("lat_bin"),
        F.when(located, grid_bin(F.col("longitude"), m.bin_scale)).alias("long_bin"),
        one.alias("one"), F.when(F.col("arrest"), one).alias("arrested"))
    keys = [c for c in rows.columns if c not in ("one", "arrested")]
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    sets = [[F.col(k) for k in grain] for grain in PARENTS.values()]
    absent = lambda grain: [F.grouping(k) == int(k not in grain) for k in keys]
    names = [F.when(reduce(Column.__and__, absent(grain)), F.lit(name)) for name, grain in PARENTS.items()]
    return rows.groupingSets(sets, *keys).agg(
        F.coalesce(*names).alias("parent"), total("one").alias("total_crimes"), total("arrested").alias("total_arrests"))


def _summed(df: DataFrame, grain: tuple[str, ...]) -> DataFrame:
    total, arrests = F.sum("total_crimes"), F.sum("total_arrests")
    return df.groupBy(*grain).agg(
        total.alias("total_crimes"), arrests.alias("total_arrests"), rate_pct(arrests, total).alias("arrest_rate"))


def from_parent(name: str, parents: DataFrame) -> DataFrame:
    """A Gold table from its parent; equal to the roll-up of Silver itself."""
    counts = parents.where(F.col("parent") == name)
    if "lat_bin" in GOLD[name][1]:
        counts = counts.where(F.col("lat_bin").isNotNull())
    if "day_of_week" in GOLD[name][1]:
        counts = counts.withColumn("day_of_week", cal.weekday_name(F.col("day_of_week_number")))
    return _summed(counts, GOLD[name][1])


def maintained(name: str, stored: DataFrame, changes: DataFrame) -> DataFrame:
    """The Gold table ``name`` after rows of Silver were replaced.

    ``changes`` are signed parents: what the old rows gave is taken off the stored counts, what the new ones give
    is added; a group without records goes. Rates follow from the counts. Equal to a rebuild, without reading the
    rest of Silver.
    """
    return _summed(stored.unionByName(from_parent(name, changes)), GOLD[name][1]).where(F.col("total_crimes") > 0)


# --- cubes -------------------------------------------------------------------------


def _cube(silver: DataFrame, keys: list[Column]) -> DataFrame:
    return silver.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_crimes"),
        F.sum(F.col("arrest").cast("int")).alias("total_arrests"))


def _place_keys() -> list[Column]:
    return [cube_district(F.col("district")).alias("district"),
            cube_community(F.col("community_area")).alias("community_area"),
            F.col("primary_type"),
            F.col("domestic").cast("int").alias("domestic")]


def month_geo_cube(silver: DataFrame) -> DataFrame:
    """Records and arrests by month, place, type and domestic flag."""
    return _cube(silver, [F.col("year"), cal.month_of(F.col("date")).alias("month"),
                          *_place_keys()])


def geo_cube(silver: DataFrame) -> DataFrame:
    """Records and arrests by year, place, type and domestic flag."""
    return _cube(silver, [F.col("year"), *_place_keys()])


def geo_cube_from_months(months: DataFrame) -> DataFrame:
    """The year cube as a roll-up of the month cube, without another pass over Silver."""
    return (months.groupBy("year", "district", "community_area", "primary_type", "domestic")
            .agg(F.sum("total_crimes").alias("total_crimes"),
                 F.sum("total_arrests").alias("total_arrests")))


def time_cube(silver: DataFrame) -> DataFrame:
    """Records and arrests by month, type, domestic flag, ISO weekday and hour."""
    return _cube(silver, [
        F.col("year"), cal.month_of(F.col("date")).alias("month"), F.col("primary_type"),
        F.col("domestic").cast("int").alias("domestic"),
        cal.iso_weekday(F.col("date")).alias("day"), cal.hour_of(F.col("date")).alias("hour")])


# --- distinct values of any selection ----------------------------------------------


def distinct_cube(silver: DataFrame, column: str, keys: list[str], lg_size: int = 12) -> DataFrame:
    """By ``keys`` a sketch of the distinct values of ``column``. Sketches merge, distinct counts do not add up:
    one pass over Silver answers every later selection of whole groups. NULL values do not count.

    A sketch holds at most 2^``lg_size`` registers; the standard error is 1.04 / 2^(``lg_size`` / 2).
    """
    return silver.groupBy(*keys).agg(F.hll_sketch_agg(F.col(column), F.lit(lg_size)).alias("sketch"))


def distinct_estimate(cube: DataFrame, by: list[str]) -> DataFrame:
    """By ``by`` the estimated distinct values (``approx_distinct``) over the groups selected. The exact count stays
    ``countDistinct`` on Silver."""
    return cube.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"))


# --- totals ------------------------------------------------------------------------


def profile(silver: DataFrame) -> DataFrame:
    """One row of coverage figures.

    One pass: rows are summed by key and dimensions, which needs no shuffle where the table is
    partitioned by key, then by dimensions, which a task reduces to few rows.
    """
    places = ["primary_type", "district", "community_area"]
    keyed = silver.groupBy("crime_id", *places).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("first"), F.max("date").alias("last"),
        F.max("updated_on").alias("updated"),
        F.sum(F.col("arrest").cast("int")).alias("arrests"),
        F.sum(F.col("domestic").cast("int")).alias("domestics"),
        F.count("latitude").alias("located"))
    by_key = Window.partitionBy("crime_id").orderBy(*places)
    new_key = (F.row_number().over(by_key) == 1) & F.col("crime_id").isNotNull()
    dims = keyed.withColumn("new_key", new_key.cast("int")).groupBy(*places).agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.max("updated").alias("updated"), F.sum("arrests").alias("arrests"),
        F.sum("domestics").alias("domestics"), F.sum("located").alias("located"),
        F.sum("new_key").alias("keys"))
    return dims.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.min("first").alias("min_date"), F.max("last").alias("max_date"),
        F.max("updated").alias("last_updated"),
        F.countDistinct("primary_type").alias("crime_types"),
        F.countDistinct("district").alias("districts"),
        F.countDistinct("community_area").alias("communities"),
        F.sum("arrests").alias("arrests"),
        F.sum("domestics").alias("domestic_incidents"),
        F.coalesce(F.sum("located"), F.lit(0)).cast("bigint").alias("geocoded_rows"),
        F.coalesce(F.sum("keys"), F.lit(0)).cast("bigint").alias("unique_ids"))


LOCATED = ("latitude", "longitude")


def total_parts() -> dict[str, Column]:
    """What ``silver_totals`` is made of, as sums and extremes that may be taken group by group first."""
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    arrested = F.col("arrest")
    return {
        "all_crimes": F.count(F.lit(1)), "all_arrests": count_where(arrested),
        "hotspot_crimes": count_where(located), "hotspot_arrests": count_where(located & arrested),
        **{f"minimum_{c}": F.min(c) for c in LOCATED}, **{f"maximum_{c}": F.max(c) for c in LOCATED}}


def totals_of(parts: list[str], m: ModelSpec) -> list[Column]:
    """The totals from rows of ``parts``."""
    made = []
    for name in parts:
        if name.startswith(("minimum", "maximum")):
            extreme, _, c = name.partition("_")
            best = F.min(name) if extreme == "minimum" else F.max(name)
            made.append(grid_bin(best, m.bin_scale).alias(f"{extreme}_{'lat' if c == 'latitude' else 'long'}_bin"))
        else:
            made.append(F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name))
    return made


def silver_totals(silver: DataFrame, m: ModelSpec) -> DataFrame:
    """One row: what the Gold tables must add up to, and the range of the grid."""
    parts = total_parts()
    return silver.agg(*[c.alias(name) for name, c in parts.items()]).agg(*totals_of(list(parts), m))


def value_lists(monthly: DataFrame, area: DataFrame, silver: DataFrame) -> DataFrame:
    """Distinct values offered as filters, as ``(dimension, value)`` rows in order."""
    one = lambda df, name, c: df.select(
        F.lit(name).alias("dimension"), F.col(c).cast("string").alias("value")).distinct()
    communities = silver.where(F.col("community_area").isNotNull())
    return (one(monthly, "primary_type", "primary_type")
            .unionByName(one(monthly, "year", "year"))
            .unionByName(one(area, "district", "district"))
            .unionByName(one(communities, "community_area", "community_area"))
            .orderBy(F.col("dimension").asc_nulls_last(), F.col("value").asc_nulls_last()))
