"""The published bundle: the aggregates and cubes the interactive analytics read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import geo, quality, rollups
from ..session import together
from ..sources import exports, snapshots
from .refresh import SILVER


def open_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Silver and the Gold tables of the current snapshot; an error if one is missing."""
    manifest = snapshots.current(spark, root)
    return {name: snapshots.read_table(spark, snapshots.resolve(manifest, name))
            for name in (*rollups.GOLD, SILVER)}


CUBES = {"cube_months": rollups.month_geo_cube, "cube_times": rollups.time_cube}


def publish_cubes(spark: SparkSession, root: str) -> snapshots.Manifest:
    """Publish the cubes of the current Silver in folders by year, so that a selection reads only its years.

    A year's rows are brought together first, which makes one file a year: cubes are bounded by codes and calendar.
    """
    parent, run_id = snapshots.current(spark, root), f"cubes-{uuid.uuid4().hex}"
    silver = snapshots.read_table(spark, snapshots.resolve(parent, SILVER))
    refs = together([lambda n=n, f=f: snapshots.write_table(f(silver).repartition("year"), root, run_id, n, ("year",))
                     for n, f in CUBES.items()])
    return snapshots.promote(spark, root, run_id, parent, dict(zip(CUBES, refs)))


GRID = "grid_by_place"


def publish_grid(spark: SparkSession, root: str, scale: float, files: int | None = None) -> snapshots.Manifest:
    """Publish the cells of the current snapshot in order of space, so that a map view reads only its part."""
    parent, run_id = snapshots.current(spark, root), f"grid-{uuid.uuid4().hex}"
    cells = snapshots.read_table(spark, snapshots.resolve(parent, "gold_crime_hotspots"))
    ref = snapshots.write_table(geo.space_ordered(cells, scale, files), root, run_id, GRID)
    return snapshots.promote(spark, root, run_id, parent, {GRID: ref})


# The order datasets are published in; NULLs come last.
ORDER = {
    "monthly": ("year", "month", "primary_type"),
    "area": ("year", "district"),
    "arrest": ("year", "primary_type", "domestic"),
    "time": ("day_of_week_number", "hour_of_day"),
    "geo_cube": ("year", "district", "community_area", "primary_type", "domestic"),
    "monthly_geo": ("year", "month", "district", "community_area", "primary_type", "domestic"),
    "time_cube": ("year", "month", "primary_type", "domestic", "day", "hour"),
}


def ordered(name: str, df: DataFrame) -> DataFrame:
    """A dataset in its published order. Only roll-ups are ever sorted as a whole."""
    if name == "hotspots":
        return df.orderBy(F.col("total_crimes").desc_nulls_last(), "lat_bin", "long_bin")
    if name not in ORDER:
        return df
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in ORDER[name]])


def _meta(silver: DataFrame, grid: DataFrame) -> DataFrame:
    """Coverage figures with the located total of the grid."""
    located = grid.agg(F.sum("total_crimes")).scalar()
    return rollups.profile(silver).withColumns({
        "hotspot_total": located, "refresh_mode": F.lit("Automated daily pipeline")})  # fixed value


def datasets(tables: dict[str, DataFrame], source: str) -> dict[str, DataFrame]:
    """All published datasets. The year cube is a roll-up of the month cube."""
    silver = tables[SILVER]
    months = rollups.month_geo_cube(silver)
    monthly, area = tables["gold_monthly_crime_trends"], tables["gold_area_crime_summary"]
    return {
        "meta": _meta(silver, tables["gold_crime_hotspots"]),
        "monthly": monthly,
        "area": area,
        "arrest": tables["gold_arrest_analysis"].withColumn("domestic", F.col("domestic").cast("int")),
        "time": tables["gold_time_patterns"],
        "values": rollups.value_lists(monthly, area, silver),
        "hotspots": tables["gold_crime_hotspots"],
        "monthly_geo": months,
        "time_cube": rollups.time_cube(silver),
        "inventory": exports.inventory(tables, source),
    }


def build(spark: SparkSession, tables: dict[str, DataFrame], out: str,
          source: str) -> dict[str, str]:
    """Check that the totals agree, then export every dataset; returns their paths.

    Every build has a folder of its own and counts once a manifest under ``out`` names it, so a
    rebuild replaces all datasets at once and a crash midway leaves the bundle before.
    """
    before, build_id = snapshots.current(spark, out), f"build-{uuid.uuid4().hex}"
    folder = snapshots.run_folder(out, build_id)
    quality.require_publishable(tables[SILVER], tables["gold_monthly_crime_trends"],
                                tables["gold_area_crime_summary"])
    frames = datasets(tables, source)
    paths = {name: f"{folder}/{name}" for name in frames}
    together([lambda n=n, f=f: exports.export_json(ordered(n, f), paths[n]) for n, f in frames.items()])
    months = exports.read_export(spark, paths["monthly_geo"], frames["monthly_geo"].schema)
    paths["geo_cube"] = f"{folder}/geo_cube"
    frames["geo_cube"] = rollups.geo_cube_from_months(months)
    exports.export_json(ordered("geo_cube", frames["geo_cube"]), paths["geo_cube"])
    snapshots.promote(spark, out, build_id, before, {
        name: snapshots.TableRef(path, frames[name].schema.json()) for name, path in paths.items()})
    return paths


def latest(spark: SparkSession, out: str) -> dict[str, str]:
    """Paths of the datasets of the last complete build."""
    return {name: ref.path for name, ref in snapshots.current(spark, out).tables.items()}


def open_parquet(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The same tables from plain Parquet files, one per table."""
    names = {name: name for name in rollups.GOLD} | {SILVER: "silver_crimes_full"}
    return {table: spark.read.parquet(f"{folder.rstrip('/')}/{file}.parquet")
            for table, file in names.items()}
