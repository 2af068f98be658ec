"""Map views of the grid roll-up: pixel clusters and heat zones, and a layout in which a view reads only its part."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import projection as proj
from ..spec import Viewport

MARGIN = 30.0        # pixels around the window that still count as visible
# Sizes and quantile of the map view; radii below are fixed as well.
CLUSTER_CELL = 34.0  # pixels
HEAT_QUANTILE = 0.96


def project(grid: DataFrame, zoom: int) -> DataFrame:
    """World pixels of each cell's lower corner."""
    return grid.withColumns({"x": proj.mercator_x(F.col("long_bin"), zoom),
                             "y": proj.mercator_y(F.col("lat_bin"), zoom)})


def unproject(points: DataFrame, zoom: int) -> DataFrame:
    """Coordinates of world pixels."""
    return points.withColumns({"longitude": proj.longitude_at(F.col("x"), zoom),
                               "latitude": proj.latitude_at(F.col("y"), zoom)})


def visible(grid: DataFrame, view: Viewport) -> DataFrame:
    """Cells inside the window or its margin, in window pixels."""
    left, top = proj.window_origin(view.latitude, view.longitude, view.zoom,
                                   view.width, view.height)
    placed = project(grid, view.zoom).withColumns(
        {"x": F.col("x") - F.lit(left), "y": F.col("y") - F.lit(top)})
    return placed.where(F.col("x").between(-MARGIN, view.width + MARGIN)
                        & F.col("y").between(-MARGIN, view.height + MARGIN))


# --- cells in order of space --------------------------------------------------------

PLACE_KEY = "place_key"
KEY_BITS = 31          # of a row's and of a column's number: enough for cells of a ten-millionth of a degree
VIEW_RANGES = 32       # key ranges a view is covered by, at most


def _number(degrees: Column, lowest: float, scale: float) -> Column:
    """Number of the cell whose lower corner is at ``degrees``; what lies outside the globe counts as its edge."""
    cell = F.round((degrees - F.lit(lowest)) * F.lit(scale)).cast("bigint")
    return F.greatest(F.lit(0), F.least(F.lit((1 << KEY_BITS) - 1), cell))


def _spread(number: Column) -> Column:
    """The bits of a number, each followed by a free one."""
    for shift in (16, 8, 4, 2, 1):
        every = sum(((1 << shift) - 1) << place for place in range(0, 62, 2 * shift)) & ((1 << 62) - 1)
        number = F.shiftleft(number, shift).bitwiseOR(number).bitwiseAND(F.lit(every))
    return number


def place_key(lat_bin: Column, long_bin: Column, scale: float) -> Column:
    """The cell's place on a curve that fills squares one after the other: the bits of its row and its column in turn.

    Cells of an aligned square of 2^n by 2^n cells have consecutive keys. Unknown corners have no key.
    """
    row, column = _number(lat_bin, -90.0, scale), _number(long_bin, -180.0, scale)
    return F.when(lat_bin.isNotNull() & long_bin.isNotNull(), F.shiftleft(_spread(row), 1).bitwiseOR(_spread(column)))


def space_ordered(grid: DataFrame, scale: float, files: int | None = None) -> DataFrame:
    """Cells with their key, range-partitioned and sorted by it: written as Parquet, files and row groups hold short
    ranges of keys. ``files`` as in ``repartitionByRange``."""
    keyed = grid.withColumn(PLACE_KEY, place_key(F.col("lat_bin"), F.col("long_bin"), scale))
    by = F.col(PLACE_KEY)
    dealt = keyed.repartitionByRange(by) if files is None else keyed.repartitionByRange(files, by)
    return dealt.sortWithinPartitions(PLACE_KEY)


def view_ranges(view: Viewport, scale: float, most: int = VIEW_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` key ranges, ends included, that hold all cells of a view; they may hold others too.

    Squares are split in four where they lie across the window's edge, coarse ones first, as long as the ranges
    remain few. Keys that follow one another are one range.
    """
    south, west, north, east = proj.window_bounds(view.latitude, view.longitude, view.zoom, view.width, view.height, MARGIN)
    top = (1 << KEY_BITS) - 1
    clamp = lambda n: max(0, min(top, n))
    # one cell more on each side, as corners and window are computed in floating point
    low = clamp(math.floor((south + 90.0) * scale) - 1), clamp(math.floor((west + 180.0) * scale) - 1)
    high = clamp(math.ceil((north + 90.0) * scale) + 1), clamp(math.ceil((east + 180.0) * scale) + 1)

    def touches(row: int, column: int, size: int) -> bool:
        return row <= high[0] and row + size > low[0] and column <= high[1] and column + size > low[1]

    def inside(row: int, column: int, size: int) -> bool:
        return low[0] <= row and row + size - 1 <= high[0] and low[1] <= column and column + size - 1 <= high[1]

    def joined(squares: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
        ranges: list[tuple[int, int]] = []
        for key, _, _, size in squares:
            if ranges and ranges[-1][1] + 1 == key:
                ranges[-1] = ranges[-1][0], key + size * size - 1
            else:
                ranges.append((key, key + size * size - 1))
        return ranges

    squares = [(0, 0, 0, 1 << KEY_BITS)]  # first key, row, column, size; in order of keys
    while True:
        finer = []
        for key, row, column, size in squares:
            if size == 1 or inside(row, column, size):
                finer.append((key, row, column, size))
                continue
            half = size // 2
            finer += [(key + (2 * i + j) * half * half, row + i * half, column + j * half, half)
                      for i in (0, 1) for j in (0, 1) if touches(row + i * half, column + j * half, half)]
        if finer == squares or len(joined(finer)) > most:
            return joined(squares)
        squares = finer


def in_view(ordered: DataFrame, view: Viewport, scale: float) -> DataFrame:
    """The cells of the ranges of a view, without their key; the filter reaches the files' statistics.

    Every cell that ``visible`` keeps is among them, so that clusters and zones are the same as from all cells.
    """
    wanted = F.lit(False)
    for first, last in view_ranges(view, scale):
        wanted = wanted | F.col(PLACE_KEY).between(first, last)
    return ordered.where(wanted).drop(PLACE_KEY)


# --- views -------------------------------------------------------------------------


def _binned(cells: DataFrame, size: float) -> DataFrame:
    """Weighted centre and counts per square of ``size`` pixels."""
    weight = F.col("total_crimes")
    mean = lambda c: (F.sum(F.col(c) * weight) / F.sum(weight))
    return cells.groupBy(
        F.floor(F.col("x") / F.lit(size)).alias("cell_x"),
        F.floor(F.col("y") / F.lit(size)).alias("cell_y"),
    ).agg(mean("x").alias("x"), mean("y").alias("y"),
          mean("lat_bin").alias("latitude"), mean("long_bin").alias("longitude"),
          F.sum(weight).alias("total_crimes"), F.sum("total_arrests").alias("total_arrests"),
          F.count(F.lit(1)).alias("cells"))


def pixel_clusters(grid: DataFrame, view: Viewport, cell: float = CLUSTER_CELL) -> DataFrame:
    """Clusters of visible cells; the radius grows with the root of the count, up to 22."""
    clusters = _binned(visible(grid, view), cell)
    radius = F.least(F.lit(22.0), F.lit(5.0) + F.sqrt("total_crimes") * F.lit(0.34))
    return clusters.withColumn("radius", radius)


def heat_cell(zoom: int) -> float:
    """Pixels per heat zone: coarser when zoomed out."""
    if zoom <= 9:
        return 16.0
    return 13.0 if zoom <= 11 else 10.0


def heat_zones(grid: DataFrame, view: Viewport) -> DataFrame:
    """Zones with intensity relative to a high order statistic of the scores.

    The scale is the score at 0-based place floor(0.96 n) in ascending order. The window has no
    partition, but its rows are squares of the view: their number is bounded by its pixels.
    """
    size = heat_cell(view.zoom)
    zones = _binned(visible(grid, view), size).withColumn("score", F.log1p("total_crimes"))
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy("score"))
    wanted = F.floor(F.count(F.lit(1)).over(everything) * F.lit(HEAT_QUANTILE)) + 1
    scale = F.max(F.when(F.col("place") == F.col("wanted"), F.col("score"))).over(everything)
    ranked = zones.withColumns({"place": place, "wanted": wanted}).withColumn(
        "scale", F.coalesce(F.nullif(scale, F.lit(0.0)), F.lit(1.0)))
    intensity = F.least(F.lit(1.0), F.col("score") / F.col("scale"))
    tier = (F.when(F.col("intensity") > 0.72, F.lit("high"))
            .when(F.col("intensity") > 0.42, F.lit("medium")).otherwise(F.lit("low")))
    radius = F.lit(size) * (F.lit(1.15) + F.col("intensity") * F.lit(1.05))
    return (ranked.withColumn("intensity", intensity)
            .withColumns({"tier": tier, "radius": radius})
            .drop("place", "wanted", "scale", "cells"))
