"""Web-Mercator pixel coordinates: the world is ``256 * 2^zoom`` pixels wide."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

TILE = 256.0


def world_size(zoom: int) -> float:
    return TILE * 2.0 ** zoom


def mercator_x(longitude: Column, zoom: int) -> Column:
    return (longitude + F.lit(180.0)) / F.lit(360.0) * F.lit(world_size(zoom))


def mercator_y(latitude: Column, zoom: int) -> Column:
    phi = latitude * F.lit(math.pi / 180.0)
    stretched = F.ln(F.tan(phi) + F.lit(1.0) / F.cos(phi)) / F.lit(math.pi)
    return (F.lit(1.0) - stretched) / F.lit(2.0) * F.lit(world_size(zoom))


def longitude_at(x: Column, zoom: int) -> Column:
    return x / F.lit(world_size(zoom)) * F.lit(360.0) - F.lit(180.0)


def latitude_at(y: Column, zoom: int) -> Column:
    n = F.lit(math.pi) - F.lit(2.0 * math.pi) * y / F.lit(world_size(zoom))
    return F.lit(180.0 / math.pi) * F.atan(F.lit(0.5) * (F.exp(n) - F.exp(-n)))


def window_origin(latitude: float, longitude: float, zoom: int,
                  width: float, height: float) -> tuple[float, float]:
    """World pixel of a window's top left corner, from the window's centre."""
    phi = math.radians(latitude)
    x = (longitude + 180.0) / 360.0 * world_size(zoom)
    y = (1.0 - math.log(math.tan(phi) + 1.0 / math.cos(phi)) / math.pi) / 2.0 * world_size(zoom)
    return x - width / 2.0, y - height / 2.0


def window_bounds(latitude: float, longitude: float, zoom: int, width: float, height: float,
                  margin: float) -> tuple[float, float, float, float]:
    """South, west, north and east of a window with a margin of pixels around it."""
    left, top = window_origin(latitude, longitude, zoom, width, height)
    degrees = lambda x: x / world_size(zoom) * 360.0 - 180.0
    parallel = lambda y: math.degrees(math.atan(math.sinh(math.pi * (1.0 - 2.0 * y / world_size(zoom)))))
    return (parallel(top + height + margin), degrees(left - margin), parallel(top - margin), degrees(left + width + margin))
