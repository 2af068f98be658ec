"""Map operators against a row-by-row computation."""

import math
import random
from collections import defaultdict

import pyarrow.parquet as pq
import pytest

from tidemark.functions.projection import window_bounds, window_origin, world_size
from tidemark.operators import geo
from tidemark.spec import Viewport

VIEW = Viewport(zoom=11, width=600, height=400)


@pytest.fixture(scope="module")
def cells():
    rng = random.Random(3)
    found = {(round(41.6 + rng.random() * 0.5, 3), round(-88.0 + rng.random() * 0.6, 3)): rng.randint(1, 500)
             for _ in range(800)}
    return [(lat, lon, n, n // 3, 0.0) for (lat, lon), n in found.items()]


@pytest.fixture(scope="module")
def grid(spark, cells):
    return spark.createDataFrame(
        cells, "lat_bin double, long_bin double, total_crimes bigint, total_arrests bigint, arrest_rate double").cache()


def pixel(lat, lon, view):
    left, top = window_origin(view.latitude, view.longitude, view.zoom, view.width, view.height)
    rad = math.radians(lat)
    x = (lon + 180) / 360 * world_size(view.zoom) - left
    y = (1 - math.log(math.tan(rad) + 1 / math.cos(rad)) / math.pi) / 2 * world_size(view.zoom) - top
    return x, y


def buckets(cells, view, size):
    out = defaultdict(list)
    for lat, lon, n, a, _ in cells:
        x, y = pixel(lat, lon, view)
        if -30 <= x <= view.width + 30 and -30 <= y <= view.height + 30:
            out[math.floor(x / size), math.floor(y / size)].append((x, y, lat, lon, n, a))
    return out


def centre(rows, i):
    return pytest.approx(sum(r[i] * r[4] for r in rows) / sum(r[4] for r in rows), abs=1e-6)


def test_the_view_centre_is_in_the_middle():
    assert pixel(VIEW.latitude, VIEW.longitude, VIEW) == (pytest.approx(300), pytest.approx(200))


def test_clusters(grid, cells):
    expected = buckets(cells, VIEW, 34)
    got = geo.pixel_clusters(grid, VIEW).collect()
    assert {(r.cell_x, r.cell_y) for r in got} == set(expected) and len(got) > 50
    for r in got:
        rows = expected[r.cell_x, r.cell_y]
        count = sum(x[4] for x in rows)
        assert (r.total_crimes, r.total_arrests, r.cells) == (count, sum(x[5] for x in rows), len(rows))
        assert (r.x, r.y, r.latitude, r.longitude) == tuple(centre(rows, i) for i in range(4))
        assert r.radius == pytest.approx(min(22, 5 + math.sqrt(count) * 0.34))


@pytest.mark.parametrize("zoom, size", [(9, 16), (10, 13), (11, 13), (12, 10)])
def test_heat_zones(grid, cells, zoom, size):
    view = Viewport(zoom=zoom, width=600, height=400)
    expected = buckets(cells, view, size)
    scores = sorted(math.log1p(sum(r[4] for r in rows)) for rows in expected.values())
    scale = scores[math.floor(len(scores) * 0.96)]
    got = geo.heat_zones(grid, view).collect()
    assert len(got) == len(expected)
    for r in got:
        score = math.log1p(sum(x[4] for x in expected[r.cell_x, r.cell_y]))
        intensity = min(1, score / scale)
        assert r.intensity == pytest.approx(intensity)
        assert r.tier == ("high" if intensity > 0.72 else "medium" if intensity > 0.42 else "low")
        assert r.radius == pytest.approx(size * (1.15 + intensity * 1.05))


def test_nothing_in_view(grid):
    far = Viewport(zoom=13, width=300, height=300, latitude=10.0, longitude=10.0)
    assert geo.pixel_clusters(grid, far).count() == 0 and geo.heat_zones(grid, far).count() == 0


# --- cells in order of space --------------------------------------------------------


def interleaved(row, column):
    return sum(((row >> i & 1) << 2 * i + 1) | ((column >> i & 1) << 2 * i) for i in range(geo.KEY_BITS))


@pytest.mark.parametrize("scale", [1000.0, 1e7])
def test_place_key(spark, scale):
    places = [(41.6, -87.9), (-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (-33.868, 151.209), (95.0, -200.0), (None, 1.0), (1.0, None)]
    df = spark.createDataFrame(places, "lat double, lon double")
    found = [r[0] for r in df.select(geo.place_key(df.lat, df.lon, scale)).collect()]
    top = (1 << geo.KEY_BITS) - 1
    number = lambda c, lowest: max(0, min(top, int(math.floor((c - lowest) * scale + 0.5))))
    assert found == [None if None in p else interleaved(number(p[0], -90), number(p[1], -180)) for p in places]


@pytest.mark.parametrize("most", [1, 4, 32, 500])
def test_ranges_hold_every_visible_cell(spark, grid, most):
    for view in (VIEW, Viewport(zoom=14, width=300, height=900), Viewport(zoom=9, width=50, height=50, latitude=41.7),
                 Viewport(zoom=1, width=900, height=900), Viewport(zoom=12, width=400, height=400, longitude=-180.0)):
        ranges = geo.view_ranges(view, 1000.0, most)
        assert 1 <= len(ranges) <= most and all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:]))
        keyed = geo.visible(grid, view).select(geo.place_key(grid.lat_bin, grid.long_bin, 1000.0).alias("k"))
        assert all(any(a <= r.k <= b for a, b in ranges) for r in keyed.collect())


def test_more_ranges_read_less(spark):
    size = lambda n: sum(b - a + 1 for a, b in geo.view_ranges(VIEW, 1000.0, n))
    sizes = [size(n) for n in (1, 4, 16, 64, 500)]
    assert sizes == sorted(sizes, reverse=True)
    south, west, north, east = window_bounds(VIEW.latitude, VIEW.longitude, VIEW.zoom, VIEW.width, VIEW.height, geo.MARGIN)
    assert sizes[-1] < 1.25 * (north - south) * (east - west) * 1e6


def test_a_view_reads_its_part_only(spark, tmp_path):
    """The ranges are pushed to the scan, and the statistics of most files exclude them; the views are the same."""
    rng = random.Random(9)
    cells = {(rng.randrange(-90000, 90000) / 1000, rng.randrange(-180000, 180000) / 1000) for _ in range(20000)} | {
        (41.6 + i / 1000, -87.9 + j / 1000) for i in range(0, 400, 8) for j in range(0, 400, 8)}
    grid = spark.createDataFrame([(a, b, rng.randint(1, 50), 1, 0.0) for a, b in cells] + [(None, 1.0, 5, 1, 0.0)],
                                 "lat_bin double, long_bin double, total_crimes bigint, total_arrests bigint, arrest_rate double")
    path = str(tmp_path / "cells")
    geo.space_ordered(grid, 1000.0, 40).write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == len(cells) + 1
    some = geo.in_view(stored, VIEW, 1000.0)
    assert some.columns == grid.columns
    plan = some._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(place_key" in plan and "LessThanOrEqual(place_key" in plan
    wanted = geo.view_ranges(VIEW, 1000.0)
    spans = []
    for file in (tmp_path / "cells").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for group in range(meta.num_row_groups):
            stats = [meta.row_group(group).column(i).statistics for i in range(meta.num_columns)][meta.schema.names.index("place_key")]
            spans.append((stats.min, stats.max) if stats.has_min_max else None)
    read = [s for s in spans if s and any(a <= s[1] and s[0] <= b for a, b in wanted)]
    assert len(spans) >= 40 and 1 <= len(read) <= 8
    key = lambda df: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())
    assert key(geo.pixel_clusters(some, VIEW)) == key(geo.pixel_clusters(grid, VIEW))
    assert key(geo.heat_zones(some, VIEW).drop("tier")) == key(geo.heat_zones(grid, VIEW).drop("tier"))
    nothing = geo.space_ordered(grid.limit(0), 1000.0)
    assert geo.in_view(nothing, VIEW, 1000.0).count() == 0
