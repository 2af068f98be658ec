"""Schemas, model parameters and filter specifications."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# Column names and types are fixed values.
# --- schemas -----------------------------------------------------------------------

INTEGER_FIELDS = ("id", "beat", "district", "ward", "community_area", "year")
FLAG_FIELDS = ("arrest", "domestic")
COORDINATE_FIELDS = ("x_coordinate", "y_coordinate", "latitude", "longitude")
LINEAGE_FIELDS = ("ingested_at", "source_file", "batch_id")

SOURCE_FIELDS = (
    "id", "case_number", "date", "block", "iucr", "primary_type", "description",
    "location_description", "arrest", "domestic", "beat", "district", "ward",
    "community_area", "fbi_code", "x_coordinate", "y_coordinate", "year", "updated_on",
    "latitude", "longitude", "location",
)

# A landing record as text: numbers and flags arrive quoted or not, depending on the sender.
# Read as text, the nested ``location`` object arrives as its compact JSON.
SOURCE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in SOURCE_FIELDS])


def _bronze_type(name: str) -> T.DataType:
    if name in INTEGER_FIELDS:
        return T.LongType()
    if name in FLAG_FIELDS:
        return T.BooleanType()
    if name in COORDINATE_FIELDS:
        return T.DoubleType()
    return T.TimestampNTZType() if name == "ingested_at" else T.StringType()


BRONZE_SCHEMA = T.StructType(
    [T.StructField(c, _bronze_type(c)) for c in SOURCE_FIELDS + LINEAGE_FIELDS])

SILVER_COLUMNS = ("crime_id",) + tuple(
    c for c in SOURCE_FIELDS if c not in ("id", "location")) + LINEAGE_FIELDS

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("target_database", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("ended_at", T.TimestampNTZType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("watermark_before", T.TimestampNTZType()),
    T.StructField("watermark_after", T.TimestampNTZType()),
    T.StructField("api_records_fetched", T.LongType()),
    T.StructField("stage_rows", T.LongType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("rows_updated", T.LongType()),
    T.StructField("overlap_rows", T.LongType()),
    T.StructField("bronze_rows_after", T.LongType()),
    T.StructField("silver_rows_after", T.LongType()),
    T.StructField("gold_tables_passed", T.IntegerType()),
    T.StructField("error_message", T.StringType()),
])

# --- fixed values ------------------------------------------------------------------

# District codes in use; every other code is reported as UNASSIGNED in the area roll-up.
VALID_DISTRICTS = (
    "001", "002", "003", "004", "005", "006", "007", "008", "009", "010", "011", "012",
    "014", "015", "016", "017", "018", "019", "020", "022", "024", "025",
)
# Records known to carry wrong coordinates.
VOID_COORDINATE_IDS = (12848210, 12852880)
# Digits of each standardized geographic code.
CODE_WIDTHS = {"beat": 4, "district": 3, "ward": 2, "community_area": 2}
UNASSIGNED = "UNASSIGNED"
UNKNOWN = "UNKNOWN"
# The one code the published cubes report as UNASSIGNED.
CUBE_UNASSIGNED_DISTRICT = "031"


@dataclass(frozen=True)
class ModelSpec:
    """Parameters of the layered model; the defaults are the production values."""

    first_year: int = 2020
    last_year: int = 2026
    overlap_hours: int = 24
    void_coordinate_ids: tuple[int, ...] = VOID_COORDINATE_IDS
    valid_districts: tuple[str, ...] = VALID_DISTRICTS
    code_widths: dict[str, int] = field(default_factory=lambda: dict(CODE_WIDTHS))
    bin_scale: float = 1000.0
    rate_tolerance: float = 0.01
    # Extra Bronze columns that break ties between versions with equal timestamps,
    # compared in descending order. Empty: every remaining column takes part.
    tie_breakers: tuple[str, ...] = ()
    # Equal or unknown update times are decided by the rows' content, not by which came last: any split of the same
    # records into batches, in any order, then gives one Bronze table.
    order_free: bool = False


# --- filters -----------------------------------------------------------------------


def ordinal(period: str) -> int:
    """``'YYYY-MM'`` as months since year 0, the form periods are compared in."""
    year, month = period.split("-")
    return int(year) * 12 + int(month) - 1


def period_text(months: int) -> str:
    return f"{months // 12:04d}-{months % 12 + 1:02d}"


@dataclass(frozen=True)
class FilterSpec:
    """One selection over the cubes. ``None`` means "all"."""

    year: int | None = None
    primary_type: str | None = None
    district: str | None = None
    community_area: str | None = None
    domestic: bool | None = None
    arrest: bool | None = None
    start: str | None = None
    end: str | None = None

    DIMENSIONS = ("year", "primary_type", "district", "community_area", "domestic", "arrest")

    def resolved(self, low: str, high: str) -> "FilterSpec":
        """Fill in and clamp the period to the data's range ``low``..``high``.

        A range that is inverted after clamping falls back to the whole range.
        """
        start, end = self.start or low, self.end or high
        start, end = max(start, low), min(end, high)
        if start > end:
            start, end = low, high
        return replace(self, start=start, end=end)

    def with_year(self, year: int | None, high: str) -> "FilterSpec":
        """Choosing a year also moves the period to that year, cut at the last period."""
        if year is None:
            return replace(self, year=None)
        return replace(self, year=year, start=f"{year:04d}-01", end=min(f"{year:04d}-12", high))

    def with_start(self, start: str) -> "FilterSpec":
        """Choosing a start clears the year and drags an earlier end along."""
        return replace(self, year=None, start=start, end=max(start, self.end or start))

    def with_end(self, end: str) -> "FilterSpec":
        """Choosing an end clears the year and drags a later start along."""
        return replace(self, year=None, end=end, start=min(end, self.start or end))

    def active(self, low: str, high: str) -> list[str]:
        """Names of the filters that narrow the data, the period first."""
        names = [n for n in self.DIMENSIONS if getattr(self, n) is not None]
        moved = (self.start or low) != low or (self.end or high) != high
        return (["period"] if moved else []) + names


@dataclass(frozen=True)
class Viewport:
    """A map window: zoom level, size in pixels and its centre (fixed default)."""

    zoom: int
    width: float
    height: float
    latitude: float = 41.84
    longitude: float = -87.68
