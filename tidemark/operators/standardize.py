"""Bronze to Silver: one typed, standardized row per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import casts
from ..spec import (COORDINATE_FIELDS, CUBE_UNASSIGNED_DISTRICT, UNASSIGNED, UNKNOWN, ModelSpec)
from .versions import keep_latest


def code(c: Column, width: int) -> Column:
    """Zero-padded text code; longer text is cut to the width."""
    text = c.cast("string")
    return F.lpad(F.when(F.typeof(c) == "bigint", text).otherwise(casts.trim_spaces(text)), width, "0")


def upper_code(c: Column) -> Column:
    return F.upper(casts.trim_spaces(c.cast("string")))


def truncated_codes(m: ModelSpec) -> Column:
    """True for a Bronze row with a code that is cut to its width; the format check of the result
    cannot see these."""
    cut = F.lit(False)
    for name, width in m.code_widths.items():
        longer = F.length(casts.trim_spaces(F.col(name).cast("string"))) > width
        cut = cut | F.coalesce(longer, F.lit(False))
    return cut


def coordinate(name: str, m: ModelSpec) -> Column:
    """A coordinate, absent for the records listed as wrong and for NaN."""
    value = casts.finite(casts.to_double(F.col(name)))
    if not m.void_coordinate_ids:
        return value
    return F.when(F.col("id").isin(list(m.void_coordinate_ids)), F.lit(None)).otherwise(value)


def to_silver(bronze: DataFrame, m: ModelSpec, unpack: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Newest version of each key within the analysed years, standardized.

    The projection comes last so that only the columns a query needs are ranked and shuffled. ``unpack`` adds Bronze
    columns that follow from those of ``bronze``, after the ranking, so that they are not shuffled at all.
    """
    dated = bronze.where(F.col("year").between(m.first_year, m.last_year))
    dated = dated.withColumn("_updated", casts.to_timestamp(F.col("updated_on")))  # read once, ranked and kept
    latest = unpack(keep_latest(dated, "id", [F.col("_updated"), F.col("ingested_at")], m.tie_breakers))
    text = lambda c: F.col(c).cast("string").alias(c)
    return latest.select(
        F.col("id").alias("crime_id"),
        casts.trim_spaces(F.col("case_number")).alias("case_number"),
        casts.to_timestamp(F.col("date")).alias("date"),
        text("block"),
        upper_code(F.col("iucr")).alias("iucr"),
        casts.trim_spaces(F.col("primary_type")).alias("primary_type"),
        text("description"),
        text("location_description"),
        F.col("arrest"),
        F.col("domestic"),
        *[code(F.col(c), m.code_widths[c]).alias(c)
          for c in ("beat", "district", "ward", "community_area")],
        upper_code(F.col("fbi_code")).alias("fbi_code"),
        *[coordinate(c, m).alias(c) for c in COORDINATE_FIELDS[:2]],
        F.col("year"),
        F.col("_updated").alias("updated_on"),
        *[coordinate(c, m).alias(c) for c in COORDINATE_FIELDS[2:]],
        F.col("ingested_at"),
        text("source_file"),
        text("batch_id"),
    )


def area_district(district: Column, m: ModelSpec) -> Column:
    """District of the area roll-up: every code not in use, and NULL, is UNASSIGNED."""
    return F.when(district.isin(list(m.valid_districts)), district).otherwise(F.lit(UNASSIGNED))


def cube_district(district: Column) -> Column:
    """District of the published cubes: one code is renamed, NULL stays NULL."""
    return F.when(district == CUBE_UNASSIGNED_DISTRICT, F.lit(UNASSIGNED)).otherwise(district)


def cube_community(community: Column) -> Column:
    return F.coalesce(community, F.lit(UNKNOWN))
