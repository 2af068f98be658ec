"""Reading changed records from a landing area into the Bronze shape."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import casts
from ..spec import (BRONZE_SCHEMA, COORDINATE_FIELDS, FLAG_FIELDS, INTEGER_FIELDS,
                    SOURCE_FIELDS, SOURCE_SCHEMA)


def read_landing(spark: SparkSession, path: str, fmt: str = "json", arrival: str | None = None,
                 since: date | None = None) -> DataFrame:
    """Landed records with a fixed schema: absent fields are NULL, unknown ones dropped.

    Where the area is partitioned by the date of arrival (folders ``<arrival>=2024-03-05``), only folders
    from ``since`` on are listed and read; without ``since`` all are.
    """
    reader = spark.read.schema(SOURCE_SCHEMA) if fmt == "json" else spark.read
    landed = reader.format(fmt).load(path)
    if arrival is not None and since is not None and arrival in landed.columns:
        landed = landed.where(F.col(arrival) >= F.lit(since))
    return landed.select(*SOURCE_FIELDS) if fmt == "json" else with_source_fields(landed)


def with_source_fields(records: DataFrame) -> DataFrame:
    """Exactly the source fields, in order; a nested field becomes compact JSON text."""
    by_name = {f.name: f.dataType for f in records.schema.fields}

    def pick(name: str) -> Column:
        if name not in by_name:
            return F.lit(None).cast("string").alias(name)
        if isinstance(by_name[name], (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(name, {"ignoreNullFields": "false"}).alias(name)
        return F.col(name)

    return records.select(*[pick(c) for c in SOURCE_FIELDS])


def incremental_slice(records: DataFrame, watermark: datetime | Column,
                      start_year: int) -> DataFrame:
    """Records changed at or after ``watermark`` in the analysed years.

    A ``updated_on`` that is a timestamp already is compared as it is, so that the
    predicate reaches a Parquet scan.
    """
    changed = F.col("updated_on")
    if not isinstance(records.schema["updated_on"].dataType, T.TimestampNTZType):
        changed = casts.to_timestamp(changed)
    year = F.col("year")
    if isinstance(records.schema["year"].dataType, T.StringType):
        year = casts.to_long(year)
    floor = watermark if isinstance(watermark, Column) else \
        F.lit(watermark).cast(T.TimestampNTZType())
    return records.where((changed >= floor) & (year >= start_year))


def stamp_lineage(records: DataFrame, batch_id: str, source: str,
                  ingested_at: datetime) -> DataFrame:
    """Add where and when the records came in; one value each per run."""
    return records.withColumns({
        "ingested_at": F.lit(ingested_at).cast(T.TimestampNTZType()),
        "source_file": F.lit(source),
        "batch_id": F.lit(batch_id),
    })


def type_bronze(records: DataFrame) -> DataFrame:
    """Loosely typed records to Bronze types; what does not fit becomes NULL.

    Event and update times stay text in Bronze. Columns beyond the Bronze schema
    (tie-breakers) are kept as they are.
    """

    def typed(field: T.StructField) -> Column:
        c = F.col(field.name)
        if field.name == "location":
            c = casts.compact_json(c.cast("string"))
        elif records.schema[field.name].dataType == field.dataType:
            pass
        elif field.name in INTEGER_FIELDS:
            c = casts.to_long(c.cast("string"))
        elif field.name in FLAG_FIELDS:
            c = casts.to_flag(c)
        elif field.name in COORDINATE_FIELDS:
            c = casts.to_double(c)
        elif field.name == "ingested_at":
            c = casts.to_timestamp(c)
        else:
            c = c.cast("string")
        return c.alias(field.name)

    known = [f for f in BRONZE_SCHEMA.fields if f.name in records.columns]
    extra = [c for c in records.columns if c not in BRONZE_SCHEMA.names]
    return records.select(*[typed(f) for f in known], *extra)


def bronze_state(bronze: DataFrame, start_year: int, not_after: datetime | None = None) -> DataFrame:
    """One row: ``bronze_rows``, ``newest`` update time and ``high_water_mark``, the newest update time, else
    January 1 of ``start_year``.

    One record dated in the future would hide later changes; ``not_after`` leaves such out of the mark.
    """
    updated = casts.to_timestamp(F.col("updated_on"))
    known = updated
    if not_after is not None:
        known = F.when(updated <= F.lit(not_after).cast(T.TimestampNTZType()), updated)
    floor = F.lit(f"{start_year:04d}-01-01 00:00:00").cast(T.TimestampNTZType())
    return bronze.agg(F.count(F.lit(1)).alias("bronze_rows"), F.max(updated).alias("newest"),
                      F.coalesce(F.max(known), floor).alias("high_water_mark"))


def high_water_mark(bronze: DataFrame, start_year: int,
                    not_after: datetime | None = None) -> DataFrame:
    """One row, ``high_water_mark`` of ``bronze_state``."""
    return bronze_state(bronze, start_year, not_after).select("high_water_mark")


def with_overlap(mark: DataFrame, overlap_hours: int) -> DataFrame:
    """Add ``watermark``, the high-water mark moved back by the overlap."""
    back = F.make_dt_interval(hours=F.lit(overlap_hours))
    return mark.withColumn("watermark", F.col("high_water_mark") - back)
