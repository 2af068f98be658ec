"""Hand-sized frames: every column has a sound default, a test names what it is about."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.spec import BRONZE_SCHEMA, SILVER_COLUMNS, ModelSpec

M = ModelSpec(tie_breakers=("case_number",))

_BRONZE = dict(
    id=1, case_number=" C1 ", date="2024-03-05 14:30:00", block="B", iucr=" a1 ",
    primary_type="THEFT", description="d", location_description="STREET", arrest=True,
    domestic=False, beat=111, district=1, ward=2, community_area=3, fbi_code=" 6x ",
    x_coordinate=1.0, y_coordinate=2.0, year=2024, updated_on="2024-03-06 00:00:00",
    latitude=41.8, longitude=-87.7, location=None, ingested_at=datetime(2024, 3, 7),
    source_file="s", batch_id="b")


def bronze(spark: SparkSession, *rows: dict) -> DataFrame:
    return spark.createDataFrame(
        [tuple({**_BRONZE, **r}[c] for c in BRONZE_SCHEMA.names) for r in rows], BRONZE_SCHEMA)


_SILVER = dict(
    crime_id=1, case_number="C1", date=datetime(2024, 3, 5, 14, 30), block="B", iucr="A1",
    primary_type="THEFT", description="d", location_description="STREET", arrest=True,
    domestic=False, beat="0111", district="001", ward="02", community_area="03", fbi_code="6X",
    x_coordinate=1.0, y_coordinate=2.0, year=2024, updated_on=datetime(2024, 3, 6),
    latitude=41.8, longitude=-87.7, ingested_at=datetime(2024, 3, 7), source_file="s", batch_id="b")


def _silver_type(name: str) -> T.DataType:
    if name in ("date", "updated_on", "ingested_at"):
        return T.TimestampNTZType()
    if name in ("beat", "district", "ward", "community_area"):
        return T.StringType()
    return BRONZE_SCHEMA["id" if name == "crime_id" else name].dataType


SILVER_SCHEMA = T.StructType([T.StructField(c, _silver_type(c)) for c in SILVER_COLUMNS])


def silver(spark: SparkSession, *rows: dict) -> DataFrame:
    return spark.createDataFrame(
        [tuple({**_SILVER, **r}[c] for c in SILVER_COLUMNS) for r in rows], SILVER_SCHEMA)


CUBE = "year bigint, month int, district string, community_area string, primary_type string, " \
       "domestic int, total_crimes bigint, total_arrests bigint"


def cube(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Rows are (year, month, district, type, domestic, crimes, arrests)."""
    return spark.createDataFrame(
        [(y, m, d, "01", t, dom, n, a) for y, m, d, t, dom, n, a in rows], CUBE)


def values(df: DataFrame, *columns: str) -> list[tuple]:
    return [tuple(r) for r in df.select(*columns).collect()]
