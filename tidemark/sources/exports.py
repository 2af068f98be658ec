"""Published aggregates: JSON and CSV datasets and the inventory of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Columns that identify a single record; nothing that carries one is published.
RECORD_LEVEL = {"crime_id", "id", "case_number", "block", "x_coordinate", "y_coordinate",
                "latitude", "longitude"}

# Names of the types in the inventory.
TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}

# The column whose first and last value are a table's range, or none, and the
# description of its grain.
RANGES = {
    "gold_monthly_crime_trends": "year", "gold_area_crime_summary": "year",
    "gold_arrest_analysis": "year", "gold_time_patterns": None, "gold_crime_hotspots": None,
    "silver_crimes": "date",
}
GRAINS = {
    "gold_monthly_crime_trends": "year + month + primary_type",
    "gold_area_crime_summary": "year + district",
    "gold_arrest_analysis": "year + primary_type + domestic",
    "gold_time_patterns": "day_of_week_number + hour_of_day",
    "gold_crime_hotspots": "lat_bin + long_bin",
    "silver_crimes": "crime_id (incident-level)",
}


class RecordLevelExport(ValueError):
    """A dataset to publish would reveal single records."""


def require_aggregate(df: DataFrame) -> None:
    leaked = sorted(RECORD_LEVEL & set(df.columns))
    if leaked:
        raise RecordLevelExport(f"record-level columns: {', '.join(leaked)}")


def export_json(df: DataFrame, path: str) -> None:
    """One object per line; absent values are written as null, times as plain text."""
    require_aggregate(df)
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    df.withColumns({c: F.col(c).cast("string") for c in times}).write.json(
        path, ignoreNullFields=False)


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def export_csv(df: DataFrame, path: str) -> None:
    """A report as CSV: header, every field quoted, quotes doubled; one file per partition, so
    coalesce a small report before."""
    require_aggregate(df)
    text = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    (text.write.option("header", True).option("quoteAll", True)
     .option("escape", '"').option("emptyValue", "").csv(path))


def _entry(name: str, df: DataFrame, fmt: str) -> DataFrame:
    ranged = RANGES.get(name)
    bound = lambda f: (f(ranged).cast("string") if ranged else F.lit(None).cast("string"))
    columns = F.array(*[
        F.struct(F.lit(f.name).alias("name"),
                 F.lit(TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())).alias("type"),
                 F.lit(f.nullable).alias("nullable"))
        for f in df.schema.fields])
    return df.agg(F.count(F.lit(1)).alias("row_count"), bound(F.min).alias("range_start"),
                  bound(F.max).alias("range_end")).select(
        F.lit(name).alias("table_name"), F.lit(fmt).alias("format"), "row_count",
        columns.alias("columns"), "range_start", "range_end", F.lit(GRAINS.get(name)).alias("grain"))


def inventory(tables: dict[str, DataFrame], source: str, fmt: str = "Parquet") -> DataFrame:
    """One row per table: size, columns, range and grain."""
    out = None
    for name, df in tables.items():
        entry = _entry(name, df, fmt)
        out = entry if out is None else out.unionByName(entry)
    return out.withColumns({"generated_at": F.current_timestamp().cast(T.TimestampNTZType()),
                            "source": F.lit(source)})
