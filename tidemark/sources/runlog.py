"""The run history: one row per run, successful or not."""

from __future__ import annotations

from dataclasses import dataclass, fields
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..spec import RUN_LOG_SCHEMA

MAX_ERROR_TEXT = 2000
# The columns of the run views.
RECENT_COLUMNS = (
    "run_id", "started_at", "ended_at", "duration_seconds", "status", "batch_id",
    "api_records_fetched", "rows_inserted", "rows_updated", "bronze_rows_after",
    "silver_rows_after", "gold_tables_passed", "error_message")
SUMMARY_COLUMNS = (
    "run_id", "status", "batch_id", "api_records_fetched", "rows_inserted", "rows_updated",
    "bronze_rows_after", "silver_rows_after", "gold_tables_passed")


@dataclass
class RunRecord:
    """Filled in while a run goes on, so that a failure records the counters reached."""

    run_id: str
    pipeline_name: str
    target_database: str
    started_at: datetime
    ended_at: datetime | None = None
    duration_seconds: float | None = None
    status: str | None = None
    batch_id: str | None = None
    watermark_before: datetime | None = None
    watermark_after: datetime | None = None
    api_records_fetched: int = 0
    stage_rows: int = 0
    rows_inserted: int = 0
    rows_updated: int = 0
    overlap_rows: int = 0
    bronze_rows_after: int = 0
    silver_rows_after: int = 0
    gold_tables_passed: int = 0
    error_message: str | None = None

    def count(self, *figures: dict[str, int]) -> None:
        """Take over counters by name."""
        for found in figures:
            for name, n in found.items():
                setattr(self, name, n)

    def finish(self, status: str, at: datetime, error: str | None = None) -> None:
        self.status, self.ended_at = status, at
        self.duration_seconds = (at - self.started_at).total_seconds()
        self.error_message = None if error is None else error[:MAX_ERROR_TEXT]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [tuple(getattr(self, f.name) for f in fields(self))], RUN_LOG_SCHEMA)


def log_path(root: str) -> str:
    return f"{root.rstrip('/')}/pipeline_run_history"


def append_runs(runs: DataFrame, root: str) -> None:
    runs.select(*RUN_LOG_SCHEMA.names).write.mode("append").parquet(log_path(root))


def log_run(spark: SparkSession, record: RunRecord, root: str) -> None:
    append_runs(record.frame(spark).coalesce(1), root)  # one row, one file


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(log_path(root))


def last_success(spark: SparkSession, root: str, pipeline_name: str) -> datetime | None:
    """When the pipeline's last successful run began; nothing where none is recorded."""
    try:
        log = read_log(spark, root)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    done = log.where((F.col("status") == "SUCCESS") & (F.col("pipeline_name") == pipeline_name))
    return done.agg(F.max("started_at")).first()[0]


def recent_runs(log: DataFrame, n: int = 10, with_end: bool = True) -> DataFrame:
    """The newest runs."""
    columns = [c for c in RECENT_COLUMNS if with_end or c != "ended_at"]
    return (log.orderBy(F.col("started_at").desc_nulls_last(), F.col("run_id").asc())
            .limit(n).select(*columns))


def summary(record: RunRecord, spark: SparkSession) -> DataFrame:
    """One row: what a run reports."""
    return record.frame(spark).select(*SUMMARY_COLUMNS)
