"""Landed files merged into Bronze as they arrive, by the rules of a refresh run.

No batch is ever skipped: merging is by key and update time, so a batch that is replayed after a
crash, a new checkpoint over files merged before, or a second source changes nothing that is there
already. Only Bronze moves; Silver and Gold keep their version until the next refresh run.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.refresh import BRONZE, by_content, merge_batch, stage_batch
from ..sources import intake, snapshots
from ..spec import SOURCE_SCHEMA, ModelSpec


def upsert_batch(batch: DataFrame, epoch: int, root: str, stream: str, source: str,
                 m: ModelSpec) -> None:
    """Merge one micro-batch and publish."""
    spark = batch.sparkSession
    parent = snapshots.current(spark, root)
    ref = snapshots.resolve(parent, BRONZE)
    run_id = f"{stream}-{epoch}-{uuid.uuid4().hex}"
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    stamped = intake.stamp_lineage(batch, f"{stream}_{epoch}", source, now)
    stage, _ = stage_batch(spark, intake.type_bronze(stamped), root, run_id, m, ref=ref)
    merged, _ = merge_batch(spark, stage, root, run_id, ref, content=by_content(m))
    snapshots.promote(spark, root, run_id, parent, {BRONZE: merged})


def continuous_upsert(spark: SparkSession, landing: str, root: str, checkpoint: str,
                      m: ModelSpec, stream: str = "upsert", source: str = "landing",
                      files_per_batch: int | None = None) -> StreamingQuery:
    """Start merging every file landed so far, then stop; call again for later files."""
    reader = spark.readStream.schema(SOURCE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (reader.json(landing).writeStream
            .foreachBatch(lambda batch, epoch: upsert_batch(batch, epoch, root, stream, source, m))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
