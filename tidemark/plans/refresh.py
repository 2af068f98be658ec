"""One refresh run: changed records in, a consistent new snapshot of all layers out."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import casts
from ..functions.measures import count_where
from ..operators import quality, rollups, versions
from ..operators.standardize import to_silver
from ..session import observed, together
from ..sources import intake, runlog, snapshots
from ..sources.snapshots import Manifest, TableRef
from ..spec import BRONZE_SCHEMA, ModelSpec

BRONZE, SILVER = "bronze_crimes", "silver_crimes"
STATE = "silver_check_state"  # what the checks need to know, one row per bucket


class RefreshFailed(RuntimeError):
    """The run published nothing; it is in the run history as FAILED."""


class RunLogError(RuntimeError):
    """The snapshot is published, but the run could not be recorded."""


@dataclass(frozen=True)
class RefreshConfig:
    root: str
    landing: str
    landing_format: str = "json"
    source: str = "landing"
    pipeline_name: str = "incremental_refresh"
    target_database: str = "default"
    model: ModelSpec = field(default_factory=ModelSpec)
    start_year: int | None = None  # extraction only; default: the model's first year
    # Partition column of the landing area, the date a file arrived. Folders that the last successful run of this
    # pipeline name, less the overlap, has seen are not read again; one landing area per pipeline name.
    arrival: str | None = None


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def bootstrap(spark: SparkSession, root: str, history: DataFrame, buckets: int,
              tie_breakers: tuple[str, ...] = (), by_content: tuple[str, ...] = (),
              unpack: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Manifest:
    """Publish the historical Bronze table, newest version of each key.

    With one row per key the buckets are even, whatever the history's keys looked like. ``by_content`` and ``unpack``
    are those of ``versions.latest_stage``.
    """
    dated = history.withColumn("_updated", casts.to_timestamp(F.col("updated_on")))
    ties = by_content or versions.all_ties(history, "id", tie_breakers)
    bronze = unpack(versions.keep_latest(dated, "id", [F.col("_updated")], ties)).select(*BRONZE_SCHEMA.names)
    run_id = f"bootstrap-{uuid.uuid4()}"
    ref = snapshots.write_keyed([snapshots.by_bucket(bronze, "id", buckets)],
                                root, run_id, BRONZE, "id", buckets)
    return snapshots.promote(spark, root, run_id, snapshots.current(spark, root), {BRONZE: ref})


def by_content(m: ModelSpec) -> tuple[str, ...]:
    return versions.content_order(BRONZE_SCHEMA.names, m.tie_breakers) if m.order_free else ()


def merge_batch(spark: SparkSession, stage: DataFrame, root: str, run_id: str, ref: TableRef,
                record: runlog.RunRecord | None = None, content: tuple[str, ...] = ()) -> tuple[TableRef, list[int]]:
    """Merge a staged batch into Bronze: the new Bronze and the buckets it rewrote.

    Only buckets that hold a key of the batch are read and written. The rows they have already keep their
    bucket and are not shuffled when the batch is small; only the new rows are sent to their buckets. What the
    merge changes is counted by the tasks that write it.
    """
    touched = snapshots.touched_buckets(stage, "id", ref)
    target = snapshots.read_table(spark, ref, touched)
    _, added = versions.merge_parts(target, stage)
    known, changes = observed(versions.merge_known(target, stage, content), overlap_rows=count_where(F.col("_found")),
                              rows_updated=count_where(F.col("_replace")))
    new, news = observed(snapshots.by_bucket(added, "id", ref.buckets), rows_inserted=F.count(F.lit(1)))
    merged = snapshots.write_keyed([known.drop(*versions.MERGE_MARKS), new], root, run_id, BRONZE, "id",
                                   ref.buckets, ref, touched)
    if record is not None:
        record.count(changes.get, news.get)
    return merged, touched


def write_batch(spark: SparkSession, records: DataFrame, root: str, run_id: str, record: runlog.RunRecord) -> DataFrame:
    """Landed records, typed and written once, so that the landing area is parsed once."""
    typed, seen = observed(intake.type_bronze(records), api_records_fetched=F.count(F.lit(1)))
    batch = snapshots.read_table(spark, snapshots.write_table(typed, root, run_id, "bronze_batch"))
    record.count(seen.get)
    return batch


def stage_batch(spark: SparkSession, typed: DataFrame, root: str, run_id: str, m: ModelSpec,
                record: runlog.RunRecord | None = None, ref: TableRef | None = None) -> tuple[DataFrame, datetime | None]:
    """Reduce a typed batch to one row per key and write it, as it is read several times; also its newest
    update time. With ``ref``, the table it will be merged into, it is written in that table's buckets: it is shuffled
    once, to be ranked, and not again by the merge."""
    latest, seen = observed(versions.latest_stage(typed, m.tie_breakers, by_content(m)), stage_rows=F.count(F.lit(1)),
                            newest=F.max(casts.to_timestamp(F.col("updated_on"))))
    if ref is None:
        stage = snapshots.read_table(spark, snapshots.write_table(latest, root, run_id, "bronze_stage"))
    else:
        kept = snapshots.write_keyed([latest], root, run_id, "bronze_stage", "id", ref.buckets)
        stage = snapshots.read_table(spark, kept, [i for i, path in enumerate(kept.runs) if path])
    if record is not None:
        record.stage_rows = seen.get["stage_rows"]
    return stage, seen.get["newest"]


def _checked(results: DataFrame, root: str, run_id: str, name: str) -> tuple[TableRef, int]:
    """Check results, kept with the run before a gate may raise on them, and how many passed."""
    ordered = results.coalesce(1).sortWithinPartitions(results.columns[0])
    watched, seen = observed(ordered, passed=count_where(F.col("validation_status") == "PASS"))
    ref = snapshots.write_table(watched, root, run_id, name)
    return ref, seen.get["passed"]


def _stamp(m: ModelSpec) -> str:
    return hashlib.md5(repr(m).encode()).hexdigest()


def stale_buckets(spark: SparkSession, bronze_ref: TableRef, state: TableRef) -> list[int]:
    """Buckets whose Bronze is not the one that their Silver was derived from, whoever wrote them since."""
    made_from = dict(snapshots.read_table(spark, state).select("bucket", "source").collect())  # one row per bucket
    return [i for i, path in enumerate(bronze_ref.runs) if made_from.get(i) != path]


def write_state(spark: SparkSession, bronze_ref: TableRef, silver_ref: TableRef, root: str, run_id: str, m: ModelSpec,
                stored: TableRef | None, some: list[int] | None) -> tuple[TableRef, int]:
    """The state of the checks by bucket, and the rows of Silver; of all buckets, or of ``some`` with the stored
    rows of the others. ``source`` is the folder of Bronze that a bucket was derived from."""
    again = range(bronze_ref.buckets) if some is None else some
    origin = spark.createDataFrame([(i, bronze_ref.runs[i]) for i in again], "bucket int, source string")
    bronze, silver = (snapshots.read_table(spark, ref, some) for ref in (bronze_ref, silver_ref))
    rows = origin.join(quality.bucket_state(bronze, silver, m, bronze_ref.buckets), "bucket", "left")
    if some is not None:
        rows = rows.unionByName(snapshots.read_table(spark, stored).join(origin, "bucket", "left_anti"))
    watched, seen = observed(rows, silver_rows_after=F.coalesce(F.sum("silver_rows"), F.lit(0)))
    return snapshots.write_table(watched, root, run_id, STATE), seen.get["silver_rows_after"]


def build_layers(spark: SparkSession, bronze_ref: TableRef, root: str, run_id: str, m: ModelSpec,
                 parent: Manifest, record: runlog.RunRecord) -> dict[str, TableRef]:
    """Silver, its gate, Gold, its gate; returns what to publish or raises.

    Where the published layers were made with the same model from the same buckets, Silver is derived and checked
    for the buckets only whose Bronze has changed since, and Gold takes off what these buckets gave before and adds
    what they give now. The checks still speak for all of Silver: the state of the other buckets is kept.
    """
    buckets, before = bronze_ref.buckets, parent.tables.get(SILVER)
    partly = before is not None and (before.stamp, before.buckets) == (_stamp(m), buckets) and all(
        name in parent.tables for name in (STATE, *rollups.GOLD))
    touched = stale_buckets(spark, bronze_ref, parent.tables[STATE]) if partly else None
    derived = to_silver(snapshots.read_table(spark, bronze_ref, touched), m)
    refs = {SILVER: snapshots.write_keyed([derived], root, run_id, SILVER, "crime_id", buckets, before, touched, _stamp(m))}
    silver = snapshots.read_table(spark, refs[SILVER])
    refs[STATE], record.silver_rows_after = write_state(spark, bronze_ref, refs[SILVER], root, run_id, m,
                                                        parent.tables.get(STATE), touched)
    state = quality.merged_state(snapshots.read_table(spark, refs[STATE]), m)
    name = "silver_quality_results"
    refs[name], _ = _checked(quality.silver_results(state, m), root, run_id, name)
    quality.gate(snapshots.read_table(spark, refs[name]), quality.SILVER_FAILED)

    if partly:
        gone, come = snapshots.read_table(spark, before, touched), snapshots.read_table(spark, refs[SILVER], touched)
        signed = gone.withColumn("_sign", F.lit(-1)).unionByName(come.withColumn("_sign", F.lit(1)))
        parents = rollups.parent_rollups(signed, m, F.col("_sign"))
    else:
        parents = rollups.parent_rollups(silver, m)
    parents = snapshots.read_table(spark, snapshots.write_table(parents, root, run_id, "gold_parents"))
    frames = {n: rollups.maintained(n, snapshots.read_table(spark, parent.tables[n]), parents) if partly
              else rollups.from_parent(n, parents) for n in rollups.GOLD}
    refs.update(zip(frames, together([
        lambda n=n, f=f: snapshots.write_table(f, root, run_id, n) for n, f in frames.items()])))
    gold = {name: snapshots.read_table(spark, refs[name]) for name in frames}
    name = "gold_quality_results"
    refs[name], record.gold_tables_passed = _checked(quality.gold_checks(silver, gold, m, state), root, run_id, name)
    quality.gate(snapshots.read_table(spark, refs[name]), quality.GOLD_FAILED, len(rollups.GOLD))
    return refs


def _unread_since(spark: SparkSession, cfg: RefreshConfig) -> date | None:
    """The first arrival date that may hold files no successful run has read."""
    last = runlog.last_success(spark, cfg.root, cfg.pipeline_name) if cfg.arrival else None
    return None if last is None else (last - timedelta(hours=cfg.model.overlap_hours)).date()


def _refresh(spark: SparkSession, cfg: RefreshConfig, record: runlog.RunRecord) -> None:
    m, root, run_id = cfg.model, cfg.root, record.run_id
    start_year = m.first_year if cfg.start_year is None else cfg.start_year
    parent = snapshots.current(spark, root)
    ref = snapshots.resolve(parent, BRONZE)
    bronze = snapshots.read_table(spark, ref)

    mark = intake.with_overlap(intake.bronze_state(bronze, start_year), m.overlap_hours).first()
    record.watermark_before = mark["watermark"]
    landed = intake.read_landing(spark, cfg.landing, cfg.landing_format, cfg.arrival, _unread_since(spark, cfg))
    changed = intake.incremental_slice(landed, record.watermark_before, start_year)
    stamped = intake.stamp_lineage(changed, record.batch_id, cfg.source, record.started_at)
    batch = write_batch(spark, stamped, root, run_id, record)

    refs: dict[str, TableRef] = {}
    times = [mark["newest"]]
    if record.api_records_fetched:
        stage, newest = stage_batch(spark, batch, root, run_id, m, record, ref)
        ref, _ = merge_batch(spark, stage, root, run_id, ref, record, by_content(m))
        refs[BRONZE] = ref
        times.append(newest)

    refs.update(build_layers(spark, ref, root, run_id, m, parent, record))
    # A merge adds rows and never lowers the newest time: a staged row that is not taken is older than a stored one.
    record.bronze_rows_after = mark["bronze_rows"] + record.rows_inserted
    record.watermark_after = max((t for t in times if t is not None), default=None)
    snapshots.promote(spark, root, run_id, parent, refs)


def run(spark: SparkSession, cfg: RefreshConfig) -> DataFrame:
    """Refresh all layers; one summary row.

    If any step or gate fails nothing is published: the run is recorded as FAILED with the
    counters reached and its check results stay in its folder.
    """
    started = _now()
    record = runlog.RunRecord(
        run_id=str(uuid.uuid4()), pipeline_name=cfg.pipeline_name,
        target_database=cfg.target_database, started_at=started,
        batch_id=started.strftime("api_%Y%m%dT%H%M%SZ"))
    try:
        _refresh(spark, cfg, record)
    except Exception as problem:
        record.watermark_after = None
        record.finish("FAILED", _now(), str(problem))
        try:
            runlog.log_run(spark, record, cfg.root)
        except Exception as unlogged:  # the run's own failure is the one to report
            problem.add_note(f"could not record failure: {unlogged}")
        raise RefreshFailed(f"run {record.run_id} failed: {problem}") from problem
    record.finish("SUCCESS", _now())
    try:
        runlog.log_run(spark, record, cfg.root)
    except Exception as problem:
        raise RunLogError(f"run {record.run_id} is published but not recorded") from problem
    return runlog.summary(record, spark)
