"""Snapshots, refresh runs, exports and the continuous upsert."""

import json
import os
import random
import re
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from rows import M, SILVER_SCHEMA, bronze, silver, values
from tidemark.operators import quality, rollups
from tidemark.plans import bundle, refresh
from tidemark.plans.refresh import BRONZE, SILVER, RefreshConfig, RefreshFailed
from tidemark.sources import exports, intake, runlog, snapshots
from tidemark.spec import BRONZE_SCHEMA, SOURCE_FIELDS
from tidemark.streaming.upsert import continuous_upsert, upsert_batch


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "warehouse")


def land(folder, *records, name="a"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(r) for r in records))


def record(i, updated="2024-03-06T00:00:00.000", **fields):
    """A record as the source sends it: numbers and flags in mixed forms, fields missing."""
    return {"id": str(i), "case_number": f"C{i}", "date": "2024-03-05T14:30:00.000", "primary_type": "THEFT",
            "arrest": True, "domestic": "false", "beat": "0111", "district": "001", "year": "2024",
            "updated_on": updated, **fields}


def history(spark, *ids, **fields):
    return bronze(spark, *[dict(id=i, updated_on="2024-03-01 00:00:00", **fields) for i in ids])


# --- intake ------------------------------------------------------------------------


def test_landing_records(spark, tmp_path):
    land(tmp_path / "in", record(1, location={"latitude": "41.8", "human_address": None}, extra="dropped"),
         record(2, location=None, arrest="maybe", latitude=41.5), record("x9"))
    rows = intake.read_landing(spark, str(tmp_path / "in"))
    assert tuple(rows.columns) == SOURCE_FIELDS
    typed = {r.case_number: r for r in intake.type_bronze(rows).collect()}
    assert json.loads(typed["C1"].location) == {"latitude": "41.8", "human_address": None}
    assert " " not in typed["C1"].location
    assert (typed["C1"].id, typed["C1"].beat, typed["C1"].arrest, typed["C1"].domestic) == (1, 111, True, False)
    assert (typed["C1"].ward, typed["C1"].block) == (None, None)
    assert (typed["C2"].arrest, typed["C2"].latitude, typed["C2"].location) == (None, 41.5, None)
    assert typed["Cx9"].id is None


def test_nested_field_of_a_typed_source(spark):
    df = spark.sql("select 1L as id, named_struct('lat', 1.5D, 'note', cast(null as string)) as location")
    assert intake.with_source_fields(df).first().location == '{"lat":1.5,"note":null}'


def test_slice_is_inclusive_and_pushed_down(spark, tmp_path):
    path = str(tmp_path / "typed")
    spark.sql("""select id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id) as updated_on, 2024L as year
                 from range(10)""").write.parquet(path)
    part = intake.incremental_slice(spark.read.parquet(path), datetime(2024, 1, 5), 2024)
    assert sorted(values(part, "id")) == [(i,) for i in range(4, 10)]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(updated_on" in plan and "GreaterThanOrEqual(year,2024)" in plan


def test_watermark(spark):
    mark = lambda df: intake.with_overlap(intake.high_water_mark(df, 2020), 24).first()[:]
    df = bronze(spark, dict(updated_on="2024-03-01 10:00:00"), dict(updated_on="garbage"), dict(updated_on=None))
    assert mark(df) == (datetime(2024, 3, 1, 10), datetime(2024, 2, 29, 10))
    assert mark(df.limit(0))[0] == datetime(2020, 1, 1)
    future = df.unionByName(bronze(spark, dict(updated_on="2999-01-01 00:00:00")))
    assert mark(future)[0] == datetime(2999, 1, 1)
    assert intake.high_water_mark(future, 2020, datetime(2025, 1, 1)).first()[0] == datetime(2024, 3, 1, 10)


# --- snapshots ---------------------------------------------------------------------


def test_readers_see_only_published_tables(spark, root):
    assert snapshots.current(spark, root).version == 0
    with pytest.raises(snapshots.SnapshotMissing):
        snapshots.read_current(spark, root, "t")
    first = snapshots.promote(spark, root, "r1", snapshots.current(spark, root),
                              {"t": snapshots.write_table(spark.range(3), root, "r1", "t")})
    snapshots.write_table(spark.range(99), root, "r2", "t")  # never promoted
    assert snapshots.read_current(spark, root, "t").count() == 3
    second = snapshots.promote(spark, root, "r3", first, {"u": snapshots.write_table(spark.range(5), root, "r3", "u")})
    assert (second.version, set(second.tables)) == (2, {"t", "u"})
    assert snapshots.read_current(spark, root, "t").count() == 3


def test_second_writer_is_noticed(spark, root):
    start = snapshots.current(spark, root)
    ref = snapshots.write_table(spark.range(3), root, "r1", "t")
    snapshots.promote(spark, root, "r1", start, {"t": ref})
    with pytest.raises(snapshots.ConcurrentPublish):
        snapshots.promote(spark, root, "r2", start, {"t": ref})


def test_colliding_writers_leave_the_version_before(spark, root, tmp_path):
    first = snapshots.promote(spark, root, "r1", snapshots.current(spark, root),
                              {"t": snapshots.write_table(spark.range(3), root, "r1", "t")})
    other = str(tmp_path / "other")
    for run in ("r2", "r3"):  # both write version 2
        there = snapshots.promote(spark, f"{other}-{run}", "r1", snapshots.Manifest(), first.tables)
        snapshots.promote(spark, f"{other}-{run}", run, there, {})
        found = spark.read.json(f"{other}-{run}/manifests/000000000002", schema=snapshots.MANIFEST_SCHEMA)
        found.write.mode("append").json(f"{root}/manifests/000000000002", ignoreNullFields=False)
    now = snapshots.current(spark, root)
    assert (now.version, now.run_id, now.highest) == (1, "r1", 2)
    assert snapshots.read_current(spark, root, "t").count() == 3
    ref = snapshots.write_table(spark.range(5), root, "r4", "t")
    assert snapshots.promote(spark, root, "r4", now, {"t": ref}).version == 3
    assert snapshots.read_current(spark, root, "t").count() == 5
    assert [r.path for r in snapshots.stale_tables(spark, root, 1).collect()] == [first.tables["t"].path]
    assert snapshots.stale_tables(spark, root, 2).count() == 0


def test_keyed_tables_leave_no_names_behind(spark, root):
    names = lambda: {t.name for t in spark.catalog.listTables() if not t.isTemporary}
    before = names()
    ref = snapshots.write_keyed([snapshots.by_bucket(spark.range(9), "id", 2)], root, "r", "t", "id", 2)
    assert names() == before
    assert snapshots.read_table(spark, ref).count() == 9 and len(names() - before) == 1
    snapshots.forget(spark, ref)
    assert names() == before
    assert snapshots.read_table(spark, ref).count() == 9
    snapshots.forget(spark, ref)


def test_keyed_tables_need_no_shuffle(spark, root):
    """Silver from Bronze, the Silver checks and a small merge: the stored table stays put."""
    refresh.bootstrap(spark, root, history(spark, *range(1, 50)), 4)
    table = snapshots.read_current(spark, root, BRONZE)
    assert table.count() == 49
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(refresh.to_silver(table, M))
    stage = snapshots.read_table(spark, snapshots.write_table(history(spark, 1, 99), root, "s", "stage"))
    kept, _ = refresh.versions.merge_parts(table, stage)
    assert "BroadcastHashJoin" in plan(kept) and "hashpartitioning" not in plan(kept)


def test_rewriting_does_not_multiply_files(spark, root):
    refresh.bootstrap(spark, root, history(spark, *range(1, 50)), 4)
    for i in range(4):
        ref = snapshots.resolve(snapshots.current(spark, root), BRONZE)
        stage = snapshots.read_table(spark, snapshots.write_table(
            history(spark, i, 100 + i, 200 + i, 300 + i), root, f"s{i}", "stage"))
        merged, _ = refresh.merge_batch(spark, stage, root, f"r{i}", ref)
        snapshots.promote(spark, root, f"r{i}", snapshots.current(spark, root), {BRONZE: merged})
    table = snapshots.read_current(spark, root, BRONZE)
    assert table.count() == 49 + 1 + 4 * 3 and len(table.inputFiles()) <= 2 * 4


def test_empty_table(spark, root):
    refresh.bootstrap(spark, root, history(spark, 1).limit(0), 4)
    assert snapshots.read_current(spark, root, BRONZE).count() == 0


def test_bootstrap_keeps_the_newest_version(spark, root):
    old, new = history(spark, 1, 2), bronze(spark, dict(id=1, updated_on="2024-03-02 00:00:00", block="new"))
    refresh.bootstrap(spark, root, old.unionByName(new), 4)
    assert dict(values(snapshots.read_current(spark, root, BRONZE), "id", "block")) == {1: "new", 2: "B"}


# --- refresh -----------------------------------------------------------------------


def test_refresh(spark, root, tmp_path):
    refresh.bootstrap(spark, root, history(spark, 1, 2, 3), 4)
    land(tmp_path / "in", record(1), record(1, "2024-03-07T00:00:00.000", block="newest"),
         record(2, "2024-02-29T12:00:00.000", block="late"), record(4), record("bad"),
         record(5, "2024-02-28T00:00:00.000"), record(6, year="2019"))
    cfg = RefreshConfig(root, str(tmp_path / "in"))
    row = refresh.run(spark, cfg).first()
    assert (row.status, row.api_records_fetched, row.rows_inserted, row.rows_updated) == ("SUCCESS", 5, 1, 1)
    assert (row.bronze_rows_after, row.silver_rows_after, row.gold_tables_passed) == (4, 4, 5)
    assert len(row) == 9
    stored = dict(values(snapshots.read_current(spark, root, BRONZE), "id", "block"))
    assert stored == {1: "newest", 2: "B", 3: "B", 4: None}
    logged = runlog.read_log(spark, root).first()
    assert (logged.stage_rows, logged.overlap_rows) == (3, 2)
    assert logged.watermark_before == datetime(2024, 2, 29) and logged.watermark_after == datetime(2024, 3, 7)
    # the same files again: everything overlaps, nothing changes
    before = sorted(snapshots.read_current(spark, root, SILVER).drop("ingested_at", "batch_id").collect())
    again = refresh.run(spark, cfg).first()
    assert (again.rows_inserted, again.bronze_rows_after) == (0, 4)
    assert sorted(snapshots.read_current(spark, root, SILVER).drop("ingested_at", "batch_id").collect()) == before
    # nothing landed: skip the merge, still rebuild
    (tmp_path / "none").mkdir()
    idle = refresh.run(spark, RefreshConfig(root, str(tmp_path / "none"))).first()
    assert (idle.api_records_fetched, idle.status, idle.silver_rows_after) == (0, "SUCCESS", 4)
    assert values(runlog.recent_runs(runlog.read_log(spark, root), 2), "api_records_fetched")[0] == (0,)
    # publish the bundle
    tables = bundle.open_tables(spark, root)
    paths = bundle.build(spark, tables, str(tmp_path / "out"), "test")
    assert len(paths) == 11
    core = spark.read.json(paths["meta"]).first()
    assert (core.row_count, core.unique_ids) == (4, 4)
    assert core.hotspot_total == core.geocoded_rows == 2 and core.max_date == "2024-03-05 14:30:00"
    months = [(r.year, r.month, r.primary_type) for r in spark.read.json(paths["monthly"]).collect()]
    assert months == sorted(months)
    for path in paths.values():
        assert not exports.RECORD_LEVEL & set(spark.read.json(path).columns)


def test_failed_gate_publishes_nothing(spark, root, tmp_path):
    refresh.bootstrap(spark, root, history(spark, 1, 2), 4)
    before = snapshots.current(spark, root)
    land(tmp_path / "in", record(1, domestic=None), record(3))
    with pytest.raises(RefreshFailed, match="null_required_fields"):
        refresh.run(spark, RefreshConfig(root, str(tmp_path / "in")))
    assert snapshots.current(spark, root) == before
    assert snapshots.read_current(spark, root, BRONZE).count() == 2
    row = runlog.read_log(spark, root).first()
    assert (row.status, row.rows_inserted, row.rows_updated, row.silver_rows_after) == ("FAILED", 1, 1, 3)
    assert row.watermark_after is None and row.gold_tables_passed == 0 and "null_required_fields" in row.error_message
    kept = spark.read.parquet(f"{snapshots.run_folder(root, row.run_id)}/silver_quality_results")
    assert values(kept.where("validation_status = 'FAIL'"), "test_name", "failed_rows") == [("null_required_fields", 1)]


def test_missing_history(spark, root, tmp_path):
    land(tmp_path / "in", record(1))
    with pytest.raises(RefreshFailed, match="does not exist"):
        refresh.run(spark, RefreshConfig(root, str(tmp_path / "in")))
    assert runlog.read_log(spark, root).first().status == "FAILED"


def test_unlogged_success_is_reported_as_such(spark, root, tmp_path, monkeypatch):
    refresh.bootstrap(spark, root, history(spark, 1), 4)
    land(tmp_path / "in", record(2))
    monkeypatch.setattr(runlog, "log_run", lambda *a: (_ for _ in ()).throw(OSError("disk full")))
    with pytest.raises(refresh.RunLogError, match="published but not recorded"):
        refresh.run(spark, RefreshConfig(root, str(tmp_path / "in")))
    assert snapshots.read_current(spark, root, BRONZE).count() == 2


def test_long_error_text_is_cut(spark):
    r = runlog.RunRecord("r", "p", "d", datetime(2024, 1, 1))
    r.finish("FAILED", datetime(2024, 1, 1, 0, 1), "x" * 5000)
    assert (len(r.error_message), r.duration_seconds, r.frame(spark).count()) == (2000, 60.0, 1)


# --- continuous upsert -------------------------------------------------------------


def test_stream_merges_in_any_split_and_bears_replays(spark, tmp_path):
    files = [[record(1), record(2)], [record(1, "2024-03-08T00:00:00.000", block="n"), record(3)],
             [record(2, "2024-03-01T00:00:00.000", block="late")]]
    expected = {1: "n", 2: None, 3: None}
    for per_batch, waves in ((None, 1), (1, 3)):
        root = str(tmp_path / f"w{waves}")
        landing = tmp_path / f"in{waves}"
        refresh.bootstrap(spark, root, history(spark, 9).limit(0), 4)
        for i, records in enumerate(files):
            land(landing, *records, name=f"f{i}")
            if waves == 3 or i == 2:
                continuous_upsert(spark, str(landing), root, str(tmp_path / f"cp{waves}"), M,
                                  files_per_batch=per_batch).awaitTermination()
        assert dict(values(snapshots.read_current(spark, root, BRONZE), "id", "block")) == expected
    batch = intake.read_landing(spark, str(landing))
    upsert_batch(batch, 2, root, "upsert", "landing", M)  # replayed after a crash
    assert dict(values(snapshots.read_current(spark, root, BRONZE), "id", "block")) == expected


def test_stream_takes_a_new_checkpoint_and_a_second_source(spark, tmp_path):
    root, one, two = str(tmp_path / "t"), tmp_path / "one", tmp_path / "two"
    refresh.bootstrap(spark, root, history(spark, 9).limit(0), 4)
    go = lambda landing, checkpoint: continuous_upsert(
        spark, str(landing), root, str(tmp_path / checkpoint), M).awaitTermination()
    ids = lambda: sorted(r.id for r in snapshots.read_current(spark, root, BRONZE).collect())
    land(one, record(1), name="a")
    go(one, "cp-a")
    land(one, record(2), name="b")
    go(one, "cp-a")
    land(one, record(3), record(4), name="c")
    go(one, "cp-b")
    land(two, record(5), name="d")
    go(two, "cp-c")
    assert ids() == [1, 2, 3, 4, 5]


# --- exports -----------------------------------------------------------------------


def test_record_level_columns_are_refused(spark, tmp_path):
    with pytest.raises(exports.RecordLevelExport, match="crime_id"):
        exports.export_json(silver(spark, dict()), str(tmp_path / "x"))


def test_json_keeps_absent_values(spark, tmp_path):
    df = spark.sql("select 2024L as year, cast(null as string) as district")
    exports.export_json(df, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"year":2024,"district":null}'
    assert exports.read_export(spark, str(tmp_path / "j"), df.schema).first()[:] == (2024, None)


def test_csv_quotes_everything(spark, tmp_path):
    df = spark.createDataFrame([('a "b", c', 1), (None, 2)], "district string, n int")
    exports.export_csv(df, str(tmp_path / "c"))
    lines = {r[0] for r in spark.read.text(str(tmp_path / "c")).collect()}
    assert lines == {'"district","n"', '"a ""b"", c","1"', '"","2"'}


def test_offline_tables(spark, tmp_path):
    s = silver(spark, dict(crime_id=1), dict(crime_id=2))
    for name, frame in rollups.gold_tables(s, M).items():
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    with pytest.raises(Exception, match="silver_crimes_full"):
        bundle.open_parquet(spark, str(tmp_path))
    s.write.parquet(str(tmp_path / "silver_crimes_full.parquet"))
    tables = bundle.open_parquet(spark, str(tmp_path))
    snapshots.register_views(spark, {"silver": tables[SILVER]})
    assert spark.sql("select count(*) from silver").first()[0] == 2
    out = str(tmp_path / "out")
    first = bundle.build(spark, tables, out, "files")
    assert len(first) == 11 and bundle.latest(spark, out) == first
    with pytest.raises(Exception, match="publishing blocked"):
        bundle.build(spark, {**tables, SILVER: tables[SILVER].limit(1)}, out, "files")
    assert bundle.latest(spark, out) == first
    second = bundle.build(spark, tables, out, "files")
    assert bundle.latest(spark, out) == second and second["meta"] != first["meta"]


def test_inventory(spark):
    s = silver(spark, dict(crime_id=1), dict(crime_id=2, date=datetime(2024, 5, 1)))
    row = exports.inventory({SILVER: s}, "test").first()
    assert (row.row_count, row.range_start, row.range_end) == (2, "2024-03-05 14:30:00", "2024-05-01 00:00:00")
    assert [c.name for c in row.columns] == SILVER_SCHEMA.names and row.columns[2].type == "TIMESTAMP"
    assert len(BRONZE_SCHEMA) == 25


# --- touched buckets ---------------------------------------------------------------


def files_of(df):
    """Path, size and time of each file, by which one that was written again is seen."""
    return {p: (os.path.getsize(q), os.stat(q).st_mtime_ns) for p in df.inputFiles() for q in [p.replace("file://", "")]}


def test_only_touched_buckets_are_read_and_written(spark, root):
    refresh.bootstrap(spark, root, history(spark, *range(200)), 16)
    ref = snapshots.resolve(snapshots.current(spark, root), BRONZE)
    before = files_of(snapshots.read_table(spark, ref))
    stage = snapshots.read_table(spark, snapshots.write_table(
        bronze(spark, dict(id=3, updated_on="2024-03-02 00:00:00", block="n"), dict(id=1000)), root, "s", "stage"))
    merged, touched = refresh.merge_batch(spark, stage, root, "r", ref)
    assert touched == sorted({r[0] for r in stage.select(snapshots.bucket_of("id", 16)).collect()}) and 0 < len(touched) <= 2
    read = snapshots.read_table(spark, ref, touched)
    text = read._jdf.queryExecution().executedPlan().toString()
    listed = re.search(r"PartitionFilters: \[([^\]]*\])", text).group(1)
    assert "_bucket" in listed and all(str(b) in listed for b in touched)
    assert len(read.inputFiles()) == len(touched)
    after = files_of(snapshots.read_table(spark, merged))
    kept = {p: v for p, v in after.items() if p in before}
    assert len(kept) == len(before) - len(touched) and all(before[p] == v for p, v in kept.items())
    assert files_of(snapshots.read_table(spark, ref)) == before  # readers of the old version see it unchanged
    assert dict(values(snapshots.read_table(spark, merged), "id", "block")) == {**{i: "B" for i in range(200)}, 3: "n", 1000: "B"}


def test_layers_kept_up_by_deltas_equal_a_rebuild(spark, root, tmp_path):
    """Random batches with corrections, moves between years, types, districts and cells, and an empty batch."""
    rng = random.Random(11)
    start = [dict(id=i, updated_on="2024-01-01 00:00:00", primary_type=rng.choice("XYZ"), arrest=rng.random() < 0.5,
                  year=2024, latitude=41.6 + rng.randrange(3) / 1000, longitude=-87.6) for i in range(40)]
    refresh.bootstrap(spark, root, bronze(spark, *start), 8)
    for turn in range(4):
        landing = tmp_path / f"in{turn}"
        made = []
        for _ in range(0 if turn == 3 else 12):
            year, located = rng.choice([2023, 2024, 2024, 2025]), rng.random() < 0.5
            made.append(record(rng.randrange(60), f"2024-0{turn + 2}-{rng.randrange(10, 28)}T00:00:00.000",
                               primary_type=rng.choice("XYZ"), arrest=rng.random() < 0.5, year=str(year), date=f"{year}-03-05T14:30:00.000",
                               latitude="41.601" if located else None, longitude="-87.6" if located else None, district=rng.choice(["001", "013", None])))
        land(landing, *made)
        refresh.run(spark, RefreshConfig(root, str(landing), start_year=2020))
        refs = snapshots.current(spark, root).tables
        stored = snapshots.read_table(spark, refs[BRONZE])
        silver_now = snapshots.read_table(spark, refs[SILVER])
        whole = refresh.to_silver(stored, RefreshConfig(root, "").model)
        assert sorted(map(str, silver_now.collect())) == sorted(map(str, whole.collect()))
        for name, frame in rollups.gold_tables(whole, RefreshConfig(root, "").model).items():
            kept = snapshots.read_table(spark, refs[name])
            assert kept.schema.simpleString() == frame.schema.simpleString()
            assert sorted(map(str, kept.collect())) == sorted(map(str, frame.collect())), (turn, name)
        m = RefreshConfig(root, "").model
        state, full = quality.merged_state(snapshots.read_table(spark, refs[refresh.STATE]), m), quality.silver_state(stored, whole, m)
        assert state.first().asDict() == full.first().asDict()
    runs = {p for p in snapshots.resolve(snapshots.current(spark, root), SILVER).runs if p}
    assert len(runs) > 1  # buckets of several runs make up the table


def test_checks_by_bucket_equal_checks_of_everything(spark, root):
    """Random batches of sound and broken rows: buckets that a batch touches replace their row of the state."""
    rng, buckets, model = random.Random(5), 8, replace(RefreshConfig(root, "").model, void_coordinate_ids=(3,))
    odd = [{}, {"primary_type": None}, {"year": 2000}, {"year": 2023}, {"latitude": None}, {"beat": "11"}, {"source_file": None},
           {"ward": "x1"}, {"x_coordinate": None}, {"arrest": None}]
    rows, raw = {}, {}
    kept = None
    for turn in range(4):
        new = {rng.randrange(60): rng.choice(odd) for _ in range(0 if turn == 2 else 12)}
        rows |= {i: dict(crime_id=i, **change) for i, change in new.items() if i % 7}  # the others are missing in Silver
        raw |= {i: dict(id=i) for i in new}
        s = silver(spark, *rows.values(), *([rows[max(rows)]] if turn == 3 else []))  # a repeated key
        b = bronze(spark, *raw.values())
        fresh = quality.bucket_state(b, s, model, buckets)
        again = spark.createDataFrame([(i,) for i in new] + [(max(rows),)], "id bigint").select(
            snapshots.bucket_of("id", buckets).alias("bucket")).distinct()
        kept = fresh if kept is None else kept.join(again, "bucket", "left_anti").unionByName(fresh.join(again, "bucket", "left_semi"))
        kept = spark.createDataFrame(kept.collect(), fresh.schema)
        full = quality.silver_state(b, s, model).first().asDict()
        assert quality.merged_state(kept, model).first().asDict() == full
    assert sum(full[name] > 0 for name in quality._silver_rules(model)) >= 5 and full["silver_rows"] > full["silver_keys"]
    none = quality.merged_state(fresh.limit(0), model).first().asDict()
    assert none == quality.silver_state(b.limit(0), s.limit(0), model).first().asDict()


def test_check_state_moves_no_rows(spark, root):
    ref = snapshots.write_keyed([snapshots.by_bucket(history(spark, *range(50)), "id", 4)], root, "r", BRONZE, "id", 4)
    made = silver(spark, *[dict(crime_id=i) for i in range(50)])
    kept = snapshots.write_keyed([snapshots.by_bucket(made, "crime_id", 4)], root, "r", SILVER, "crime_id", 4)
    state = quality.bucket_state(*[snapshots.read_table(spark, r, [1, 2]) for r in (ref, kept)], RefreshConfig(root, "").model, 4)
    plan = _plan(state)
    assert set(re.findall(r"Exchange (\w+)\((\w+)", plan)) == {("hashpartitioning", "bucket")}
    assert plan.count("IN (1,2)") >= 2  # both scans list the buckets asked for
    assert sorted(r.bucket for r in state.collect()) == [1, 2]


def test_buckets_that_a_stream_moved_are_derived_again(spark, root, tmp_path):
    """The stream moves Bronze only; the next run derives what it moved, though its own batch is elsewhere."""
    refresh.bootstrap(spark, root, history(spark, *range(40)), 8)
    land(tmp_path / "in", record(1))
    refresh.run(spark, RefreshConfig(root, str(tmp_path / "in")))
    land(tmp_path / "sent", record(7, "2024-04-01T00:00:00.000", primary_type="ARSON"), record(500, "2024-04-01T00:00:00.000"))
    continuous_upsert(spark, str(tmp_path / "sent"), root, str(tmp_path / "mark"), M).awaitTermination()
    (tmp_path / "none").mkdir()
    refresh.run(spark, RefreshConfig(root, str(tmp_path / "none")))
    refs = snapshots.current(spark, root).tables
    made = dict(values(snapshots.read_table(spark, refs[SILVER]), "crime_id", "primary_type"))
    assert len(made) == 41 and made[7] == "ARSON" and made[500] == "THEFT"
    assert refresh.stale_buckets(spark, refs[BRONZE], refs[refresh.STATE]) == []
    assert snapshots.read_table(spark, refs["gold_arrest_analysis"]).where("primary_type = 'ARSON'").first().total_crimes == 1


def test_another_model_rebuilds_all_layers(spark, root, tmp_path):
    refresh.bootstrap(spark, root, history(spark, *range(30)), 4)
    land(tmp_path / "in", record(1))
    refresh.run(spark, RefreshConfig(root, str(tmp_path / "in")))
    assert snapshots.read_current(spark, root, SILVER).count() == 30
    (tmp_path / "none").mkdir()
    narrow = replace(RefreshConfig(root, "").model, first_year=2024, void_coordinate_ids=(5,))
    refresh.run(spark, RefreshConfig(root, str(tmp_path / "none"), model=narrow))
    ref = snapshots.resolve(snapshots.current(spark, root), SILVER)
    assert len({p for p in ref.runs if p}) == 1 and snapshots.read_table(spark, ref).where("crime_id = 5").first().latitude is None


def test_only_unread_arrivals_are_read(spark, root, tmp_path):
    refresh.bootstrap(spark, root, history(spark, 99), 4)
    landing = tmp_path / "in"
    cfg = RefreshConfig(root, str(landing), arrival="arrival_date")
    day = lambda back: f"arrival_date={datetime.now(timezone.utc).date() - timedelta(days=back)}"
    land(landing / day(40), record(1))
    land(landing / day(39), record(2))
    assert refresh.run(spark, cfg).first().api_records_fetched == 2  # nothing read before: all folders
    land(landing / day(40), record(50), name="never")  # not what its folder says
    land(landing / day(1), record(3), name="late")  # within the overlap
    land(landing / day(0), record(4))
    assert refresh.run(spark, cfg).first().api_records_fetched == 2
    assert sorted(r.id for r in snapshots.read_current(spark, root, BRONZE).collect()) == [1, 2, 3, 4, 99]
    since = refresh._unread_since(spark, cfg)
    read = intake.read_landing(spark, str(landing), arrival="arrival_date", since=since)
    text = read._jdf.queryExecution().executedPlan().toString()
    assert "arrival_date" in re.search(r"PartitionFilters: \[([^\]]*)\]", text).group(1) and tuple(read.columns) == SOURCE_FIELDS
    assert len(read.inputFiles()) == 5 and read.count() == 2
    # Without the column, or for another pipeline, everything is read.
    assert intake.read_landing(spark, str(landing)).count() == 5
    assert refresh._unread_since(spark, replace(cfg, pipeline_name="other")) is None
    assert refresh._unread_since(spark, replace(cfg, arrival=None)) is None


# --- roll-up lattice and observed figures ------------------------------------------


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_from_parents_equals_gold_from_silver(spark, tmp_path):
    """Rows without key, arrest flag, district, or one or both coordinates, and no rows at all."""
    rng = random.Random(5)
    pick = lambda *of: rng.choice(of)
    rows = [dict(crime_id=pick(None, *range(1000)), arrest=pick(True, False, None), district=pick("001", "031", "999", None),
                 primary_type=pick("A", "B", None), domestic=pick(True, False, None), year=pick(2023, 2024),
                 date=pick(None, datetime(2024, 1, 1, 5), datetime(2023, 12, 31, 23)),
                 latitude=pick(None, 41.0004, 41.0016), longitude=pick(None, -87.0, -87.0004)) for _ in range(400)]
    silver(spark, *rows).write.parquet(str(tmp_path / "s"))
    for s in (spark.read.parquet(str(tmp_path / "s")), silver(spark, dict()).limit(0)):
        parents = rollups.parent_rollups(s, M)
        assert _plan(parents).split("== Initial Plan ==")[0].count("FileScan") <= 1
        for name, frame in rollups.gold_tables(s, M).items():
            got = rollups.from_parent(name, parents)
            assert got.schema.simpleString() == frame.schema.simpleString()
            assert sorted(map(str, got.collect())) == sorted(map(str, frame.collect())), name


def test_parents_have_no_more_rows_than_gold(spark):
    """What is shuffled for Gold is bounded by its own groups, not by a finer grain with a group for each row."""
    rows = [dict(crime_id=i, district=f"0{i % 30:02}", primary_type="AB"[i % 2], domestic=i % 3 == 0, date=datetime(2024, 1 + i % 2, 1 + i % 28, i % 24),
                 latitude=41 + i % 5 / 1000, longitude=-87 + i % 7 / 1000) for i in range(300)]
    s = silver(spark, *rows)
    counts = {r["parent"]: r["count"] for r in rollups.parent_rollups(s, M).groupBy("parent").count().collect()}
    assert counts == {name: frame.count() for name, frame in rollups.gold_tables(s, M).items()}


def test_bucket_writes_do_not_sort_whole_rows(spark):
    with snapshots._whole_buckets(spark, 4):
        assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == 0


def test_many_buckets_in_one_task_keep_all_rows(spark, root):
    rows = spark.range(5000).withColumn("x", F.col("id") % 7).coalesce(1)  # more buckets than open files
    ref = snapshots.write_keyed([rows], root, "r", "t", "id", 3 * snapshots.WRITERS)
    got = snapshots.read_table(spark, ref)
    assert sorted(map(tuple, got.collect())) == sorted((i, i % 7) for i in range(5000))
    assert got.where(F.col("id") == 4711).count() == 1 and got.groupBy("id").count().count() == 5000


def test_bundle_checks_do_not_shuffle_silver(spark):
    from tidemark.plans import catalogue

    tables = catalogue._gold(spark, "/root/testdata/sf0.001")
    check = quality.publish_check(tables[SILVER], tables["gold_monthly_crime_trends"], tables["gold_area_crime_summary"])
    for df in (check, rollups.profile(tables[SILVER])):
        assert "hashpartitioning(crime_id" not in _plan(df)


def test_runs_count_while_they_write(spark, root, tmp_path, monkeypatch):
    """No job that only counts, and the landing area is parsed once."""
    refresh.bootstrap(spark, root, history(spark, 1, 2, 3), 4)
    land(tmp_path / "in", record(1), record(1, "2024-03-07T00:00:00.000"), record(4), record(5, None), record(6, "never"))
    def refuse(*_):
        raise AssertionError("a job of its own")
    monkeypatch.setattr(type(spark.range(1)), "count", refuse)
    refresh.run(spark, RefreshConfig(root, str(tmp_path / "in"), start_year=2020))
    monkeypatch.undo()
    told = runlog.read_log(spark, root).first()
    batch = spark.read.parquet(f"{snapshots.run_folder(root, told.run_id)}/bronze_batch")
    assert (told.api_records_fetched, told.stage_rows) == (batch.count(), 2)
    assert (told.rows_inserted, told.rows_updated, told.overlap_rows) == (1, 1, 1)
    stored = snapshots.read_current(spark, root, BRONZE)
    assert (told.bronze_rows_after, told.silver_rows_after) == (stored.count(), stored.count())
    assert told.watermark_after == datetime(2024, 3, 7) and told.gold_tables_passed == 5


def test_cubes_by_year_are_pruned(spark, root):
    from tidemark.operators import filters
    from tidemark.spec import FilterSpec
    years = [2021, 2022, 2023, 2024, None]
    s = silver(spark, *[dict(crime_id=i, year=years[i % 5], date=datetime(years[i % 5] or 2020, 1 + i % 12, 3)) for i in range(60)])
    ref = snapshots.write_keyed([s], root, "r", SILVER, "crime_id", 2)
    snapshots.promote(spark, root, "r", snapshots.current(spark, root), {SILVER: ref})
    bundle.publish_cubes(spark, root)
    for name, build in bundle.CUBES.items():
        stored, made = snapshots.read_current(spark, root, name), build(s)
        assert stored.schema.simpleString() == made.schema.simpleString()
        assert sorted(map(str, stored.collect())) == sorted(map(str, made.collect()))
        assert len(stored.inputFiles()) == 5
        chosen = FilterSpec(start="2022-05", end="2023-02")
        some = filters.apply_filter(stored, chosen)
        assert sorted(map(str, some.collect())) == sorted(map(str, filters.apply_filter(made, chosen).collect()))
        listed = re.search(r"PartitionFilters: \[([^\]]*)\]", _plan(some)).group(1)
        assert ">= 2022" in listed and "<= 2023" in listed
    assert set(snapshots.current(spark, root).tables) == {SILVER, *bundle.CUBES}


def test_a_batch_staged_in_buckets_is_not_shuffled_by_the_merge(spark, tmp_path):
    root = str(tmp_path)
    refresh.bootstrap(spark, root, history(spark, *range(1, 50)), 4)
    ref = snapshots.current(spark, root).tables[refresh.BRONZE]
    stage, _ = refresh.stage_batch(spark, history(spark, *range(40, 60)), root, "r", M, ref=ref)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept, added = refresh.versions.merge_parts(snapshots.read_table(spark, ref), stage)
        assert "Exchange" not in plan(kept) and "Exchange" not in plan(added)
        assert kept.count() == 49 and added.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_landed_files_are_compressed(spark, tmp_path):
    from tidemark.plans import catalogue

    catalogue._land(history(spark, 1, 2, 3), str(tmp_path / "in"))
    files = [f.name for f in (tmp_path / "in").iterdir() if f.name.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    assert intake.read_landing(spark, str(tmp_path / "in")).count() == 3
