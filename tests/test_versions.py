import random
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rows import bronze, values
from tidemark.functions import casts
from tidemark.operators import versions
from tidemark.operators.standardize import to_silver
from rows import M

T0, T1, T2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def _target(spark):
    return bronze(spark, *[dict(id=i, updated_on=u, block="old") for i, u in (
        (1, T1), (2, T1), (3, T1), (4, T1), (5, None), (7, T1))])


def _stage(spark):
    return bronze(spark, *[dict(id=i, updated_on=u, block="new") for i, u in (
        (1, T2), (2, T1), (3, T0), (4, None), (5, T2), (6, T0))])


def test_upsert_cases(spark):
    """Newer, equal, older, undated source, undated target, new key, untouched key."""
    merged = versions.upsert_newer(_target(spark), _stage(spark))
    assert dict(values(merged, "id", "block")) == {
        1: "new", 2: "new", 3: "old", 4: "old", 5: "old", 6: "new", 7: "old"}


def test_change_counts(spark):
    counts = versions.late_rows(versions.change_counts(_target(spark), _stage(spark)))
    assert counts.first().asDict() == dict(rows_inserted=1, rows_updated=2, overlap_rows=5, rows_kept=3)


def test_counts_of_an_empty_stage(spark):
    empty = _stage(spark).limit(0)
    assert versions.change_counts(_target(spark), empty).first()[:] == (0, 0, 0)


def test_duplicate_target_rows_count_and_stay(spark):
    target = bronze(spark, dict(id=1, updated_on=T0), dict(id=1, updated_on=T2))
    stage = bronze(spark, dict(id=1, updated_on=T1, block="new"))
    assert versions.change_counts(target, stage).first()[:] == (0, 1, 2)
    assert sorted(values(versions.upsert_newer(target, stage), "block")) == [("B",), ("new",)]


def test_merge_with_and_without_broadcast(spark):
    expected = sorted(values(versions.upsert_newer(_target(spark), _stage(spark)), "id", "block", "updated_on"),
                      key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = versions.upsert_newer(_target(spark), _stage(spark))
        assert sorted(values(got, "id", "block", "updated_on"), key=str) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merge_is_idempotent(spark):
    once = versions.upsert_newer(_target(spark), _stage(spark))
    twice = versions.upsert_newer(once, _stage(spark))
    assert sorted(once.collect(), key=str) == sorted(twice.collect(), key=str)


def test_any_split_into_batches_gives_the_same_table(spark):
    rng = random.Random(7)
    records = [dict(id=rng.randint(1, 12), updated_on=f"2024-01-01 00:{i:02d}:00", block=str(i))
               for i in rng.sample(range(60), 40)]
    whole = versions.latest_stage(bronze(spark, *records), ("block",))
    expected = sorted(values(whole, "id", "block"))
    rng.shuffle(records)
    table = bronze(spark, dict(id=99)).limit(0)
    for part in (records[:5], records[5:23], records[23:]):
        table = versions.upsert_newer(table, versions.latest_stage(bronze(spark, *part), ("block",)))
    assert sorted(values(table, "id", "block")) == expected


def test_latest_stage_drops_unkeyed_rows_and_breaks_ties(spark):
    rows = bronze(spark, dict(id=None), dict(id=1, block="a"), dict(id=1, block="b"), dict(id=1, updated_on=None, block="z"))
    assert values(versions.latest_stage(rows, ("block",)), "id", "block") == [(1, "b")]
    assert values(versions.latest_stage(rows), "id", "block") == [(1, "b")]  # all columns break ties


def test_one_key_with_a_third_of_all_rows(spark):
    """The hot key is cut to one row per task before the shuffle."""
    base = bronze(spark, dict()).drop("id", "updated_on")
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)")))
        .cast("string").alias("updated_on"))
    latest = versions.keep_latest(hot, "id", [casts.to_timestamp(F.col("updated_on"))], ("updated_on",))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert latest.count() == 20001
    assert latest.where("id = 0").first().updated_on == "2024-01-01 08:19:57"
    assert base.count() == 1


def test_silver(spark):
    raw = bronze(
        spark,
        dict(id=1, updated_on=T0, primary_type=" OLD "),
        dict(id=1, updated_on=T1, primary_type=" NEW ", district=None, beat=12345),
        dict(id=1, updated_on=None, primary_type="UNDATED"),
        dict(id=2, year=2019), dict(id=12848210), dict(id=3, latitude=float("nan")),
        dict(id=4, date="2024"), dict(id=None), dict(id=None))
    got = {r.crime_id: r for r in to_silver(raw, M).collect()}
    assert sorted(got, key=str) == sorted([1, 12848210, 3, 4, None], key=str)
    one = got[1]
    assert (one.primary_type, one.case_number, one.iucr, one.fbi_code) == ("NEW", "C1", "A1", "6X")
    assert (one.beat, one.district, one.ward, one.community_area) == ("1234", None, "02", "03")
    assert one.date == datetime(2024, 3, 5, 14, 30) and got[4].date is None
    void = got[12848210]
    assert (void.x_coordinate, void.y_coordinate, void.latitude, void.longitude) == (None,) * 4
    assert got[3].latitude is None and got[3].longitude == -87.7


def test_newest_by_update_then_intake(spark):
    raw = bronze(spark, dict(id=1, ingested_at=datetime(2024, 1, 1), block="first"),
                 dict(id=1, ingested_at=datetime(2024, 1, 2), block="second"))
    assert values(to_silver(raw, M), "block") == [("second",)]


def test_missing_keys(spark):
    raw = bronze(spark, dict(id=1), dict(id=2, year=1990), dict(id=None))
    assert values(versions.missing_keys(raw, to_silver(raw, M)), "id") == [(2,)]


def test_merge_by_content_does_not_depend_on_splits_or_order(spark):
    """Random versions with equal, unknown and oddly written times, cut into batches at random and in any order."""
    rng = random.Random(23)
    rows = [dict(id=rng.randrange(12), updated_on=rng.choice([None, "never", T0, T1, "2024/1/2", T2]), block=rng.choice([None, "a", "b"]),
                 arrest=rng.choice([True, False, None]), latitude=rng.choice([None, 41.5, float("nan")])) for _ in range(80)]
    order = versions.content_order(bronze(spark, {}).columns, ("block",))
    assert order[0] == "block" and set(order) == set(bronze(spark, {}).columns) - {"id"}
    tables = set()
    for cuts in (0, 1, 3):
        rng.shuffle(rows)
        at = [0, *sorted(rng.sample(range(1, len(rows)), cuts)), len(rows)]
        table = bronze(spark, {}).limit(0)
        for a, b in zip(at, at[1:]):
            stage = versions.latest_stage(bronze(spark, *rows[a:b]), by_content=order)
            merged = versions.upsert_newer(table, stage, order)
            table = spark.createDataFrame(merged.collect(), table.schema)
        assert table.select("id").distinct().count() == table.count()
        tables.add(tuple(sorted(map(str, table.collect()))))
    assert len(tables) == 1
    assert sorted(map(str, versions.upsert_newer(table, stage, order).collect())) == list(tables.pop())  # a replay


def test_packed_versions_give_the_same_rows_with_less_to_shuffle(spark):
    from tidemark.plans import fixture

    lines = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
    day = lambda n: datetime(1997, 3, n)
    rows = [(1, 3, 50, 1, 5.0, 70000.0, 0.0, 0.0, "R", "O", day(2)), (1, 3, 50, 1, 5.0, 70000.0, 0.0, 0.0, "A", "O", day(2)),
            (1, 97, 7, 1, 1.0, 10.0, 0.0, 0.0, None, "O", day(1)), (2, 4, None, 3, None, None, 0.0, 0.0, "N", "O", None),
            (2, 5, 9, 2, 4.0, 9.0, 0.0, 0.0, "N", "F", day(9)), (None, 5, 9, 2, 4.0, 9.0, 0.0, 0.0, "N", "F", day(9)),
            (3, 77, 9, 2, 4.0, 9.0, 0.0, 0.0, "N", "F", day(9))]
    parts = [(n, f"name {n}", f"Brand#{n}", "SMALL", 1, 1.0) for n in (3, 4, 5, 97)]
    folder = tempfile.mkdtemp()
    for name, data, schema in (("lineitem", rows, fixture.SCHEMAS["lineitem"]), ("part", parts, fixture.SCHEMAS["part"])):
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    assert len(lines.split()) == len(rows[0])
    whole, packed = fixture.bronze(spark, folder), fixture.packed(spark, folder)
    plain = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    for a, b in ((to_silver(whole, fixture.MODEL), to_silver(packed, fixture.MODEL, fixture.unpacked)),
                 (versions.latest_stage(whole, fixture.MODEL.tie_breakers),
                  versions.latest_stage(packed, by_content=fixture.CONTENT, unpack=fixture.unpacked))):
        assert plain(a) == plain(b) and len(plain(a)) > 1
    text = to_silver(packed, fixture.MODEL, fixture.unpacked)._jdf.queryExecution().executedPlan().toString()
    sent = text[text.rindex("WindowGroupLimit"):]
    assert "XX BLOCK" not in sent and "latitude" not in sent  # derived above the ranking


def test_versions_are_chosen_before_their_part_is_joined(spark):
    from tidemark.plans import catalogue, fixture

    day = lambda n: datetime(1997, 3, n)
    line = lambda order, part, supp, price, flag, n, number=1: (order, part, supp, number, 5.0, price, 0.0, 0.0, flag, "O", day(n))
    rows = [line(1, 3, 50, 7.0, "R", 2), line(1, 3, 50, 7.0, "A", 2), line(1, 3, 50, 7.0, None, 2), line(1, 98, 50, 7.0, "N", 28),
            line(2, 6, 50, 7.0, "a", 2), line(2, 6, 50, 7.0, "N", 2), line(2, 6, 50, 7.0, "n", 2), line(3, 98, 1, 1.0, "N", 5),
            line(4, None, 1, 1.0, "N", 28), line(4, 4, None, None, "N", 5), line(4, 4, None, None, "N", 5), line(5, 5, 2, 9.0, "N", 9),
            line(5, 3, 2, 9.0, "R", 9), line(None, 3, 2, 9.0, "R", 9), line(9, 3, 2, 9.0, "R", 9, 8), line(10, 3, 2, 9.0, "R", 9, 0)]
    parts = [(n, f"name {n}", f"Brand#{n}", "SMALL", 1, 1.0) for n in (3, 4, 4, 5)] + [
        (6, "name 6", "Brand#6", None, 1, 1.0), (None, "none", "Brand#0", "SMALL", 1, 1.0)]
    plain = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    for more in ([], [(5, "other 5", "Brand#5", "LARGE", 1, 1.0), (3, "name 3", "Brand#9", "SMALL/A", 1, 1.0)]):
        folder = tempfile.mkdtemp()
        for name, data in (("lineitem", rows), ("part", parts + more)):
            spark.createDataFrame(data, fixture.SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")
        whole, lines = fixture.bronze(spark, folder), fixture.lines(spark, folder)
        want = plain(versions.latest_stage(whole, by_content=tuple("date" if c == "shipped" else c for c in fixture.CONTENT)))
        assert want == plain(catalogue.QUERIES["w1_stage_latest"](spark, folder)) and len(want) == 5
        assert want == plain(catalogue.QUERIES["j2_order_free_upsert"](spark, folder))
        assert plain(to_silver(whole, fixture.MODEL)) == plain(to_silver(lines.rows, lines.model, lines.unpack))
        stored = fixture.newest(fixture.packed(spark, folder).where(F.col("source_file") != fixture.NEW_FEED))
        assert plain(fixture.unpacked(stored)) == plain(lines.unpack(fixture.target(lines)))
        text = fixture.newest(lines.rows, lines.model)._jdf.queryExecution().executedPlan().toString()
        assert ("p_name" in text) == bool(more)  # the part's columns are not ranked


def _odd_tables(spark, *more):
    """Lines without key, part, flag or times, parts without type, and versions that tie."""
    day = lambda n: n and datetime(1997, 3, n)
    line = lambda order, part, supp, price, flag, n, number=1: (order, part, supp, number, 5.0, price, 0.0, 0.0, flag, "O", day(n))
    rows = [line(1, 3, 50, 7.0, "R", 2), line(1, 3, 50, 7.0, "A", 2), line(2, 6, 50, 7.0, "N", 2), line(3, 98, 1, 1.0, "N", 5),
            line(4, 4, None, None, "N", 5), line(5, 3, 2, 9.0, None, 9), line(6, 3, 2, 9.0, "R", None), line(None, 4, 2, 9.0, "R", 9),
            line(None, 3, 2, 9.0, "A", 8), line(0, 5, 2, 9.0, "A", 8, 0), line(7, None, 1, 1.0, "N", 28)]
    parts = [(n, f"name {n}", f"Brand#{n}", "SMALL", 1, 1.0) for n in (3, 4, 4, 5)] + [(6, "name 6", "Brand#6", None, 1, 1.0), *more]
    folder = tempfile.mkdtemp()
    from tidemark.plans import fixture
    for name, data in (("lineitem", rows), ("part", parts)):
        spark.createDataFrame(data, fixture.SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")
    return folder


DIFFERING = (5, "other 5", "Brand#5", "LARGE", 1, 1.0)


@pytest.mark.parametrize("more", [(), (DIFFERING,)])
def test_keyed_silver_shuffles_keys_not_rows_to_the_parts(spark, monkeypatch, more):
    from tidemark.plans import catalogue, fixture
    from tidemark.sources import snapshots

    folder, plans, write = _odd_tables(spark, *more), [], snapshots.write_keyed
    monkeypatch.setattr(snapshots, "write_keyed", lambda parts, *rest: (
        plans.extend(p._jdf.queryExecution().executedPlan().toString() for p in parts), write(parts, *rest))[1])
    got, want = catalogue.QUERIES["s9_keyed_snapshot"](spark, folder), to_silver(fixture.bronze(spark, folder), fixture.MODEL)
    plain = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert plain(got) == plain(want) and len(plain(got)) == 6 and got.where("crime_id IS NULL").count() == 1
    ranked = [text for text in plans if "WindowGroupLimit" in text]
    assert ranked and all(("p_name" in text) == bool(more) for text in ranked)


@pytest.mark.parametrize("name", ["q1_q8_silver_checks", "q1_q8_defects_found", "q9_silver_gate"])
def test_silver_checks_do_not_join_parts(spark, name):
    from tidemark.plans import catalogue

    text = catalogue.QUERIES[name](spark, _odd_tables(spark))._jdf.queryExecution().executedPlan().toString()
    assert "p_partkey" not in text and "WindowGroupLimit" in text


def test_silver_checks_without_parts_count_the_same(spark):
    from tidemark.operators import quality
    from tidemark.plans import catalogue, fixture

    for folder in (_odd_tables(spark), _odd_tables(spark, DIFFERING)):
        whole = fixture.bronze(spark, folder)
        want = quality.silver_checks(whole, to_silver(whole, fixture.MODEL), fixture.MODEL)
        got = catalogue.QUERIES["q1_q8_silver_checks"](spark, folder)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert {r["test_name"]: r["failed_rows"] for r in got.collect()}["null_required_fields"] > 0
