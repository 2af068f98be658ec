"""What the physical plans must and must not contain, whatever the data's size."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

import __spark_entry__ as driver
from rows import M, bronze
from tidemark.operators import rollups, versions
from tidemark.plans.catalogue import QUERIES
from tidemark.spec import ModelSpec
from tidemark.operators.standardize import to_silver
from tidemark.session import settle, shared_dir, together

LAZY = [n for n in QUERIES if not re.match(r"(s7|s9|s14|s16|s18|s19|o1|o2|o4|o6|x1)_", n)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(LAZY))
def test_no_cross_join_no_python_no_window_over_raw_rows(spark, name):
    text = plan(driver.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups", text)
    assert "RoundRobin" not in text
    # every full sort or gathering into one task comes after an aggregation
    for gathered in re.finditer(r"Exchange SinglePartition[^\n]*\n([^\n]*)", text):
        assert re.search(r"Aggregate|Project|WindowGroupLimit|TakeOrdered|Limit|Sort", gathered.group(1)), text


def test_columns_and_filters_reach_the_scan(spark, tmp_path):
    b = bronze(spark, *[dict(id=i) for i in range(5)])
    b.write.parquet(str(tmp_path / "bronze"))
    table = spark.read.parquet(str(tmp_path / "bronze"))
    text = plan(rollups.monthly_rollup(to_silver(table, M)))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "id", "case_number", "date", "primary_type", "arrest", "year", "updated_on", "ingested_at"}
    assert "GreaterThanOrEqual(year,2020)" in text and "LessThanOrEqual(year,2026)" in text


def test_selection_reaches_a_stored_cube(spark):
    from tidemark.operators import explore
    from tidemark.plans import catalogue
    cube = settle(catalogue.month_cube(spark, SF), "months")
    text = plan(explore.totals(cube, catalogue.SELECTION))
    assert "GreaterThanOrEqual(year,1997)" in text and "EqualTo(domestic,0)" in text


def test_version_ranking_is_cut_before_the_shuffle(spark):
    text = plan(driver.queries()["a1_monthly"](spark, SF))
    final, partial = text.index("row_number(), 1, Final"), text.index("row_number(), 1, Partial")
    assert final < text.index("hashpartitioning(id") < partial


def test_one_scan_for_all_silver_rules(spark):
    text = plan(driver.queries()["q1_q8_silver_checks"](spark, SF))
    assert text.count("FileScan") == 4  # two tables, for Silver and for the Bronze key count


def test_merge_splits_a_hot_target_key(spark):
    """Without a small side the target still sits on the left of left joins, which may be split."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = bronze(spark, *[dict(id=i % 3) for i in range(9)])
        text = plan(versions.upsert_newer(t, versions.latest_stage(t)))
        assert "FullOuter" not in text and "LeftOuter" in text and "LeftSemi" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_settled_tables_go_to_the_shared_folder(spark):
    table = settle(spark.range(3).withColumn("x", F.col("id") * 2), "t")
    assert table.inputFiles()[0].replace("file://", "").startswith(shared_dir(spark).replace("file://", ""))
    assert table.count() == 3


def test_default_tie_breakers_leave_columns_unread(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze(spark, dict(id=1)).write.parquet(path)
    text = plan(rollups.monthly_rollup(to_silver(spark.read.schema(bronze(spark, dict(id=1)).schema).parquet(path), ModelSpec())))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "updated_on" in read and "description" not in read and "x_coordinate" not in read and "block" not in read


def test_jobs_run_together_and_fail_together():
    assert together([lambda: 1, lambda: 2]) == [1, 2]
    with pytest.raises(ZeroDivisionError):
        together([lambda: 1, lambda: 1 // 0])
