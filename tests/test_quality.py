from datetime import datetime
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rows import M, bronze, silver
from tidemark.operators import quality, rollups
from tidemark.operators.quality import QualityGateError


def failing(results):
    return {r[0]: r["failed_rows"] for r in results.collect() if r["validation_status"] != "PASS"}


def checks(spark, *rows, raw=None):
    frame = silver(spark, *rows)
    raw = raw or [dict(id=r.get("crime_id", 1)) for r in rows]
    return quality.silver_checks(bronze(spark, *raw), frame, M)


def test_clean_silver_passes(spark):
    results = checks(spark, dict(crime_id=1), dict(crime_id=2, district=None, latitude=None, longitude=None))
    assert failing(results) == {} and results.count() == 8
    assert quality.gate(results, quality.SILVER_FAILED, 8) == 8
    assert quality.gate_status(results, quality.SILVER_PASSED, quality.SILVER_FAILED).first()[0] == quality.SILVER_PASSED


DEFECTS = [
    (dict(date=None), "null_required_fields"), (dict(primary_type=None), "null_required_fields"),
    (dict(arrest=None), "null_required_fields"), (dict(domestic=None), "null_required_fields"),
    (dict(year=2023), "invalid_year_or_date"),
    (dict(year=2019, date=datetime(2019, 1, 1)), "invalid_year_or_date"),
    (dict(x_coordinate=None), "incomplete_coordinate_pairs"),
    (dict(longitude=None), "incomplete_coordinate_pairs"),
    (dict(crime_id=12852880), "invalid_coordinates_not_corrected"),
    (dict(beat="11"), "invalid_geographic_code_format"), (dict(district="0A1"), "invalid_geographic_code_format"),
    (dict(ward="02\n"), "invalid_geographic_code_format"), (dict(community_area="003"), "invalid_geographic_code_format"),
    (dict(ingested_at=None), "null_ingestion_lineage"), (dict(source_file=None), "null_ingestion_lineage"),
    (dict(batch_id=None), "null_ingestion_lineage"),
]


@pytest.mark.parametrize("defect, test", DEFECTS)
def test_each_silver_defect_trips_its_check_only(spark, defect, test):
    assert failing(checks(spark, defect, dict(crime_id=5))) == {test: 1}


def test_duplicate_key(spark):
    results = checks(spark, dict(crime_id=1), dict(crime_id=1), dict(crime_id=2), raw=[dict(id=1), dict(id=2), dict(id=3)])
    assert failing(results) == {"duplicate_crime_ids": 1}


def test_unkeyed_and_out_of_range_rows_break_reconciliation(spark):
    lost = checks(spark, dict(crime_id=1), raw=[dict(id=1), dict(id=2, year=1990)])
    assert failing(lost) == {"bronze_to_silver_row_reconciliation": 1}
    unkeyed = failing(checks(spark, dict(crime_id=None), raw=[dict(id=None)]))
    assert unkeyed == {"bronze_to_silver_row_reconciliation": 1, "duplicate_crime_ids": 1, "null_required_fields": 1}


def test_gate_raises_and_names_the_checks(spark):
    bad = checks(spark, dict(beat="1"))
    with pytest.raises(QualityGateError, match="invalid_geographic_code_format"):
        quality.gate(bad, quality.SILVER_FAILED)
    with pytest.raises(Exception, match="GOLD BUILD BLOCKED"):
        quality.gate_status(bad, quality.SILVER_PASSED, quality.SILVER_FAILED).collect()


def test_gate_wants_every_result(spark):
    with pytest.raises(QualityGateError, match="7 of 8"):
        quality.gate(checks(spark, dict()).limit(7), quality.SILVER_FAILED, 8)


# --- Gold --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def layers(spark):
    rows = [dict(crime_id=i, date=datetime(2024, 1 + i % 12, 1 + i % 28, i % 24), arrest=i % 4 == 0,
                 district=f"{i % 33:03d}", latitude=41.6 + i / 1000, longitude=-87.6 - i / 500) for i in range(60)]
    s = silver(spark, *rows).cache()
    return s, {n: t.cache() for n, t in rollups.gold_tables(s, M).items()}


def gold_failures(s, gold):
    return {r.gold_table: {k for k in quality.GOLD_METRICS if r[k] != 0}
            for r in quality.gold_checks(s, gold, M).collect() if r.validation_status != "PASS"}


def test_clean_gold_passes(layers):
    s, gold = layers
    assert gold_failures(s, gold) == {}
    assert quality.gate(quality.gold_checks(s, gold, M), quality.GOLD_FAILED, 5) == 5


BAD_GOLD = [
    ("gold_monthly_crime_trends", "month", "13", {"invalid_domain_rows"}),
    ("gold_monthly_crime_trends", "primary_type", "' '", {"invalid_domain_rows"}),
    ("gold_monthly_crime_trends", "year", "2031L", {"invalid_domain_rows"}),
    ("gold_area_crime_summary", "district", "'013'", {"invalid_domain_rows"}),
    ("gold_arrest_analysis", "domestic", "cast(null as boolean)", {"null_rows"}),
    ("gold_time_patterns", "day_of_week", "'Someday'", {"invalid_domain_rows"}),
    ("gold_time_patterns", "hour_of_day", "24", {"invalid_domain_rows"}),
    ("gold_crime_hotspots", "lat_bin", "99.0D", {"invalid_domain_rows"}),
    ("gold_crime_hotspots", "arrest_rate", "arrest_rate + 0.02D", {"invalid_measure_rows"}),
    ("gold_area_crime_summary", "arrest_rate", "cast(null as double)", {"null_rows"}),
    ("gold_time_patterns", "total_arrests", "total_crimes + 1", {"reconciliation_difference", "invalid_measure_rows"}),
    ("gold_arrest_analysis", "total_crimes", "0L", {"reconciliation_difference", "invalid_measure_rows"}),
]


@pytest.mark.parametrize("table, column, value, metrics", BAD_GOLD)
def test_each_gold_defect_trips_its_metric(layers, table, column, value, metrics):
    s, gold = layers
    keys = rollups.GOLD[table][1]
    first = gold[table].orderBy(*keys).first()
    here = F.lit(True)
    for k in keys:
        here = here & F.col(k).eqNullSafe(F.lit(first[k]))
    broken = gold[table].withColumn(column, F.when(here, F.expr(value)).otherwise(F.col(column)))
    found = gold_failures(s, {**gold, table: broken})
    assert found[table] - {"invalid_measure_rows"} >= metrics - {"invalid_measure_rows"}
    assert metrics <= found[table] and set(found) == {table}


def test_repeated_grain(layers):
    s, gold = layers
    t = "gold_area_crime_summary"
    twice = gold[t].unionByName(gold[t].limit(1))
    assert gold_failures(s, {**gold, t: twice}) == {t: {"reconciliation_difference", "duplicate_rows"}}


def test_empty_gold_fails(layers):
    s, gold = layers
    t = "gold_time_patterns"
    results = quality.gold_checks(s, {**gold, t: gold[t].limit(0)}, M).where(F.col("gold_table") == t).first()
    assert results.reconciliation_difference is None and results.validation_status == "FAIL"


def test_a_cent_off_fails(spark, layers):
    """0.58 instead of 0.57 is more than the tolerance in binary floating point."""
    s, gold = layers
    t = "gold_arrest_analysis"
    row = spark.createDataFrame([(2024, "X", False, 4000, 23, 0.58)], gold[t].schema)
    assert "invalid_measure_rows" in gold_failures(s, {**gold, t: row})[t]


def test_publish_check(layers, spark):
    s, gold = layers
    monthly, area = gold["gold_monthly_crime_trends"], gold["gold_area_crime_summary"]
    quality.require_publishable(s, monthly, area)
    with pytest.raises(QualityGateError, match="totals"):
        quality.require_publishable(s, monthly.limit(1), area)
    doubled = s.unionByName(s)
    gold2 = rollups.gold_tables(doubled, M)
    with pytest.raises(QualityGateError, match="duplicate"):
        quality.require_publishable(doubled, gold2["gold_monthly_crime_trends"], gold2["gold_area_crime_summary"])


def test_gold_counts_keys_and_cubes_count_rows(spark):
    s = silver(spark, dict(crime_id=None), dict(crime_id=2))
    assert rollups.monthly_rollup(s).first().total_crimes == 1
    assert rollups.month_geo_cube(s).first().total_crimes == 2


def test_district_rules_differ(spark):
    s = silver(spark, *[dict(crime_id=i, district=d) for i, d in enumerate(("031", "013", None, "001"))])
    area = {r.district: r.total_crimes for r in rollups.area_rollup(s, M).collect()}
    assert area == {"UNASSIGNED": 3, "001": 1}
    cube = {r.district: r.total_crimes for r in rollups.month_geo_cube(s).collect()}
    assert cube == {"UNASSIGNED": 1, "013": 1, None: 1, "001": 1}


def test_year_cube_is_the_month_cube_rolled_up(layers):
    s, _ = layers
    direct, rolled = rollups.geo_cube(s), rollups.geo_cube_from_months(rollups.month_geo_cube(s))
    assert sorted(direct.collect(), key=str) == sorted(rolled.select(*direct.columns).collect(), key=str)


def test_empty_void_list(spark):
    m = replace(M, void_coordinate_ids=())
    s = silver(spark, dict(crime_id=12852880))
    assert failing(quality.silver_checks(bronze(spark, dict(id=12852880)), s, m)) == {}
