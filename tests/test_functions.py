import math
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal, casts, labels, projection as proj
from tidemark.functions.measures import grid_bin, rate_pct


def eval_text(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


LOOSE = ["12", " 12 ", "12.7", "-3.2", "1e3", "", "x", None, "9223372036854775807", "2024",
         "true", "T", "yes", "0", "off", " true ", "2024-01-05", "2024-1-5 03:04:05",
         "2024-01-05T03:04:05.123", "01/02/2024 03:04:05 AM", "NaN",
         "12D", "5f", "1.0d", "061F", "+5", ".5", "5.", ".", "1e", "1E+3", "5.e1", ".e1", "--1", "- 5", "1 2", "inf", "-Infinity",
         "0x10", "0b11", "1_000", "1__0", "_1", "1.5_0", "\t12\n", "9223372036854775808", "9223372036854775807.4", "-0.5", "2.5",
         "2024/01/02 03:04:05", "2024-01-02 24:00:00", "2024-01-02 24:00", "2024-01-02 24:00:01", "2024-01-02T24:00:00.0",
         "2024-01-02T03", "2024-01-02 03", "2024-01-02 03:04", "2024/1/2", "2024-01/02", "2024 01 02", "20240102", "2024-01",
         "24-01-02", "999-01-02", "12024-01-02", "2024-01-02Z", "2024-01-02 03:04:05Z", "2024-01-02 03:04:05+02:30",
         "2024-01-02 03:04:05 UTC", "2024-01-02 03:04:05.1234567", "2024-01-02 03:04:05.", "2024-01-02  03:04:05", "2024-02-30",
         "2024-01-02 25:00:00", "2024-01-02 03:60:00", "2024-01-02 ", "epoch", "2024-001-02", "yes", "on"]


@pytest.mark.parametrize("fn, kind", [
    (casts.to_long, "BIGINT"), (casts.to_double, "DOUBLE"), (casts.to_flag, "BOOLEAN"), (casts.to_timestamp, "TIMESTAMP")])
def test_loose_casts_follow_the_sql_rules(spark, fn, kind):
    con = duckdb.connect()
    # As text, because a client's times end with the year 9999
    expected = [con.execute(f"SELECT TRY_CAST(? AS {kind})::VARCHAR, TRY_CAST(? AS {kind})", [v, v]).fetchall()[0] for v in LOOSE] \
        if kind != "TIMESTAMP" else [con.execute("SELECT epoch_us(TRY_CAST(? AS TIMESTAMP))", [v]).fetchall()[0][0] for v in LOOSE]
    if kind == "TIMESTAMP":
        micros = lambda c: F.unix_micros(fn(c).cast("timestamp"))
        assert dict(zip(LOOSE, eval_text(spark, micros, LOOSE))) == dict(zip(LOOSE, expected))
    else:
        plain = [None if t is None else "nan" if t == "nan" else v for t, v in expected]
        got = ["nan" if isinstance(v, float) and math.isnan(v) else v for v in eval_text(spark, fn, LOOSE)]
        assert dict(zip(LOOSE, got)) == dict(zip(LOOSE, plain))


def test_nan_is_absent(spark):
    assert eval_text(spark, lambda c: casts.finite(casts.to_double(c)), ["NaN", "1.5"]) == [None, 1.5]


def test_trim_takes_unicode_spaces_but_not_tabs(spark):
    assert eval_text(spark, casts.trim_spaces, ["   a b  ", "\ta\n"]) == ["a b", "\ta\n"]


@pytest.mark.parametrize("n, d, rate", [
    (23, 4000, 0.57), (41, 4000, 1.02), (51, 4000, 1.27), (1, 800, 0.13), (0, 0, None), (1, 3, 33.33)])
def test_rate_ties(spark, n, d, rate):
    df = spark.createDataFrame([(n, d)], "n bigint, d bigint")
    assert df.select(rate_pct(F.col("n"), F.col("d"))).first()[0] == rate


def test_rate_equals_sql_at_ties(spark):
    pairs = [(a, b) for b in (800, 1600, 4000) for a in range(0, b, 7)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = {(r.a, r.b): r.r for r in df.select("a", "b", rate_pct(F.col("a"), F.col("b")).alias("r")).collect()}
    con = duckdb.connect()
    for (a, b), r in got.items():
        assert con.execute("SELECT round(100.0 * ?::BIGINT / nullif(?::BIGINT, 0), 2)", [a, b]).fetchall()[0][0] == r


def test_grid_bin_is_the_lower_corner(spark):
    df = spark.createDataFrame([(41.8789,), (-87.6298,), (41.0,)], "v double")
    assert [r[0] for r in df.select(grid_bin(F.col("v"), 1000.0)).collect()] == [41.878, -87.63, 41.0]


def test_percent_rounds_the_exact_value(spark):
    cases = [(0.25, "0.3"), (0.75, "0.8"), (12.25, "12.3"), (1.15, "1.1"), (0.15, "0.1"), (0.35, "0.3"),
             (-0.25, "-0.3"), (1234.0, "1234.0"), (99.95, "100.0")]
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], "i int, x double")
    assert [r[0] for r in df.orderBy("i").select(labels.fixed_one(F.col("x"))).collect()] == [t for _, t in cases]


def test_percent_of_nothing_is_a_dash(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (1, 8)], "n bigint, d bigint")
    assert [r[0] for r in df.select(labels.percent_text(F.col("n"), F.col("d"))).collect()] == ["—", "—", "12.5%"]


def test_compact_numbers(spark):
    cases = {0: "0", 999: "999", 1000: "1K", 1049: "1K", 1050: "1.1K", 123456: "123.5K", 999949: "999.9K",
             999950: "1M", 1250000: "1.3M", 999949999: "999.9M", 999950000: "1B", 2 * 10 ** 12: "2T"}
    df = spark.createDataFrame([(v,) for v in cases], "v bigint")
    got = {r.v: r.t for r in df.select("v", labels.compact_number(F.col("v")).alias("t")).collect()}
    assert got == cases
    assert df.select(labels.compact_number(F.lit(None)), labels.whole_number(F.lit(None))).first()[:] == ("—", "—")


def test_calendar(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5),), (datetime(2023, 12, 31, 23),)], "t timestamp_ntz")
    got = df.select(cal.iso_weekday(F.col("t")), cal.weekday_name(cal.iso_weekday(F.col("t"))),
                    cal.hour_of(F.col("t")), cal.period_label(F.year("t"), F.month("t")),
                    cal.period_key(F.year("t"), F.month("t"))).collect()
    assert [tuple(r) for r in got] == [(1, "Monday", 5, "Jan 2024", "2024-01"), (7, "Sunday", 23, "Dec 2023", "2023-12")]


def test_unknown_weekday_has_no_name(spark):
    df = spark.createDataFrame([(0,), (8,), (None,)], "d int")
    assert [r[0] for r in df.select(cal.weekday_name(F.col("d"))).collect()] == [None] * 3


def test_projection_inverts(spark):
    df = spark.createDataFrame([(41.84, -87.68), (-33.9, 151.2)], "lat double, lon double")
    back = df.select("lat", "lon",
                     proj.latitude_at(proj.mercator_y(F.col("lat"), 12), 12).alias("lat2"),
                     proj.longitude_at(proj.mercator_x(F.col("lon"), 12), 12).alias("lon2")).collect()
    for r in back:
        assert math.isclose(r.lat, r.lat2, abs_tol=1e-9) and math.isclose(r.lon, r.lon2, abs_tol=1e-9)


def test_compact_json_leaves_strings_alone(spark):
    got = eval_text(spark, casts.compact_json, [
        '{"a": "x  y", "b" : [1, 2],\n "c\\"  d": null}', "plain  text", "", None, '{"p": "\\\\"}  '])
    assert got == ['{"a":"x  y","b":[1,2],"c\\"  d":null}', "plain  text", "", None, '{"p":"\\\\"}']


def test_numbers_are_not_read_from_text_again(spark):
    df = spark.createDataFrame([(1.5, "1.5"), (float("nan"), "nan"), (float("inf"), "inf"), (None, None), (-0.0, "-0.0")], "x double, t string")
    got = df.select(casts.to_double(F.col("x")).alias("a"), casts.to_double(F.col("t")).alias("b"), "x")
    assert all(str(r.a) == str(r.b) == str(r.x) for r in got.collect())
    assert "rlike" not in df.select(casts.to_double(F.col("x")).alias("a"))._jdf.queryExecution().optimizedPlan().toString().lower()


def test_usual_numbers_take_the_short_way(spark):
    texts = ["12", "+7", "-3", "007", "999999999999999999", "9223372036854775807", "9223372036854775808", "12 ", "1_0", "\u0001" + "5", "12D", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(casts.to_long(F.col("t"))).collect()]
    assert got == [12, 7, -3, 7, 999999999999999999, 9223372036854775807, None, 12, 10, None, None, None]
    got = [r[0] for r in df.select(casts.to_double(F.col("t"))).collect()]
    assert got[:5] == [12.0, 7.0, -3.0, 7.0, 1e18] and got[7:] == [12.0, 10.0, None, None, None]
