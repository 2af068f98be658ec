import pytest

from rows import cube, values
from tidemark.operators import explore, filters
from tidemark.spec import FilterSpec, ordinal, period_text

ALL = FilterSpec(start="2022-01", end="2024-06")


@pytest.fixture(scope="module")
def data(spark):
    """(year, month, district, type, domestic, crimes, arrests)"""
    return cube(
        spark,
        (2022, 1, "001", "A", 0, 100, 10), (2022, 12, "002", "B", 1, 50, 5),
        (2023, 1, "001", "A", 0, 60, 30), (2023, 2, "001", "A", 0, 40, 4),
        (2023, 8, "002", "B", 0, 80, 8), (2023, 3, None, "C", 0, 10, 0),
        (2024, 1, "001", "A", 1, 90, 9), (2024, 2, "002", "B", 0, 20, 2),
        (2024, 6, "UNASSIGNED", "C", 0, 30, 30)).cache()


def test_periods():
    assert [period_text(ordinal(p)) for p in ("2024-01", "1999-12")] == ["2024-01", "1999-12"]


def test_resolving_a_period():
    lo, hi = "2022-01", "2024-06"
    at = lambda **k: (lambda f: (f.start, f.end))(FilterSpec(**k).resolved(lo, hi))
    assert at() == (lo, hi)
    assert at(start="1999-01", end="2023-05") == (lo, "2023-05")
    assert at(start="2023-01", end="2099-01") == ("2023-01", hi)
    assert at(start="2023-05", end="2023-01") == (lo, hi)  # inverted
    assert at(start="2050-01") == (lo, hi)                 # beyond the data
    f = FilterSpec(start=lo, end=hi)
    assert f.with_year(2024, hi) == FilterSpec(year=2024, start="2024-01", end=hi)
    assert f.with_year(2023, hi).end == "2023-12" and f.with_year(None, hi).year is None
    g = f.with_year(2023, hi).with_start("2024-02")
    assert (g.year, g.start, g.end) == (None, "2024-02", "2024-02")
    assert f.with_end("2021-01").start == "2021-01"


def test_active_filters():
    f = FilterSpec(start="2022-01", end="2024-06", district="001", domestic=False, arrest=True)
    assert f.active("2022-01", "2024-06") == ["district", "domestic", "arrest"]
    assert f.active("2022-01", "2024-07")[0] == "period"
    assert FilterSpec().active("2022-01", "2024-06") == []


def test_bounds_and_resolve(data):
    assert filters.period_bounds(data).first()[2:] == ("2022-01", "2024-06")
    assert filters.resolve(data, FilterSpec()) == FilterSpec(start="2022-01", end="2024-06")
    assert filters.resolve(data.limit(0), FilterSpec()) == FilterSpec()


@pytest.mark.parametrize("f, total", [
    (ALL, 480), (FilterSpec(start="2022-12", end="2023-02"), 150), (FilterSpec(year=2024), 140),
    (FilterSpec(district="001"), 290), (FilterSpec(domestic=True), 140), (FilterSpec(primary_type="C"), 40),
    (FilterSpec(arrest=True), 98), (FilterSpec(arrest=False), 382), (FilterSpec(community_area="99"), 0)])
def test_totals(data, f, total):
    assert explore.totals(data, f).first().total == total


def test_filters_a_cube_cannot_apply(data):
    times = data.drop("district", "community_area")
    f = FilterSpec(district="001", domestic=False)
    assert filters.unsupported(times, f) == ["district"]
    with pytest.raises(filters.UnsupportedFilter, match="district"):
        filters.apply_filter(times, f)
    assert filters.apply_filter(times, f, ignore_unsupported=True).count() == 7
    with pytest.raises(filters.UnsupportedFilter, match="period"):
        filters.apply_filter(data.drop("month"), FilterSpec(start="2022-01"))


def test_year_over_year_windows(data):
    yoy = lambda f: explore.year_over_year(data, f).first()[:]
    # ends in June of the target: January to June of both years
    assert yoy(ALL) == (2024, 2023, 140, 110, pytest.approx(300 / 11), 6)
    # starts within the target year
    assert yoy(FilterSpec(start="2024-02", end="2024-06")) == (2024, 2023, 50, 50, 0.0, 5)
    # year chosen, period not in it: last month is the target's last
    assert yoy(FilterSpec(year=2023, start="2022-01", end="2024-06")) == (2023, 2022, 190, 100, pytest.approx(90.0), 8)
    assert yoy(FilterSpec(year=2022, start="2022-01", end="2024-06"))[4:] == (None, None)  # no prior year
    assert yoy(FilterSpec(start="2022-01", end="2024-06", primary_type="Z"))[4:] == (None, None)
    with pytest.raises(ValueError):
        yoy(FilterSpec())


def test_prior_sum_of_zero_has_no_change(spark):
    none = cube(spark, (2023, 1, "001", "A", 0, 5, 0), (2024, 1, "001", "A", 0, 5, 5))
    f = FilterSpec(start="2023-01", end="2024-01", arrest=True)
    assert explore.year_over_year(none, f).first().change_pct is None


def test_fastest_changing(data):
    f = FilterSpec(start="2022-01", end="2024-06")
    got = explore.fastest_changing(data, f, min_volume=20)
    assert values(got, "primary_type", "change_text") == [("C", "+200.0%"), ("A", "-10.0%")]
    assert values(explore.fastest_changing(data, f), "primary_type") == [("A",)]
    assert [r.relative for r in got.collect()] == [1.0, pytest.approx(0.05)]


def test_trailing_mean_runs_over_existing_months(data):
    got = explore.trend(data, ALL, trailing=3).orderBy("period")
    assert values(got, "period", "value")[:4] == [("2022-01", 100.0), ("2022-12", 75.0), ("2023-01", 70.0), ("2023-02", 50.0)]


def test_partial_year(data):
    flags = lambda last: dict(values(explore.annual(data, ALL, last), "year", "partial"))
    assert flags("2024-06") == {2022: False, 2023: False, 2024: True}
    assert not any(flags("2024-12").values())


def test_seasonal_divides_by_years_present(data):
    got = dict(values(explore.seasonal(data, ALL), "label", "value"))
    assert len(got) == 12 and got["Jan"] == pytest.approx(250 / 3) and got["Feb"] == 30.0 and got["Apr"] == 0.0


def test_ranking_ties_and_unknown_district(spark):
    c = cube(spark, (2024, 1, "002", "B", 0, 5, 0), (2024, 1, None, "A", 0, 5, 0), (2024, 1, "001", "C", 0, 5, 0),
             (2024, 1, "003", "C", 0, 9, 0))
    got = explore.top_n(c, FilterSpec(), "district", 3).orderBy("position")
    assert values(got, "position", "district", "relative") == [(1, "003", 1.0), (2, "001", 5 / 9), (3, "002", 5 / 9)]


def test_mix_always_has_other(data):
    got = explore.mix_with_other(data, ALL, "primary_type", 2).orderBy("position")
    assert values(got, "item", "value", "share_text") == [("A", 290, "60.4%"), ("B", 150, "31.3%"), ("Other", 40, "8.3%")]
    assert got.collect()[-1].to_pct == pytest.approx(100.0)
    few = explore.mix_with_other(data, ALL, "primary_type", 5).orderBy("position")
    assert values(few, "position", "item", "value")[-1] == (4, "Other", 0)
    none = explore.mix_with_other(data, FilterSpec(district="zz"), "primary_type", 5)
    assert values(none, "item", "value", "from_pct", "to_pct", "share_text") == [("Other", 0, 0.0, 0.0, "—")]


def test_overview(data):
    row = explore.overview(data, ALL).first()
    assert row.asDict() == dict(
        total=480, latest_period="Jun 2024", latest_value=30, change_pct=pytest.approx(300 / 11), change_months=6,
        top_type="A", top_type_value=290, arrests=98, applicable=480, arrest_rate="20.4%", top_district="001",
        top_district_value=290, strongest_period="Jan 2022", strongest_value=100)
    assert explore.overview(data, FilterSpec(district="zz", start="2022-01", end="2024-06")).count() == 0


def test_overview_change_ignores_the_period(data):
    f = FilterSpec(start="2024-02", end="2024-06")
    row = explore.overview(data, f).first()
    assert (row.total, row.change_pct, row.change_months) == (50, 0.0, 5)


def test_overview_agrees_with_year_over_year(data):
    for f in (ALL, FilterSpec(year=2023, start="2022-01", end="2024-06"), FilterSpec(year=2022, start="2022-01", end="2024-06"),
              FilterSpec(arrest=True, start="2022-01", end="2024-06")):
        a, b = explore.overview(data, f).first(), explore.year_over_year(data, f).first()
        assert (a.change_pct, a.change_months) == (b.change_pct, b.months)


def test_insights(data):
    assert [r.statement for r in explore.insights(data, ALL).orderBy("position").collect()] == [
        "A is the largest category, accounting for 60.4% of selected incidents.",
        "Jan 2022 has the highest monthly volume at 100.",
        "District 001 records the highest volume in the active geographic view.",
        "Comparable volume is 27.3% higher than 2023."]
    early = FilterSpec(start="2022-01", end="2022-12")
    assert explore.insights(data, early).count() == 3  # no prior year


def test_outcomes_follow_the_status(data):
    split = lambda f: dict(values(explore.outcome_split(data, f), "outcome", "incidents"))
    assert split(ALL) == {"Arrested": 98, "Not arrested": 382}
    assert split(FilterSpec(arrest=True)) == {"Arrested": 98, "Not arrested": 0}
    assert split(FilterSpec(arrest=False)) == {"Arrested": 0, "Not arrested": 382}
    rates = explore.enforcement_rates(data, FilterSpec(arrest=True))
    assert {r.rate for r in rates.collect()} == {100.0}


def test_enforcement(data):
    rates = explore.enforcement_rates(data, ALL)
    assert values(rates, "primary_type", "total", "arrests") == [("C", 40, 30), ("A", 290, 53), ("B", 150, 15)]
    assert values(explore.enforcement_rates(data, ALL, "volume", 1), "primary_type") == [("A",)]
    assert values(explore.top_arrests(data, ALL, 2), "primary_type", "relative") == [("A", 1.0), ("C", 30 / 53)]
    one = explore.enforcement_summary(data, ALL).first()
    assert (one.arrest_rate, one.not_arrested, one.highest_type, one.highest_rate) == ("20.4%", 382, "C", 75.0)
    empty = explore.enforcement_summary(data, FilterSpec(district="zz")).first()
    assert (empty.total, empty.arrest_rate, empty.highest_type) == (0, "—", None)


def test_domestic_share_ignores_its_own_filter(data):
    for f in (ALL, FilterSpec(domestic=False)):
        assert explore.domestic_share(data, f).first()[:] == (140, 480, "29.2%")


def test_export_rates_do_not_follow_the_status(data):
    got = explore.district_export(data, FilterSpec(arrest=False))
    assert values(got, "district", "incidents", "arrests", "arrest_rate")[0] == ("001", 237, 53, "18.3%")


def test_time_profiles(spark):
    t = spark.createDataFrame(
        [(2024, 1, "A", 0, 1, 5, 10, 4), (2024, 1, "A", 1, 1, 9, 10, 0), (2024, 2, "B", 0, 7, 23, 3, 3)],
        "year bigint, month int, primary_type string, domestic int, day int, hour int, total_crimes bigint, total_arrests bigint")
    f = FilterSpec()
    hours = explore.hour_profile(t, f).orderBy("hour").collect()
    assert len(hours) == 24 and [h.hour for h in hours if h.is_peak] == [5]  # earliest of equals
    assert explore.peak_hour(t, f).first().peak_text == "Peak hour: 05:00 (10 incidents)."
    days = explore.weekday_profile(t, FilterSpec(district="001")).orderBy("day").collect()
    assert [(d.label, d.value) for d in days][::6] == [("Monday", 20), ("Sunday", 3)]
    grid = explore.week_hour_grid(t, f)
    assert grid.count() == 168 and grid.where("day = 7 and hour = 23").first().intensity == pytest.approx(0.3)
    nothing = explore.week_hour_grid(t, FilterSpec(primary_type="Z"))
    assert nothing.selectExpr("max(intensity)").first()[0] == 0.0


def test_month_spine_fills_gaps(data):
    spine = explore.month_spine(filters.period_bounds(data)).orderBy("period").collect()
    assert len(spine) == 30 and (spine[0].period, spine[11].label, spine[-1].long_label) == ("2022-01", "Dec 2022", "June 2024")


def test_coverage(spark, data):
    grid = spark.createDataFrame([(41.6, -87.6, 200, 1, 0.5), (41.7, -87.6, 100, 0, 0.0)],
                                 "lat_bin double, long_bin double, total_crimes bigint, total_arrests bigint, arrest_rate double")
    assert explore.coverage(data, FilterSpec(year=2024), grid).first()[:] == (140, 3, 2, 300, 480, "62.5%")
    top = explore.top_cells(grid, 1).first()
    assert (top.position, top.location, top.arrest_rate_text) == (1, "41.600, -87.600", "0.5%")
