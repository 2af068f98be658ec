"""Analytics over the cubes: totals, change, trend, ranking, shares and dense profiles.

Each operator aggregates the cube first. The ranking and running windows that follow see only
the aggregated series, at most one row per month or per value of a dimension.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

from ..functions import calendar as cal
from ..functions import labels
from ..functions.measures import share
from ..spec import FilterSpec, ordinal
from .filters import apply_filter, in_dimensions, in_scope, metric


def _all() -> WindowSpec:
    """All rows of an aggregated, small frame."""
    return Window.partitionBy()


def _sum(c: Column | str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def _by(rows: DataFrame, f: FilterSpec, *keys: str) -> DataFrame:
    """The counted measure, records and arrests by ``keys``."""
    return rows.groupBy(*keys).agg(
        _sum(metric(f)).alias("value"), _sum("total_crimes").alias("total_crimes"),
        _sum("total_arrests").alias("total_arrests"))


def _ranking(value: str, *labels_: str) -> list[Column]:
    """Largest first; ties by label, unknown labels last."""
    return [F.col(value).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in labels_]


def regroup(cube: DataFrame, *keys: str) -> DataFrame:
    """Any coarser grain of a cube."""
    return cube.groupBy(*keys).agg(_sum("total_crimes").alias("total_crimes"),
                                   _sum("total_arrests").alias("total_arrests"))


def totals(cube: DataFrame, f: FilterSpec) -> DataFrame:
    """One row: counted measure, arrests and records in the selection."""
    return apply_filter(cube, f).agg(
        _sum(metric(f)).alias("total"), _sum("total_arrests").alias("arrests"),
        _sum("total_crimes").alias("applicable"))


# --- change ------------------------------------------------------------------------


def _comparison(f: FilterSpec) -> tuple[int, int, int | None]:
    """Target year, first month and last month (None: not bounded by the selection)."""
    if f.year is None and f.end is None:
        raise ValueError("resolve the selection's period first")
    target = f.year if f.year is not None else ordinal(f.end) // 12
    inside = lambda p: p is not None and ordinal(p) // 12 == target
    first = ordinal(f.start) % 12 + 1 if inside(f.start) else 1
    last = ordinal(f.end) % 12 + 1 if inside(f.end) else None
    return target, first, last


def _year_over_year(months: DataFrame, f: FilterSpec) -> DataFrame:
    """One row from ``(year, month, value)`` rows that ignore the selection's period."""
    target, first, last = _comparison(f)
    prior = target - 1
    is_target, is_prior = F.col("year") == target, F.col("year") == prior
    known_last = F.max(F.when(is_target, F.col("month"))).over(_all())
    pair = (months.where(F.col("year").isin(target, prior))
            .withColumn("last", F.lit(last).cast("int") if last else known_last))
    window = F.col("month").between(F.lit(first), F.col("last"))
    sums = pair.agg(
        _sum(F.when(is_target & window, F.col("value"))).alias("current_total"),
        _sum(F.when(is_prior & window, F.col("value"))).alias("prior_total"),
        (F.count(F.when(is_target, 1)) > 0).alias("has_target"),
        (F.count(F.when(is_prior, 1)) > 0).alias("has_prior"),
        F.max("last").alias("last"))
    valid = F.col("has_target") & F.col("has_prior") & (F.col("prior_total") != 0)
    change = ((F.col("current_total") - F.col("prior_total"))
              / F.nullif(F.col("prior_total"), F.lit(0)) * F.lit(100.0))
    return sums.select(
        F.lit(target).cast("bigint").alias("target_year"),
        F.lit(prior).cast("bigint").alias("prior_year"),
        "current_total", "prior_total",
        F.when(valid, change).alias("change_pct"),
        F.when(valid, F.col("last") - F.lit(first) + 1).cast("int").alias("months"))


def year_over_year(cube: DataFrame, f: FilterSpec) -> DataFrame:
    """One row: target year against the same months of the year before.

    The window ends with the selection if that ends in the target year, else with the last
    month the target year has. ``change_pct`` is NULL without a usable prior year.
    """
    target = _comparison(f)[0]
    rows = cube.where(in_dimensions(cube, f) & F.col("year").isin(target, target - 1))
    return _year_over_year(_by(rows, f, "year", "month"), f)


def fastest_changing(cube: DataFrame, f: FilterSpec, min_volume: int = 100,
                     k: int = 10) -> DataFrame:
    """The ``k`` types whose volume changed most against the prior year."""
    target, first, last = _comparison(f)
    rows = cube.where(in_dimensions(cube, f) & F.col("year").isin(target, target - 1)
                      & F.col("month").between(first, last or 12))
    side = lambda year: _sum(F.when(F.col("year") == year, metric(f)))
    a, b = F.col("current_total"), F.col("prior_total")
    top = (rows.groupBy("primary_type")
           .agg(side(target).alias("current_total"), side(target - 1).alias("prior_total"))
           .where((b > 0) & (a + b >= min_volume))
           .withColumn("change_pct", (a - b) / b * F.lit(100.0))
           .orderBy(F.abs("change_pct").desc(), F.col("primary_type").asc_nulls_last()).limit(k))
    cap = F.greatest(F.max(F.abs("change_pct")).over(_all()), F.lit(1.0))
    return top.select("primary_type", "current_total", "prior_total", "change_pct",
                      (F.abs("change_pct") / cap).alias("relative"),
                      labels.signed_percent_text(F.col("change_pct")).alias("change_text"))


# --- series ------------------------------------------------------------------------


def trend(cube: DataFrame, f: FilterSpec, trailing: int = 1) -> DataFrame:
    """Monthly series; with ``trailing`` > 1 the mean of up to that many existing months."""
    series = _by(apply_filter(cube, f), f, "year", "month")
    value = F.col("value")
    if trailing > 1:
        recent = Window.orderBy("year", "month").rowsBetween(1 - trailing, 0)
        value = F.avg("value").over(recent)
    return series.select("year", "month",
                         cal.period_key(F.col("year"), F.col("month")).alias("period"),
                         cal.period_label(F.col("year"), F.col("month")).alias("label"),
                         value.alias("value"))


def annual(cube: DataFrame, f: FilterSpec, last_period: str) -> DataFrame:
    """Volume by year; the data's last year is partial unless it reaches December."""
    last = ordinal(last_period)
    partial = (F.col("year") == last // 12) & F.lit(last % 12 < 11)
    return _by(apply_filter(cube, f), f, "year").select("year", "value", partial.alias("partial"))


def _spine(spark: SparkSession, name: str, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias(name))


def seasonal(cube: DataFrame, f: FilterSpec) -> DataFrame:
    """Twelve rows: mean volume per calendar month over the years that have it."""
    by_month = (_by(apply_filter(cube, f), f, "year", "month")
                .groupBy("month").agg(F.sum("value").alias("value"), F.count("year").alias("years")))
    spine = _spine(cube.sparkSession, "month", 1, 12)
    mean = F.coalesce(F.col("value"), F.lit(0)) / F.greatest(
        F.coalesce(F.col("years"), F.lit(0)), F.lit(1))
    return spine.join(by_month, "month", "left").select(
        "month", F.date_format(cal.first_day(F.lit(2000), F.col("month")), "MMM").alias("label"),
        mean.alias("value"))


def _profile(time_cube: DataFrame, f: FilterSpec, key: str, first: int, last: int) -> DataFrame:
    """The measure by one calendar part, every value of the part present."""
    found = _by(apply_filter(time_cube, f, ignore_unsupported=True), f, key).select(key, "value")
    return (_spine(time_cube.sparkSession, key, first, last).join(found, key, "left")
            .select(key, F.coalesce("value", F.lit(0)).cast("bigint").alias("value")))


def weekday_profile(time_cube: DataFrame, f: FilterSpec) -> DataFrame:
    """Seven rows. The time cube has no place: such filters do not apply here."""
    return _profile(time_cube, f, "day", 1, 7).select(
        "day", cal.weekday_name(F.col("day")).alias("label"), "value")


def hour_profile(time_cube: DataFrame, f: FilterSpec) -> DataFrame:
    """24 rows, the peak hour marked (the earliest of equals)."""
    hours = _profile(time_cube, f, "hour", 0, 23)
    peak = F.min_by("hour", F.struct(-F.col("value"), F.col("hour"))).over(_all())
    return hours.select("hour", F.format_string("%02d:00", "hour").alias("label"), "value",
                        (F.col("hour") == peak).alias("is_peak"))


def peak_hour(time_cube: DataFrame, f: FilterSpec) -> DataFrame:
    """One row: the busiest hour and a sentence about it."""
    top = hour_profile(time_cube, f).where("is_peak")
    text = F.concat(F.lit("Peak hour: "), F.col("label"), F.lit(" ("),
                    labels.whole_number(F.col("value")), F.lit(" incidents)."))
    return top.select("hour", "value", text.alias("peak_text"))


def week_hour_grid(time_cube: DataFrame, f: FilterSpec) -> DataFrame:
    """168 rows: weekday by hour with the share of the busiest cell."""
    found = _by(apply_filter(time_cube, f, ignore_unsupported=True), f, "day", "hour")
    spine = time_cube.sparkSession.range(168).select(
        (F.floor(F.col("id") / 24) + 1).cast("int").alias("day"),
        (F.col("id") % 24).cast("int").alias("hour"))
    dense = spine.join(found, ["day", "hour"], "left").select(
        "day", "hour", F.coalesce("value", F.lit(0)).cast("bigint").alias("value"))
    peak = F.greatest(F.max("value").over(_all()), F.lit(1))
    return dense.withColumn("intensity", F.col("value") / peak)


def month_spine(bounds: DataFrame) -> DataFrame:
    """Every month from the first to the last of ``period_bounds``."""
    months = bounds.select(F.explode(F.sequence("low", "high")).alias("m"))
    year, month = F.floor(F.col("m") / 12), (F.col("m") % 12 + 1).cast("int")
    return months.select(year.alias("year"), month.alias("month"),
                         cal.period_key(year, month).alias("period"),
                         cal.period_label(year, month).alias("label"),
                         cal.period_long_label(year, month).alias("long_label"))


# --- rankings and shares -----------------------------------------------------------


def top_n(cube: DataFrame, f: FilterSpec, key: str, n: int = 10) -> DataFrame:
    """The ``n`` largest values of ``key`` with share of all and size relative to the first."""
    grouped = _by(apply_filter(cube, f), f, key).select(key, "value")
    whole, largest = F.sum("value").over(_all()), F.max("value").over(_all())
    sized = grouped.select(
        key, "value", share(F.col("value"), whole).alias("share_pct"),
        (F.col("value") / F.when(largest == 0, F.lit(1)).otherwise(largest)).alias("relative"))
    ranked = sized.orderBy(*_ranking("value", key)).limit(n)
    rank = F.row_number().over(Window.orderBy(*_ranking("value", key)))
    return ranked.select(rank.alias("position"), key, "value", "share_pct", "relative")


def mix_with_other(cube: DataFrame, f: FilterSpec, key: str, n: int = 5) -> DataFrame:
    """The ``n`` largest values and the rest as "Other", with running share bounds."""
    grouped = _by(apply_filter(cube, f), f, key).select(key, "value")
    rank = F.row_number().over(Window.orderBy(*_ranking("value", key)))
    placed = grouped.withColumn("rank", rank)
    listed = F.col("rank") <= n
    slots = placed.select(
        F.when(listed, F.col("rank")).otherwise(F.lit(n + 1)).alias("slot"),
        F.when(listed, F.col(key).cast("string")).otherwise(F.lit("Other")).alias("item"), "value")
    rest = cube.sparkSession.range(1).select(
        F.lit(n + 1).alias("slot"), F.lit("Other").alias("item"), F.lit(0).cast("bigint").alias("value"))
    items = (slots.unionByName(rest).groupBy("slot", "item")
             .agg(F.greatest(F.sum("value"), F.lit(0)).alias("value")))
    whole, up_to = F.sum("value").over(_all()), F.sum("value").over(Window.orderBy("slot"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return items.select(
        F.row_number().over(Window.orderBy("slot")).alias("position"), "item", "value",
        zero(share(up_to - F.col("value"), whole)).alias("from_pct"),
        zero(share(up_to, whole)).alias("to_pct"),
        labels.percent_text(F.col("value"), whole).alias("share_text"))


def _scoped_groups(cube: DataFrame, f: FilterSpec) -> DataFrame:
    """The selection by month, by type, by district and in total: one pass over the cube.

    ``value`` and its siblings respect the period; ``any_period`` does not (for the change
    against the prior year). ``level`` is the grouping id.
    """
    scope = in_scope(cube, f)
    scoped = lambda c: F.sum(F.when(scope, c))
    target = _comparison(f)[0]
    rows = cube.where(in_dimensions(cube, f) & (scope | F.col("year").isin(target, target - 1)))
    return rows.groupingSets(
        [["year", "month"], ["primary_type"], ["district"], []],
        "year", "month", "primary_type", "district",
    ).agg(F.grouping_id().alias("level"),
          scoped(metric(f)).alias("value"),
          scoped(F.col("total_arrests")).alias("arrests"),
          scoped(F.col("total_crimes")).alias("applicable"),
          _sum(metric(f)).alias("any_period"))


# Grouping ids of the four levels: a set bit means the column is aggregated away.
_MONTH, _TYPE, _DISTRICT, _TOTAL = 0b0011, 0b1101, 0b1110, 0b1111


def overview(cube: DataFrame, f: FilterSpec) -> DataFrame:
    """One row of headline figures for the selection."""
    groups = _scoped_groups(cube, f)
    at = lambda level: (F.col("level") == level) & F.col("value").isNotNull()

    def first_of(level: int, pick: Column, *order: Column) -> Column:
        """``pick`` of the first row of a level; rows outside the level do not compete."""
        return F.min_by(pick, F.when(at(level), F.struct(*order)))

    month = cal.period_ordinal(F.col("year"), F.col("month"))
    by_size = lambda c: (-F.col("value"), F.col(c).isNull(), F.col(c))
    cells = lambda c: F.struct(F.col(c).cast("string").alias("name"), F.col("value").alias("value"))
    months = F.struct(F.col("year").alias("year"), F.col("month").alias("month"),
                      F.col("value").alias("value"))
    one = groups.agg(
        F.max(F.when(F.col("level") == _TOTAL, F.struct("value", "arrests", "applicable"))).alias("all"),
        first_of(_MONTH, months, -month).alias("latest"),
        first_of(_MONTH, months, -F.col("value"), month).alias("strongest"),
        first_of(_TYPE, cells("primary_type"), *by_size("primary_type")).alias("type"),
        first_of(_DISTRICT, cells("district"), *by_size("district")).alias("district"),
        F.collect_list(F.when(
            (F.col("level") == _MONTH)
            & F.col("year").isin(_comparison(f)[0], _comparison(f)[0] - 1),
            F.struct("year", "month", F.col("any_period").alias("value")))).alias("pair"),
    ).where(F.col("all.value").isNotNull())  # nothing selected: no row
    return _with_change(one, f).select(
        F.col("all.value").cast("bigint").alias("total"),
        cal.period_label(F.col("latest.year"), F.col("latest.month")).alias("latest_period"),
        F.col("latest.value").cast("bigint").alias("latest_value"),
        "change_pct", "change_months",
        F.col("type.name").alias("top_type"), F.col("type.value").cast("bigint").alias("top_type_value"),
        F.col("all.arrests").cast("bigint").alias("arrests"),
        F.col("all.applicable").cast("bigint").alias("applicable"),
        labels.percent_text(F.col("all.arrests"), F.col("all.applicable")).alias("arrest_rate"),
        F.col("district.name").alias("top_district"),
        F.col("district.value").cast("bigint").alias("top_district_value"),
        cal.period_label(F.col("strongest.year"), F.col("strongest.month")).alias("strongest_period"),
        F.col("strongest.value").cast("bigint").alias("strongest_value"))


def _with_change(one: DataFrame, f: FilterSpec) -> DataFrame:
    """Year over year from the at most 24 months kept in ``pair``."""
    target, first, last = _comparison(f)
    of = lambda year: F.filter("pair", lambda p: p["year"] == year)
    end = F.lit(last) if last else F.array_max(F.transform(of(target), lambda p: p["month"]))

    def total(year: int) -> Column:
        inside = F.filter(of(year), lambda p: p["month"].between(F.lit(first), F.col("last")))
        return F.aggregate(inside, F.lit(0).cast("bigint"), lambda s, p: s + p["value"])

    sums = (one.withColumn("last", end)
            .withColumn("current", total(target)).withColumn("prior", total(target - 1)))
    valid = (F.size(of(target)) > 0) & (F.size(of(target - 1)) > 0) & (F.col("prior") != 0)
    change = ((F.col("current") - F.col("prior")) / F.nullif(F.col("prior"), F.lit(0)) * F.lit(100.0))
    return (sums.withColumn("change_pct", F.when(valid, change))
            .withColumn("change_months", F.when(valid, F.col("last") - first + 1).cast("int")))


def insights(cube: DataFrame, f: FilterSpec) -> DataFrame:
    """Up to four sentences about the selection, in order. Their wording is a fixed value."""
    row = overview(cube, f)
    pct = F.col("change_pct")
    district = F.coalesce(F.col("top_district"), F.lit(labels.DASH))
    sentences = F.array(
        F.concat(F.coalesce("top_type", F.lit(labels.DASH)),
                 F.lit(" is the largest category, accounting for "),
                 labels.percent_text(F.col("top_type_value"), F.col("total")),
                 F.lit(" of selected incidents.")),
        F.concat("strongest_period", F.lit(" has the highest monthly volume at "),
                 labels.whole_number(F.col("strongest_value")), F.lit(".")),
        F.concat(F.lit("District "), district,
                 F.lit(" records the highest volume in the active geographic view.")),
        F.concat(F.lit("Comparable volume is "), labels.fixed_one(F.abs(pct)),
                 F.when(pct >= 0, F.lit("% higher")).otherwise(F.lit("% lower")),
                 F.lit(f" than {_comparison(f)[0] - 1}.")))
    kept = row.select(F.posexplode(F.filter(sentences, lambda s: s.isNotNull())).alias("p", "statement"))
    return kept.select((F.col("p") + 1).alias("position"), "statement")


def district_ranking(cube: DataFrame, f: FilterSpec, n: int = 10) -> DataFrame:
    """Largest districts of the selection."""
    return top_n(cube, f, "district", n)


def coverage(cube: DataFrame, f: FilterSpec, grid: DataFrame) -> DataFrame:
    """One row: selected records and districts; cells and located share of all data."""
    selected = apply_filter(cube, f).groupBy("district").agg(F.sum(metric(f)).alias("value"))
    cells = grid.agg(F.struct(F.count(F.lit(1)).alias("n"), _sum("total_crimes").alias("located"))).scalar()
    everything = cube.agg(_sum("total_crimes")).scalar()
    return (selected.agg(_sum("value").alias("selected_total"),
                         F.count(F.lit(1)).alias("selected_districts"))
            .withColumn("hotspot_cells", cells.getField("n"))
            .withColumn("geocoded_rows", cells.getField("located"))
            .withColumn("all_rows", everything)
            .withColumn("coverage_text", labels.percent_text(F.col("geocoded_rows"), F.col("all_rows"))))


def top_cells(grid: DataFrame, k: int = 12) -> DataFrame:
    """The busiest grid cells, with a printable location."""
    top = grid.orderBy(*_ranking("total_crimes", "lat_bin", "long_bin")).limit(k)
    rank = F.row_number().over(Window.orderBy(*_ranking("total_crimes", "lat_bin", "long_bin")))
    fixed3 = lambda c: F.translate(F.format_number(F.col(c), 3), ",", "")
    return top.select(
        rank.alias("position"), "lat_bin", "long_bin",
        F.concat(fixed3("lat_bin"), F.lit(", "), fixed3("long_bin")).alias("location"),
        "total_crimes", "total_arrests",
        F.concat(labels.fixed_one(F.col("arrest_rate")), F.lit("%")).alias("arrest_rate_text"))


# --- outcomes ----------------------------------------------------------------------


def _outcomes_by_type(cube: DataFrame, f: FilterSpec) -> DataFrame:
    """Records and arrests by type; an arrest filter narrows both."""
    by_type = regroup(apply_filter(cube, f), "primary_type")
    total, arrests = F.col("total_crimes"), F.col("total_arrests")
    if f.arrest is True:
        total = arrests
    elif f.arrest is False:
        total, arrests = total - arrests, F.lit(0).cast("bigint")
    return by_type.select("primary_type", total.alias("total"), arrests.alias("arrests"))


def enforcement_rates(cube: DataFrame, f: FilterSpec, sort: str = "rate",
                      k: int | None = None) -> DataFrame:
    """Arrest rate by type, sorted by ``rate``, ``volume`` or ``arrests``; ``k`` for the first k."""
    rated = (_outcomes_by_type(cube, f).where(F.col("total") > 0)
             .withColumn("rate", share(F.col("arrests"), F.col("total"))))
    cap = F.greatest(F.max("rate").over(_all()), F.lit(1.0))
    sized = rated.withColumn("relative", F.col("rate") / cap)
    by = {"rate": "rate", "volume": "total", "arrests": "arrests"}[sort]
    ordered = sized.orderBy(*_ranking(by, "primary_type"))
    return ordered if k is None else ordered.limit(k)


def top_arrests(cube: DataFrame, f: FilterSpec, k: int = 10) -> DataFrame:
    """Types with most arrests, with size relative to the first."""
    top = enforcement_rates(cube, f, "arrests", k).select("primary_type", "arrests")
    largest = F.max("arrests").over(_all())
    return top.withColumn(
        "relative", F.col("arrests") / F.when(largest == 0, F.lit(1)).otherwise(largest))


def outcome_split(cube: DataFrame, f: FilterSpec) -> DataFrame:
    """Two rows: records with and without an arrest and their shares."""
    sums = _outcomes_by_type(cube, f).agg(_sum("total").alias("total"), _sum("arrests").alias("arrests"))
    rows = sums.select("total", F.stack(
        F.lit(2), F.lit("Arrested"), F.col("arrests"),
        F.lit("Not arrested"), F.col("total") - F.col("arrests")).alias("outcome", "incidents"))
    return rows.select("outcome", "incidents",
                       (F.col("incidents") / F.greatest("total", F.lit(1)) * F.lit(100.0)).alias("width_pct"),
                       labels.percent_text(F.col("incidents"), F.col("total")).alias("share_text"))


def enforcement_summary(cube: DataFrame, f: FilterSpec) -> DataFrame:
    """One row: overall rate, both outcomes and the type with the highest rate."""
    rated = _outcomes_by_type(cube, f).withColumn("rate", share(F.col("arrests"), F.col("total")))
    best = F.min_by(F.struct("primary_type", "rate"), F.when(
        F.col("total") > 0,
        F.struct(-F.col("rate"), F.col("primary_type").isNull(), F.col("primary_type"))))
    one = rated.agg(_sum("total").alias("total"), _sum("arrests").alias("arrests"), best.alias("best"))
    rest = F.col("total") - F.col("arrests")
    return one.select(
        "total", "arrests", rest.alias("not_arrested"),
        labels.percent_text(F.col("arrests"), F.col("total")).alias("arrest_rate"),
        labels.percent_text(rest, F.col("total")).alias("not_arrested_rate"),
        F.col("best.primary_type").alias("highest_type"), F.col("best.rate").alias("highest_rate"))


def domestic_share(cube: DataFrame, f: FilterSpec) -> DataFrame:
    """One row: domestic part of the selection, whatever its domestic filter says."""
    rows = apply_filter(cube, replace(f, domestic=None))
    return rows.agg(
        _sum(F.when(F.col("domestic") == 1, metric(f))).alias("domestic_total"),
        _sum(metric(f)).alias("grand_total"),
    ).withColumn("share_text", labels.percent_text(F.col("domestic_total"), F.col("grand_total")))


def district_export(cube: DataFrame, f: FilterSpec) -> DataFrame:
    """District table for download; arrests and rate do not follow the arrest filter."""
    by_district = _by(apply_filter(cube, f), f, "district")
    return by_district.select(
        "district", F.col("value").alias("incidents"), F.col("total_arrests").alias("arrests"),
        labels.percent_text(F.col("total_arrests"), F.col("total_crimes")).alias("arrest_rate"),
    ).orderBy(*_ranking("incidents", "district"))


# --- reference data for the page ---------------------------------------------------


def methodology(profile: DataFrame, bounds: DataFrame) -> DataFrame:
    """Three rows about the data's coverage: label, value, note (fixed texts)."""
    high = bounds.select("high").scalar()
    one = profile.select("row_count", "unique_ids", high.alias("high"))
    year = F.floor(F.col("high") / 12)
    through = cal.period_label(year, F.col("high") % 12 + 1)
    text = F.concat
    return one.select(F.stack(
        F.lit(3),
        F.lit("Refresh mode"), F.lit("Automated daily pipeline"),
        text(F.lit("Last verified coverage through "), through),
        F.lit("Pipeline volume"), labels.whole_number(F.col("row_count")),
        text(labels.whole_number(F.col("unique_ids")), F.lit(" unique crime IDs")),
        text(year.cast("string"), F.lit(" is partial")), F.lit("Comparable periods only"),
        text(F.lit("Coverage ends "), through)).alias("label", "value", "note"))


def filter_options(values: DataFrame, bounds: DataFrame) -> DataFrame:
    """Choices per filter with labels and positions: years newest first, the rest ascending."""
    value = F.col("value")
    label = (F.when(F.col("dimension") == "district",
                    F.when(value == "UNASSIGNED", F.lit("Unassigned"))
                    .otherwise(F.concat(F.lit("District "), value)))
             .when(F.col("dimension") == "community_area", F.concat(F.lit("Area "), value))
             .otherwise(value))
    months = month_spine(bounds).select(F.lit("period").alias("dimension"),
                                        F.col("period").alias("value"),
                                        F.col("long_label").alias("label"))
    rows = values.select("dimension", "value", label.alias("label")).unionByName(months)
    newest = F.when(F.col("dimension") == "year", -F.col("value").try_cast("bigint"))
    place = Window.partitionBy("dimension").orderBy(newest.asc_nulls_last(),
                                                    F.col("value").asc_nulls_last())
    return rows.select("dimension", F.row_number().over(place).alias("position"), "value", "label")
