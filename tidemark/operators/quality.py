"""Quality checks on Silver and Gold, and the gates that block a run.

A check result is one row per test or per table. The gates read only those few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import weekday_name
from ..functions.labels import status_label
from ..functions.measures import count_where, rate_pct
from ..sources.snapshots import bucket_of
from ..spec import COORDINATE_FIELDS, LINEAGE_FIELDS, UNASSIGNED, ModelSpec
from .rollups import GOLD, silver_totals, total_parts, totals_of

# Gate messages, and the names of the tests and metrics below.
SILVER_PASSED = "SILVER QUALITY GATE PASSED"
SILVER_FAILED = "SILVER QUALITY GATE FAILED — GOLD BUILD BLOCKED"
GOLD_PASSED = "GOLD QUALITY GATE PASSED"
GOLD_FAILED = "GOLD QUALITY GATE FAILED — PIPELINE REJECTED"

REQUIRED = ("crime_id", "date", "primary_type", "arrest", "domestic", "year")
GOLD_METRICS = ("reconciliation_difference", "duplicate_rows", "null_rows",
                "invalid_measure_rows", "invalid_domain_rows")


class QualityGateError(RuntimeError):
    """A gate found failing checks."""


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _any_null(*names: str) -> Column:
    return _any([F.col(n).isNull() for n in names])


def _malformed(name: str, digits: int) -> Column:
    return F.col(name).isNotNull() & ~F.col(name).rlike(rf"\A[0-9]{{{digits}}}\z")


def _silver_rules(m: ModelSpec) -> dict[str, Column]:
    """Row rules: each column is true for a row that breaks the rule."""
    x, y, lat, lon = COORDINATE_FIELDS
    half = lambda a, b: F.col(a).isNull() != F.col(b).isNull()
    listed = F.col("crime_id").isin(list(m.void_coordinate_ids)) if m.void_coordinate_ids \
        else F.lit(False)
    return {
        "null_required_fields": _any_null(*REQUIRED),
        "invalid_year_or_date": ~F.col("year").between(m.first_year, m.last_year)
        | (F.col("year") != F.year("date")),
        "incomplete_coordinate_pairs": half(x, y) | half(lat, lon),
        "invalid_coordinates_not_corrected":
            listed & _any([F.col(c).isNotNull() for c in COORDINATE_FIELDS]),
        "invalid_geographic_code_format":
            _any([_malformed(c, w) for c, w in m.code_widths.items()]),
        "null_ingestion_lineage": _any_null(*LINEAGE_FIELDS),
    }


def _results(totals: DataFrame, tests: dict[str, Column]) -> DataFrame:
    pairs = [part for name, failed in tests.items()
             for part in (F.lit(name), failed.cast("bigint"))]
    return (totals.select(F.stack(F.lit(len(tests)), *pairs).alias("test_name", "failed_rows"))
            .withColumn("validation_status", status_label(F.col("failed_rows"))))


def _per_key(silver: DataFrame, m: ModelSpec) -> DataFrame:
    """Rows, broken rules and totals by key, which gives the distinct keys without a second pass and needs no
    shuffle where Silver is already partitioned by its key (bucketed, or fresh from the version ranking)."""
    return silver.groupBy("crime_id").agg(
        F.count(F.lit(1)).alias("copies"),
        *[count_where(broken).alias(name) for name, broken in _silver_rules(m).items()],
        *[c.alias(name) for name, c in total_parts().items()])


def _total(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def silver_state(bronze: DataFrame, silver: DataFrame, m: ModelSpec) -> DataFrame:
    """One row: rows, keys and broken rules of Silver, the keys of Bronze, and the totals Gold must add up to.

    Silver is read once.
    """
    totals = _per_key(silver, m).agg(
        _total("copies").alias("silver_rows"), F.count("crime_id").alias("silver_keys"),
        *[_total(name).alias(name) for name in _silver_rules(m)], *totals_of(list(total_parts()), m))
    return totals.withColumn("bronze_keys", bronze.agg(F.countDistinct("id").alias("bronze_keys")).scalar())


def _merged(m: ModelSpec) -> list[Column]:
    """Sums and extremes of rows of ``bucket_state``."""
    sums = ["silver_rows", "silver_keys", "bronze_keys", *_silver_rules(m)]
    best = {"minimum": F.min, "maximum": F.max}
    return [_total(name).alias(name) for name in sums] + [
        best.get(name.partition("_")[0], _total)(name).alias(name) for name in total_parts()]


def bucket_state(bronze: DataFrame, silver: DataFrame, m: ModelSpec, buckets: int) -> DataFrame:
    """One row per bucket of the key: rows, keys and broken rules of Silver, the keys of Bronze, and the parts of
    the totals Gold must add up to.

    A key has one bucket in both tables, so rows of different buckets add up, and a bucket that was written anew
    replaces its row without a look at the others. Tables bucketed by key are not shuffled, only their buckets' sums.
    """
    of_silver = _per_key(silver, m).select(
        bucket_of("crime_id", buckets).alias("bucket"), F.col("copies").alias("silver_rows"),
        F.col("crime_id").isNotNull().cast("bigint").alias("silver_keys"), F.lit(0).cast("bigint").alias("bronze_keys"),
        *_silver_rules(m), *total_parts())
    keys = bronze.where(F.col("id").isNotNull()).groupBy("id").agg(F.lit(1).cast("bigint").alias("bronze_keys"))
    of_bronze = keys.select(bucket_of("id", buckets).alias("bucket"), "bronze_keys")
    each = [rows.groupBy("bucket").agg(*columns) for rows, columns in (
        (of_silver, _merged(m)), (of_bronze, [_total("bronze_keys").alias("bronze_keys")]))]
    return each[0].unionByName(each[1], allowMissingColumns=True).groupBy("bucket").agg(*_merged(m))


def merged_state(states: DataFrame, m: ModelSpec) -> DataFrame:
    """``silver_state`` from rows of ``bucket_state``."""
    sums = ["silver_rows", "silver_keys", *_silver_rules(m)]
    return states.agg(*[_total(name).alias(name) for name in sums], *totals_of(list(total_parts()), m),
                      _total("bronze_keys").alias("bronze_keys"))


def silver_results(state: DataFrame, m: ModelSpec) -> DataFrame:
    """Eight rows: test name, failed rows, status."""
    return _results(state, {
        "bronze_to_silver_row_reconciliation": F.abs(F.col("bronze_keys") - F.col("silver_rows")),
        "duplicate_crime_ids": F.col("silver_rows") - F.col("silver_keys"),
        **{name: F.col(name) for name in _silver_rules(m)},
    })


def silver_checks(bronze: DataFrame, silver: DataFrame, m: ModelSpec) -> DataFrame:
    return silver_results(silver_state(bronze, silver, m), m)


# --- Gold --------------------------------------------------------------------------


def _bad_measures(m: ModelSpec) -> Column:
    total, arrests, rate = F.col("total_crimes"), F.col("total_arrests"), F.col("arrest_rate")
    return ((total <= 0) | (arrests < 0) | (arrests > total) | ~rate.between(0, 100)
            | (F.abs(rate - rate_pct(arrests, total)) > m.rate_tolerance))


def _bad_domain(table: str, m: ModelSpec) -> Column:
    year = ~F.col("year").between(m.first_year, m.last_year)
    blank = lambda c: F.trim(F.col(c)) == ""
    if table == "gold_monthly_crime_trends":
        return year | ~F.col("month").between(1, 12) | blank("primary_type")
    if table == "gold_area_crime_summary":
        return year | ~F.col("district").isin(list(m.valid_districts) + [UNASSIGNED])
    if table == "gold_arrest_analysis":
        # the flag has no third value; NULLs are counted by the null check
        return year | blank("primary_type")
    if table == "gold_time_patterns":
        number = F.col("day_of_week_number")
        return (~number.between(1, 7) | ~F.col("hour_of_day").between(0, 23)
                | (F.col("day_of_week") != weekday_name(number)))
    outside = lambda c: ((F.col(c) < F.col(f"totals.minimum_{c}"))
                         | (F.col(c) > F.col(f"totals.maximum_{c}")))
    return outside("lat_bin") | outside("long_bin")


def _gold_sums(table: str, rollup: DataFrame, totals: Column, m: ModelSpec) -> DataFrame:
    """One row for one Gold table: its sums and four of the metrics."""
    grain = GOLD[table][1]
    if table == "gold_crime_hotspots":  # the range of the grid comes with the totals
        rollup = rollup.withColumn("totals", totals)
    return rollup.agg(
        F.sum("total_crimes").alias("crimes"), F.sum("total_arrests").alias("arrests"),
        (F.count(F.lit(1)) - F.countDistinct(F.struct(*grain))).alias("duplicate_rows"),
        count_where(_any_null(*grain, "total_crimes", "total_arrests", "arrest_rate"))
        .alias("null_rows"),
        count_where(_bad_measures(m)).alias("invalid_measure_rows"),
        count_where(_bad_domain(table, m)).alias("invalid_domain_rows"),
    ).withColumn("gold_table", F.lit(table))


def gold_checks(silver: DataFrame, rollups: dict[str, DataFrame], m: ModelSpec,
                state: DataFrame | None = None) -> DataFrame:
    """One row per Gold table: five metrics and a status.

    The Silver totals are one scalar subquery, named once for the grid and once for all sums; they come from
    ``state`` (``silver_state``, stored) if there is one, else from Silver.
    """
    found = silver_totals(silver, m) if state is None else state
    totals = found.select(F.struct("*").alias("totals")).scalar()
    parts = [_gold_sums(name, frame, totals, m) for name, frame in rollups.items()]
    sums = parts[0]
    for part in parts[1:]:
        sums = sums.unionByName(part)
    located = F.col("gold_table") == "gold_crime_hotspots"
    whole = lambda name: (F.when(located, F.col(f"totals.hotspot_{name}"))
                          .otherwise(F.col(f"totals.all_{name}")))
    # An empty table has no sums: the difference stays NULL and the check fails.
    difference = (F.abs(F.col("crimes") - whole("crimes"))
                  + F.abs(F.col("arrests") - whole("arrests")))
    metrics = sums.withColumn("totals", totals).select(
        "gold_table", difference.cast("bigint").alias(GOLD_METRICS[0]), *GOLD_METRICS[1:])
    clean = F.lit(True)
    for metric in GOLD_METRICS:
        clean = clean & (F.col(metric) == 0)
    return metrics.withColumn("validation_status", status_label(F.when(clean, F.lit(0))))


# --- gates -------------------------------------------------------------------------


def gate_status(results: DataFrame, passed: str, failed: str,
                expected_rows: int | None = None) -> DataFrame:
    """One row ``pipeline_status`` if all checks pass; evaluating it raises otherwise."""
    ok = count_where(F.col("validation_status") != "PASS") == 0
    if expected_rows is not None:
        ok = ok & (F.count(F.lit(1)) == expected_rows)
    return results.agg(ok.alias("ok")).select(
        F.when(F.col("ok"), F.lit(passed)).otherwise(F.raise_error(F.lit(failed)))
        .alias("pipeline_status"))


def gate(results: DataFrame, failed: str, expected_rows: int | None = None) -> int:
    """Raise if any check failed or the number of checks is wrong; else the checks passed."""
    rows = results.collect()  # one row per test or table
    label = results.columns[0]
    bad = [r[label] for r in rows if r["validation_status"] != "PASS"]
    if bad:
        raise QualityGateError(f"{failed}: {', '.join(sorted(bad))}")
    if expected_rows is not None and len(rows) != expected_rows:
        raise QualityGateError(f"{failed}: {len(rows)} of {expected_rows} results")
    return len(rows)


def publish_check(silver: DataFrame, monthly: DataFrame, area: DataFrame) -> DataFrame:
    """One row: the totals that must agree before aggregates are published."""
    sums = lambda df: df.agg(F.sum("total_crimes")).scalar()
    # Summed per key first: on a table partitioned by key neither step shuffles its rows.
    counts = silver.groupBy("crime_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("silver_rows"),
        F.count("crime_id").alias("unique_ids"))
    rows = F.col("silver_rows")
    return (counts.withColumn("monthly_total", sums(monthly)).withColumn("area_total", sums(area))
            .withColumn("reconciled", F.coalesce(
                (rows == F.col("monthly_total")) & (rows == F.col("area_total")), F.lit(False)))
            .withColumn("unique_keys", rows == F.col("unique_ids")))


def require_publishable(silver: DataFrame, monthly: DataFrame, area: DataFrame) -> None:
    row = publish_check(silver, monthly, area).first()
    if not row["reconciled"]:
        raise QualityGateError(
            "publishing blocked: Silver, monthly and area totals do not match")
    if not row["unique_keys"]:
        raise QualityGateError("publishing blocked: duplicate Silver keys")
