"""The registered queries as plain SQL over the given tables, for comparison.

Each statement is a chain of common table expressions; ``_sql`` puts the ones it names in front.
"""

from __future__ import annotations

from ..spec import SOURCE_FIELDS
from .fixture import ODD_NUMBERS, ODD_TIMES

SQL: dict[str, str] = {}

# The columns a sender fills; a landed version's remaining ties are decided by all of them.
_SENT = [c for c in SOURCE_FIELDS if c != "location"]
_BY_SENT = "CAST(updated_on AS TIMESTAMP) DESC NULLS LAST, {between}" + ", ".join(
    f"{c} DESC NULLS LAST" for c in _SENT if c not in ("id", "updated_on"))


def _odd(values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"[{listed}][id % {len(values)} + 1]"


_ORDER = """CAST(updated_on AS TIMESTAMP) DESC NULLS LAST{ingested},
            tie1 DESC, tie2 DESC, tie3 DESC, tie4 DESC, primary_type DESC"""
_BY_UPDATE = _ORDER.format(ingested="")
_BY_UPDATE_AND_INTAKE = _ORDER.format(ingested=", ingested_at DESC NULLS LAST")

_BRONZE_COLUMNS = """id, case_number, date, block, iucr, primary_type, description,
  location_description, arrest, domestic, beat, district, ward, community_area, fbi_code,
  x_coordinate, y_coordinate, year, updated_on, latitude, longitude, ingested_at, source_file,
  batch_id"""

_DISTRICTS = """('001','002','003','004','005','006','007','008','009','010','011','012',
  '014','015','016','017','018','019','020','022','024','025')"""


def _silver(void: str, name: str = "silver") -> str:
    coordinate = lambda c: (f"CASE WHEN id IN ({void}) THEN NULL ELSE {c} END AS {c}"
                            if void else c)
    return f"""{name} AS (
  SELECT id AS crime_id, trim(case_number) AS case_number, CAST(date AS TIMESTAMP) AS date, block,
    upper(trim(iucr)) AS iucr, trim(primary_type) AS primary_type, description,
    location_description, arrest, domestic,
    lpad(CAST(beat AS VARCHAR), 4, '0') AS beat,
    lpad(CAST(district AS VARCHAR), 3, '0') AS district,
    lpad(CAST(ward AS VARCHAR), 2, '0') AS ward,
    lpad(CAST(community_area AS VARCHAR), 2, '0') AS community_area,
    upper(trim(fbi_code)) AS fbi_code,
    {coordinate('x_coordinate')}, {coordinate('y_coordinate')}, year,
    CAST(updated_on AS TIMESTAMP) AS updated_on,
    {coordinate('latitude')}, {coordinate('longitude')}, ingested_at, source_file, batch_id
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_BY_UPDATE_AND_INTAKE}) AS v
        FROM bronze WHERE year BETWEEN 1995 AND 2001)
  WHERE v = 1)"""


_MEASURES = """count(crime_id) AS total_crimes,
    count(CASE WHEN arrest THEN crime_id END) AS total_arrests,
    round(100.0 * count(CASE WHEN arrest THEN crime_id END) / nullif(count(crime_id), 0), 2)
      AS arrest_rate"""
_COUNTS = "count(*) AS total_crimes, CAST(sum(CAST(arrest AS INTEGER)) AS BIGINT) AS total_arrests"
_PLACE = """CASE WHEN district = '031' THEN 'UNASSIGNED' ELSE district END AS district,
    coalesce(community_area, 'UNKNOWN') AS community_area, primary_type,
    CAST(domestic AS INTEGER) AS domestic"""
_MONTH = "CAST(extract(month FROM date) AS INTEGER) AS month"

_CTE = {
    "bronze": """bronze AS (
  SELECT l_orderkey * 8 + l_linenumber AS id,
    concat('  C', CAST(l_orderkey AS VARCHAR), ' ') AS case_number,
    CAST(l_shipdate + ((l_partkey * 7 + l_suppkey) % 24) * INTERVAL '1' HOUR AS VARCHAR) AS date,
    concat(CAST(l_partkey % 100 AS VARCHAR), 'XX BLOCK') AS block,
    concat(' a', CAST(l_partkey % 40 AS VARCHAR)) AS iucr,
    concat(p_type, '/', l_returnflag) AS primary_type,
    p_name AS description, p_brand AS location_description,
    (l_extendedprice > 60000) AS arrest, (l_suppkey % 5 = 0) AS domestic,
    l_suppkey % 32 * 100 + l_partkey % 40 AS beat,
    CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE l_suppkey % 32 END AS district,
    l_partkey % 50 + 1 AS ward, l_partkey % 77 + 1 AS community_area,
    concat(' ', lower(l_returnflag), '1') AS fbi_code,
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE 1100000.0e0 + l_suppkey END AS x_coordinate,
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE 1800000.0e0 + l_partkey END AS y_coordinate,
    CAST(extract(YEAR FROM l_shipdate) AS BIGINT) AS year,
    CAST(l_shipdate + (l_partkey % 30) * INTERVAL '1' DAY AS VARCHAR) AS updated_on,
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE 41.6e0 + (l_partkey % 400) / 1000.0e0 END AS latitude,
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE -87.9e0 + (l_suppkey % 300) / 1000.0e0 END AS longitude,
    l_shipdate + (l_suppkey % 7) * INTERVAL '1' DAY AS ingested_at,
    concat('src-', CAST(l_partkey % 3 AS VARCHAR)) AS source_file,
    concat('batch-', CAST(l_partkey % 3 AS VARCHAR)) AS batch_id,
    l_partkey AS tie1, l_suppkey AS tie2, l_extendedprice AS tie3, l_quantity AS tie4
  FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "stage": f"""stage AS (
  SELECT * EXCLUDE (v) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_BY_UPDATE}) AS v
    FROM bronze WHERE source_file = 'src-0') WHERE v = 1)""",
    "target": f"""target AS (
  SELECT * EXCLUDE (v) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_BY_UPDATE}) AS v
    FROM bronze WHERE source_file <> 'src-0') WHERE v = 1)""",
    "merged": """merged AS (
  SELECT t.* FROM target t LEFT JOIN stage s ON s.id = t.id
  WHERE NOT coalesce(CAST(s.updated_on AS TIMESTAMP) >= CAST(t.updated_on AS TIMESTAMP), FALSE)
  UNION ALL
  SELECT s.* FROM stage s LEFT JOIN target t ON s.id = t.id
  WHERE t.id IS NULL OR CAST(s.updated_on AS TIMESTAMP) >= CAST(t.updated_on AS TIMESTAMP))""",
    "silver": _silver("11, 26"),
    "unvoided": _silver("", "unvoided"),
    "monthly": f"""monthly AS (
  SELECT year, {_MONTH}, primary_type, {_MEASURES} FROM silver GROUP BY 1, 2, 3)""",
    "area": f"""area AS (
  SELECT year, CASE WHEN district IN {_DISTRICTS} THEN district ELSE 'UNASSIGNED' END AS district,
    {_MEASURES} FROM silver GROUP BY 1, 2)""",
    "outcome": f"""outcome AS (
  SELECT year, primary_type, domestic, {_MEASURES} FROM silver GROUP BY 1, 2, 3)""",
    "week": f"""week AS (
  SELECT CAST(isodow(date) AS INTEGER) AS day_of_week_number, dayname(date) AS day_of_week,
    CAST(hour(date) AS INTEGER) AS hour_of_day, {_MEASURES} FROM silver GROUP BY 1, 2, 3)""",
    "grid": f"""grid AS (
  SELECT floor(latitude * 1000) / 1000.0e0 AS lat_bin, floor(longitude * 1000) / 1000.0e0 AS long_bin,
    {_MEASURES} FROM silver WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2)""",
    "months": f"""months AS (
  SELECT year, {_MONTH}, {_PLACE}, {_COUNTS} FROM silver GROUP BY ALL)""",
    "years": f"""years AS (SELECT year, {_PLACE}, {_COUNTS} FROM silver GROUP BY ALL)""",
    "times": f"""times AS (
  SELECT year, {_MONTH}, primary_type, CAST(domestic AS INTEGER) AS domestic,
    CAST(isodow(date) AS INTEGER) AS day, CAST(hour(date) AS INTEGER) AS hour, {_COUNTS}
  FROM silver GROUP BY ALL)""",
    # the registered selections: value follows the arrest filter
    "sel": """sel AS (
  SELECT *, total_crimes AS value FROM months
  WHERE year * 100 + month BETWEEN 199703 AND 200008 AND domestic = 0)""",
    "sel_arrested": """sel_arrested AS (
  SELECT *, total_arrests AS value FROM months WHERE year * 100 + month BETWEEN 199601 AND 200106)""",
    "sel_open": """sel_open AS (
  SELECT *, total_crimes - total_arrests AS value FROM months WHERE year = 1999)""",
    "sel_place": """sel_place AS (
  SELECT *, total_crimes AS value FROM months
  WHERE year * 100 + month BETWEEN 199602 AND 199911 AND district = '005')""",
    "tsel": """tsel AS (
  SELECT *, total_crimes AS value FROM times
  WHERE year * 100 + month BETWEEN 199703 AND 200008 AND domestic = 0)""",
    "tsel_arrested": """tsel_arrested AS (
  SELECT *, total_arrests AS value FROM times WHERE year * 100 + month BETWEEN 199601 AND 200106)""",
    "tsel_open": """tsel_open AS (
  SELECT *, total_crimes - total_arrests AS value FROM times WHERE year = 1999)""",
    "bounds": """bounds AS (
  SELECT min(year * 12 + month - 1) AS low, max(year * 12 + month - 1) AS high FROM months)""",
}

# What each part is built on, nearest first.
_NEEDS = {
    "stage": ["bronze"], "target": ["bronze"], "merged": ["stage", "target"],
    "silver": ["bronze"], "unvoided": ["bronze"],
    **{t: ["silver"] for t in ("monthly", "area", "outcome", "week", "grid", "months", "years", "times")},
    **{t: ["months"] for t in ("sel", "sel_arrested", "sel_open", "sel_place", "bounds")},
    **{t: ["times"] for t in ("tsel", "tsel_arrested", "tsel_open")},
}


def _sql(name: str, parts: str, body: str) -> None:
    ordered: list[str] = []

    def add(part: str) -> None:
        for need in _NEEDS.get(part, []):
            add(need)
        if part not in ordered:
            ordered.append(part)

    for part in parts.split():
        add(part)
    SQL[name] = "WITH " + ",\n".join(_CTE[p] for p in ordered) + "\n" + body.strip()


# --- display text ------------------------------------------------------------------


def _fixed_one(x: str) -> str:
    """One decimal, exact halves away from zero."""
    return (f"printf('%.1f', CASE WHEN ({x}) * 4 = floor(({x}) * 4) AND abs(({x}) * 4) % 2 = 1"
            f" THEN ({x}) + sign({x}) * 0.01e0 ELSE ({x}) END)")


def _percent(n: str, d: str) -> str:
    ratio = f"CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) * 100.0e0"
    return f"CASE WHEN ({d}) > 0 THEN concat({_fixed_one(ratio)}, '%') ELSE '—' END"


def _grouped(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def _compact(v: str) -> str:
    def unit(size: int, letter: str) -> str:
        tenths = f"((({v}) + {size // 20}) // {size // 10})"
        return (f"concat(CAST({tenths} // 10 AS VARCHAR), CASE WHEN {tenths} % 10 = 0 THEN ''"
                f" ELSE concat('.', CAST({tenths} % 10 AS VARCHAR)) END, '{letter}')")
    return (f"CASE WHEN ({v}) < 1000 THEN CAST({v} AS VARCHAR)"
            f" WHEN ({v}) < 999950 THEN {unit(10 ** 3, 'K')}"
            f" WHEN ({v}) < 999950000 THEN {unit(10 ** 6, 'M')}"
            f" WHEN ({v}) < 999950000000 THEN {unit(10 ** 9, 'B')}"
            f" ELSE {unit(10 ** 12, 'T')} END")


def _label(pattern: str, year: str = "year", month: str = "month") -> str:
    return f"strftime(make_date({year}, {month}, 1), '{pattern}')"


# --- intake and versions -----------------------------------------------------------

_sql("s1_incremental_slice", "bronze", """
SELECT * FROM bronze
WHERE CAST(updated_on AS TIMESTAMP) >= (
    SELECT max(CAST(updated_on AS TIMESTAMP)) - INTERVAL '8760' HOUR
    FROM bronze WHERE source_file <> 'src-0')
  AND year >= 2001""")
_sql("s1_pruned_landing", "bronze", """
SELECT year, primary_type, count(*) AS records, count(DISTINCT id) AS ids, max(updated_on) AS newest
FROM bronze WHERE CAST(ingested_at AS DATE) >= DATE '2001-03-01' GROUP BY ALL""")
_sql("s2_stamped_intake", "bronze", """
SELECT id, case_number, date, block, iucr, primary_type, description, location_description, arrest,
  domestic, beat, district, ward, community_area, fbi_code, x_coordinate, y_coordinate, year,
  updated_on, latitude, longitude, CAST(NULL AS VARCHAR) AS location,
  TIMESTAMP '2024-01-02 03:04:05' AS ingested_at, 'landing' AS source_file, 'batch-x' AS batch_id
FROM bronze""")
_sql("s3_s4_watermark_overlap", "bronze", """
SELECT max(CAST(updated_on AS TIMESTAMP)) AS high_water_mark,
  max(CAST(updated_on AS TIMESTAMP)) - INTERVAL '24' HOUR AS watermark FROM bronze""")
_sql("p1_bronze_typing", "bronze", """
, raw AS (
  SELECT * REPLACE (
    CASE WHEN tie1 % 50 = 0 THEN concat('x', id) ELSE CAST(id AS VARCHAR) END AS id,
    CASE WHEN id % 8 = 1 THEN concat(year, '.0') WHEN id % 8 = 2 THEN concat(' ', year)
      ELSE CAST(year AS VARCHAR) END AS year,
    CASE WHEN id % 8 = 3 THEN concat(beat, '.7') WHEN id % 8 = 4 THEN {odd_numbers} ELSE CAST(beat AS VARCHAR) END AS beat,
    CASE WHEN id % 8 = 6 THEN {odd_numbers} ELSE CAST(y_coordinate AS VARCHAR) END AS y_coordinate,
    CASE WHEN id % 8 = 5 THEN '1e1' WHEN id % 8 = 6 THEN '' ELSE CAST(ward AS VARCHAR) END AS ward,
    CASE WHEN id % 8 = 4 THEN CASE WHEN arrest THEN 't' ELSE 'f' END
      WHEN id % 8 = 5 THEN CASE WHEN arrest THEN 'yes' ELSE 'no' END
      WHEN id % 8 = 6 THEN CASE WHEN arrest THEN ' true ' ELSE ' false ' END
      ELSE CAST(arrest AS VARCHAR) END AS arrest,
    CASE WHEN id % 8 = 2 THEN 'n/a' ELSE CAST(x_coordinate AS VARCHAR) END AS x_coordinate,
    CASE WHEN id % 8 = 7 THEN '2024' WHEN id % 8 = 3 THEN {odd_times} ELSE CAST(ingested_at AS VARCHAR) END AS ingested_at)
  FROM bronze)
SELECT * EXCLUDE (tie1, tie2, tie3, tie4) REPLACE (
  TRY_CAST(id AS BIGINT) AS id, TRY_CAST(year AS BIGINT) AS year, TRY_CAST(beat AS BIGINT) AS beat,
  TRY_CAST(ward AS BIGINT) AS ward, TRY_CAST(arrest AS BOOLEAN) AS arrest,
  TRY_CAST(x_coordinate AS DOUBLE) AS x_coordinate, TRY_CAST(y_coordinate AS DOUBLE) AS y_coordinate,
  TRY_CAST(ingested_at AS TIMESTAMP) AS ingested_at)
FROM raw""".replace("{odd_numbers}", _odd(ODD_NUMBERS)).replace("{odd_times}", _odd(ODD_TIMES)))
_sql("w1_stage_latest", "bronze", f"""
SELECT * EXCLUDE (v) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_BY_UPDATE}) AS v
  FROM bronze WHERE id IS NOT NULL) WHERE v = 1""")
_sql("j1_j3_change_counts", "stage target", """
, c AS (
  SELECT count(CASE WHEN t.id IS NULL THEN 1 END) AS rows_inserted,
    count(CASE WHEN CAST(s.updated_on AS TIMESTAMP) >= CAST(t.updated_on AS TIMESTAMP) THEN 1 END)
      AS rows_updated,
    count(t.id) AS overlap_rows
  FROM stage s LEFT JOIN target t ON s.id = t.id)
SELECT *, overlap_rows - rows_updated AS rows_kept FROM c""")
_sql("j2_upsert_newer", "merged", "SELECT * FROM merged")
_sql("j2_order_free_upsert", "bronze", f"""
SELECT * EXCLUDE (v) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_BY_UPDATE}) AS v FROM bronze) WHERE v = 1""")
_sql("p1_nested_location", "bronze", """
SELECT id, concat('{"human_address":"', block, '","latitude":',
  CASE WHEN tie1 % 97 = 0 THEN 'null' ELSE concat('"', tie1, '"') END, '}') AS location FROM bronze""")

# --- Silver and Gold ---------------------------------------------------------------

_sql("w2_p2_silver", "silver", "SELECT * FROM silver")
_sql("a1_monthly", "monthly", "SELECT * FROM monthly")
_sql("a2_area", "area", "SELECT * FROM area")
_sql("a3_outcome", "outcome", "SELECT * FROM outcome")
_sql("a4_time_of_week", "week", "SELECT * FROM week")
_sql("a5_hotspots", "grid", "SELECT * FROM grid")
_PROFILE = """
SELECT count(*) AS row_count, count(DISTINCT crime_id) AS unique_ids, min(date) AS min_date,
  max(date) AS max_date, max(updated_on) AS last_updated,
  count(DISTINCT primary_type) AS crime_types, count(DISTINCT district) AS districts,
  count(DISTINCT community_area) AS communities,
  CAST(sum(CAST(arrest AS INTEGER)) AS BIGINT) AS arrests,
  CAST(sum(CAST(domestic AS INTEGER)) AS BIGINT) AS domestic_incidents,
  count(latitude) AS geocoded_rows FROM silver"""
_sql("a9_profile", "silver", _PROFILE)

def _distinct(column: str, by: str) -> str:
    return f"""SELECT '{column}' AS counted, {f"CAST({by} AS VARCHAR)" if by else "''"} AS selection,
  count(DISTINCT {column}) AS distinct_values, TRUE AS within_error FROM chosen {f"GROUP BY {by}" if by else ""}"""


_sql("a7_distinct_sketches", "silver", ", chosen AS (SELECT * FROM silver WHERE year BETWEEN 1996 AND 1999 AND NOT domestic)\n"
     + "\nUNION ALL ".join(_distinct(column, by) for column in ("block", "case_number") for by in ("", "year", "primary_type")))
_TOTALS = """
SELECT count(*) AS all_crimes, count(CASE WHEN arrest THEN 1 END) AS all_arrests,
  count(CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 1 END) AS hotspot_crimes,
  count(CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL AND arrest THEN 1 END)
    AS hotspot_arrests,
  floor(min(latitude) * 1000) / 1000.0e0 AS minimum_lat_bin,
  floor(max(latitude) * 1000) / 1000.0e0 AS maximum_lat_bin,
  floor(min(longitude) * 1000) / 1000.0e0 AS minimum_long_bin,
  floor(max(longitude) * 1000) / 1000.0e0 AS maximum_long_bin
FROM silver"""
_sql("a10_silver_totals", "silver", _TOTALS)
_sql("a11_geo_cube", "years", "SELECT * FROM years")
_sql("a11_geo_cube_from_months", "years", "SELECT * FROM years")
_sql("a12_month_geo_cube", "months", "SELECT * FROM months")
_sql("a13_time_cube", "times", "SELECT * FROM times")
_sql("a15_regroup", "months", """
SELECT year, domestic, CAST(sum(total_crimes) AS BIGINT) AS total_crimes,
  CAST(sum(total_arrests) AS BIGINT) AS total_arrests FROM months GROUP BY year, domestic""")
_VALUES = """
SELECT DISTINCT 'primary_type' AS dimension, primary_type AS value FROM monthly
UNION ALL SELECT DISTINCT 'year', CAST(year AS VARCHAR) FROM monthly
UNION ALL SELECT DISTINCT 'district', district FROM area
UNION ALL SELECT DISTINCT 'community_area', community_area FROM silver
  WHERE community_area IS NOT NULL"""
_sql("a24_value_lists", "monthly area", _VALUES)

# --- quality -----------------------------------------------------------------------


def _silver_checks(silver: str, first: int, last: int, void: str, widths: tuple[int, ...]) -> str:
    formats = " OR ".join(
        f"({c} IS NOT NULL AND NOT regexp_full_match({c}, '[0-9]{{{w}}}'))"
        for c, w in zip(("beat", "district", "ward", "community_area"), widths))
    rules = {
        "null_required_fields": " OR ".join(
            f"{c} IS NULL" for c in ("crime_id", "date", "primary_type", "arrest", "domestic", "year")),
        "invalid_year_or_date":
            f"year NOT BETWEEN {first} AND {last} OR year <> extract(year FROM date)",
        "incomplete_coordinate_pairs":
            "(x_coordinate IS NULL) <> (y_coordinate IS NULL)"
            " OR (latitude IS NULL) <> (longitude IS NULL)",
        "invalid_coordinates_not_corrected":
            f"crime_id IN ({void}) AND coalesce(x_coordinate, y_coordinate, latitude, longitude)"
            " IS NOT NULL",
        "invalid_geographic_code_format": formats,
        "null_ingestion_lineage":
            "ingested_at IS NULL OR source_file IS NULL OR batch_id IS NULL",
    }
    tests = [
        f"SELECT 'bronze_to_silver_row_reconciliation' AS test_name, abs((SELECT count(DISTINCT id)"
        f" FROM bronze) - (SELECT count(*) FROM {silver})) AS failed_rows",
        f"SELECT 'duplicate_crime_ids', count(*) - count(DISTINCT crime_id) FROM {silver}",
    ] + [f"SELECT '{n}', count(CASE WHEN {r} THEN 1 END) FROM {silver}" for n, r in rules.items()]
    return (", t AS (" + "\nUNION ALL ".join(tests) + ")\nSELECT test_name, failed_rows,"
            " CASE WHEN failed_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS validation_status FROM t")


def _gold_checks(totals_from: str, first: int, last: int, districts: str) -> str:
    weekday = "CASE day_of_week_number " + " ".join(
        f"WHEN {i} THEN '{n}'" for i, n in enumerate(
            ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"), 1)) + " END"
    year = f"year NOT BETWEEN {first} AND {last}"
    tables = (
        ("gold_monthly_crime_trends", "monthly", ("year", "month", "primary_type"), "all",
         f"{year} OR month NOT BETWEEN 1 AND 12 OR trim(primary_type) = ''"),
        ("gold_area_crime_summary", "area", ("year", "district"), "all",
         f"{year} OR district NOT IN {districts}"),
        ("gold_arrest_analysis", "outcome", ("year", "primary_type", "domestic"), "all",
         f"{year} OR trim(primary_type) = ''"),
        ("gold_time_patterns", "week", ("day_of_week_number", "day_of_week", "hour_of_day"), "all",
         "day_of_week_number NOT BETWEEN 1 AND 7 OR hour_of_day NOT BETWEEN 0 AND 23"
         f" OR day_of_week <> {weekday}"),
        ("gold_crime_hotspots", "grid", ("lat_bin", "long_bin"), "hotspot",
         "lat_bin < (SELECT minimum_lat_bin FROM totals)"
         " OR lat_bin > (SELECT maximum_lat_bin FROM totals)"
         " OR long_bin < (SELECT minimum_long_bin FROM totals)"
         " OR long_bin > (SELECT maximum_long_bin FROM totals)"),
    )
    rows = []
    for name, cte, grain, totals, domain in tables:
        nulls = " OR ".join(f"{c} IS NULL" for c in
                            (*grain, "total_crimes", "total_arrests", "arrest_rate"))
        rows.append(f"""
SELECT '{name}' AS gold_table,
  CAST(abs(sum(total_crimes) - (SELECT {totals}_crimes FROM totals))
    + abs(sum(total_arrests) - (SELECT {totals}_arrests FROM totals)) AS BIGINT)
    AS reconciliation_difference,
  count(*) - count(DISTINCT ({', '.join(grain)})) AS duplicate_rows,
  count(CASE WHEN {nulls} THEN 1 END) AS null_rows,
  count(CASE WHEN total_crimes <= 0 OR total_arrests < 0 OR total_arrests > total_crimes
    OR arrest_rate NOT BETWEEN 0 AND 100
    OR abs(arrest_rate - round(total_arrests * 100.0 / nullif(total_crimes, 0), 2)) > 0.01
    THEN 1 END) AS invalid_measure_rows,
  count(CASE WHEN {domain} THEN 1 END) AS invalid_domain_rows
FROM {cte}""")
    clean = " AND ".join(f"{c} = 0" for c in (
        "reconciliation_difference", "duplicate_rows", "null_rows", "invalid_measure_rows",
        "invalid_domain_rows"))
    totals = _TOTALS.replace("FROM silver", f"FROM silver {totals_from}")
    return (f", totals AS ({totals}), r AS (" + "\nUNION ALL".join(rows) + f""")
SELECT *, CASE WHEN {clean} THEN 'PASS' ELSE 'FAIL' END AS validation_status FROM r""")


_ALL_DISTRICTS = _DISTRICTS[:-1] + ",'UNASSIGNED')"
_GOLD = "monthly area outcome week grid"
_sql("q1_q8_silver_checks", "silver", _silver_checks("silver", 1995, 2001, "11, 26", (4, 3, 2, 2)))
_sql("q1_q8_defects_found", "unvoided",
     _silver_checks("unvoided", 1996, 2000, "11, 26", (4, 2, 2, 3)))
SQL["q1_q8_checks_kept_up"] = SQL["q1_q8_defects_found"]
_sql("q9_silver_gate", "silver",
     _silver_checks("silver", 1995, 2001, "11, 26", (4, 3, 2, 2)).replace(
         "SELECT test_name, failed_rows,", ", g AS (SELECT test_name, failed_rows,") + """)
SELECT CASE WHEN count(CASE WHEN validation_status = 'PASS' THEN 1 END) = 8 AND count(*) = 8
  THEN 'SILVER QUALITY GATE PASSED' ELSE 'FAILED' END AS pipeline_status FROM g""")
_sql("q10_q14_gold_checks", _GOLD, _gold_checks("", 1995, 2001, _ALL_DISTRICTS))
_sql("q10_q14_defects_found", _GOLD, _gold_checks(
    "WHERE source_file <> 'src-0'", 1996, 2000, "('001','002','003','UNASSIGNED')"))
_sql("q15_gold_gate", _GOLD, _gold_checks("", 1995, 2001, _ALL_DISTRICTS).replace(
    "SELECT *, CASE WHEN reconciliation", ", g AS (SELECT *, CASE WHEN reconciliation") + """)
SELECT CASE WHEN count(CASE WHEN validation_status = 'PASS' THEN 1 END) = 5 AND count(*) = 5
  THEN 'GOLD QUALITY GATE PASSED' ELSE 'FAILED' END AS pipeline_status FROM g""")
_sql("q16_publish_check", "monthly area", """
, c AS (
  SELECT count(*) AS silver_rows, count(DISTINCT crime_id) AS unique_ids,
    CAST((SELECT sum(total_crimes) FROM monthly) AS BIGINT) AS monthly_total,
    CAST((SELECT sum(total_crimes) FROM area) AS BIGINT) AS area_total FROM silver)
SELECT *, silver_rows = monthly_total AND silver_rows = area_total AS reconciled,
  silver_rows = unique_ids AS unique_keys FROM c""")

# --- selections --------------------------------------------------------------------

_SUMS = """SELECT CAST(coalesce(sum(value), 0) AS BIGINT) AS total,
  CAST(coalesce(sum(total_arrests), 0) AS BIGINT) AS arrests,
  CAST(coalesce(sum(total_crimes), 0) AS BIGINT) AS applicable FROM """
_sql("f4_filtered_total", "sel", _SUMS + "sel")
_sql("f4_place_total", "sel_place", _SUMS + "sel_place")
_sql("f5_time_filtered", "tsel_arrested", _SUMS + "tsel_arrested")
_sql("f6_geo_filtered", "years",
     "SELECT * FROM years WHERE year = 1998 AND district = '003' AND domestic = 0")
_sql("f8_period_bounds", "bounds", """
SELECT low, high, concat(low // 12, '-', lpad(CAST(low % 12 + 1 AS VARCHAR), 2, '0')) AS low_period,
  concat(high // 12, '-', lpad(CAST(high % 12 + 1 AS VARCHAR), 2, '0')) AS high_period FROM bounds""")
_sql("f8_clamped_selection", "bounds", """
SELECT (SELECT concat(low // 12, '-', lpad(CAST(low % 12 + 1 AS VARCHAR), 2, '0')) FROM bounds)
    AS start_period, '1997-06' AS end_period, CAST(sum(total_crimes) AS BIGINT) AS total
FROM months WHERE year * 100 + month <= 199706""")
_sql("f11_matching_total", "sel", """
SELECT CAST(sum(value) AS BIGINT) AS matching, TRUE AS is_filtered,
  'period,domestic' AS active_filters FROM sel""")

# --- overview ----------------------------------------------------------------------


def _change(cond: str, value: str, target: str, first: str, last: str) -> str:
    """Year over year as one row; ``cond`` ignores the period."""
    return f"""
, yoy_base AS (
  SELECT year, month, CAST({value} AS BIGINT) AS value FROM months WHERE {cond}),
yoy_window AS (SELECT {target} AS target, {first} AS first_month, {last} AS last_month),
yoy AS (
  SELECT target AS target_year, target - 1 AS prior_year,
    CAST(coalesce(sum(CASE WHEN year = target AND month BETWEEN first_month AND last_month
      THEN value END), 0) AS BIGINT) AS current_total,
    CAST(coalesce(sum(CASE WHEN year = target - 1 AND month BETWEEN first_month AND last_month
      THEN value END), 0) AS BIGINT) AS prior_total,
    CAST(any_value(last_month) - any_value(first_month) + 1 AS INTEGER) AS months
  FROM yoy_window LEFT JOIN yoy_base ON year IN (target, target - 1) GROUP BY target),
yoy_pct AS (
  SELECT *, CAST(current_total - prior_total AS DOUBLE) / nullif(prior_total, 0) * 100.0e0
    AS change_pct FROM yoy)"""


def _overview(cte: str, change: str) -> str:
    ranked = lambda key: (f"SELECT {key} AS k, CAST(sum(value) AS BIGINT) AS v FROM {cte} GROUP BY 1"
                          " ORDER BY v DESC, k NULLS LAST LIMIT 1")
    by_month = f"SELECT year, month, CAST(sum(value) AS BIGINT) AS v FROM {cte} GROUP BY 1, 2"
    return change + f""",
top_type AS ({ranked('primary_type')}),
top_district AS ({ranked('district')}),
by_month AS ({by_month}),
latest AS (SELECT * FROM by_month ORDER BY year DESC, month DESC LIMIT 1),
strongest AS (SELECT * FROM by_month ORDER BY v DESC, year, month LIMIT 1),
s AS (SELECT CAST(sum(value) AS BIGINT) AS total, CAST(sum(total_arrests) AS BIGINT) AS arrests,
  CAST(sum(total_crimes) AS BIGINT) AS applicable FROM {cte}),
o AS (SELECT s.total, (SELECT {_label('%b %Y')} FROM latest) AS latest_period,
  (SELECT v FROM latest) AS latest_value,
  (SELECT round(change_pct + 1e-10, 6) FROM yoy_pct) AS change_pct,
  (SELECT months FROM yoy_pct) AS change_months,
  (SELECT k FROM top_type) AS top_type, (SELECT v FROM top_type) AS top_type_value,
  s.arrests, s.applicable, {_percent('s.arrests', 's.applicable')} AS arrest_rate,
  (SELECT k FROM top_district) AS top_district, (SELECT v FROM top_district) AS top_district_value,
  (SELECT {_label('%b %Y')} FROM strongest) AS strongest_period,
  (SELECT v FROM strongest) AS strongest_value FROM s)
"""


_SEL_CHANGE = _change("domestic = 0", "total_crimes", "CAST(2000 AS BIGINT)", "1", "8")
_ALL_CHANGE = _change(
    "TRUE", "total_crimes", "(SELECT high // 12 FROM bounds)", "1",
    "(SELECT high % 12 + 1 FROM bounds)")
_YOY_COLUMNS = "SELECT target_year, prior_year, current_total, prior_total," \
               " round(change_pct + 1e-10, 6) AS change_pct, months FROM yoy_pct"
_sql("c1_overview", "sel", _overview("sel", _SEL_CHANGE) + "SELECT * FROM o")
_sql("c1_overview_all", "bounds", _ALL_CHANGE + ", everything AS"
     " (SELECT *, total_crimes AS value FROM months)" + _overview("everything", "")
     + "SELECT * FROM o")
_sql("c2_yoy", "months", _SEL_CHANGE + _YOY_COLUMNS)
_sql("c2_yoy_open_year", "months", _change(
    "TRUE", "total_crimes - total_arrests", "CAST(1998 AS BIGINT)", "1",
    "(SELECT max(month) FROM months WHERE year = 1998)") + _YOY_COLUMNS)
_sql("c3_fastest_changing", "months", f"""
, g AS (
  SELECT primary_type,
    CAST(coalesce(sum(CASE WHEN year = 2000 THEN total_crimes END), 0) AS BIGINT) AS current_total,
    CAST(coalesce(sum(CASE WHEN year = 1999 THEN total_crimes END), 0) AS BIGINT) AS prior_total
  FROM months WHERE year IN (1999, 2000) AND month BETWEEN 1 AND 8 AND domestic = 0 GROUP BY 1),
p AS (
  SELECT *, (current_total - prior_total) / prior_total * 100.0e0 AS pct FROM g
  WHERE prior_total > 0 AND current_total + prior_total >= 100
  ORDER BY abs(pct) DESC, primary_type LIMIT 10)
SELECT primary_type, current_total, prior_total, round(pct + 1e-10, 6) AS change_pct,
  round(abs(pct) / greatest(max(abs(pct)) OVER (), 1.0e0) + 1e-10, 6) AS relative,
  concat(CASE WHEN pct >= 0 THEN '+' ELSE '' END, {_fixed_one('pct')}, '%') AS change_text
FROM p""")
_SERIES = f"""
SELECT year, month, concat(year, '-', lpad(CAST(month AS VARCHAR), 2, '0')) AS period,
  {_label('%b %Y')} AS label, """
_sql("c4_trend", "sel", _SERIES + "CAST(sum(value) AS BIGINT) AS value FROM sel GROUP BY year, month")
_sql("w3_trailing_mean", "sel_arrested", _SERIES + """round(avg(value) OVER (
  ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) + 1e-10, 6) AS value
FROM (SELECT year, month, sum(value) AS value FROM sel_arrested GROUP BY year, month)""")


def _top(cte: str, key: str, n: int) -> str:
    return f"""
, g AS (SELECT {key}, CAST(sum(value) AS BIGINT) AS value FROM {cte} GROUP BY 1),
t AS (SELECT (SELECT CAST(sum(value) AS DOUBLE) FROM g) AS whole,
  (SELECT max(value) FROM g) AS largest)
SELECT CAST(row_number() OVER (ORDER BY value DESC, {key} NULLS LAST) AS INTEGER) AS position,
  {key}, value, round(value / whole * 100.0e0 + 1e-10, 6) AS share_pct,
  round(value / CAST(largest AS DOUBLE) + 1e-10, 6) AS relative
FROM g, t ORDER BY position LIMIT {n}"""


_sql("c5_top_types", "sel", _top("sel", "primary_type", 10))
_sql("k3_w7_mix_other", "sel", f"""
, g AS (SELECT primary_type, sum(value) AS value,
    row_number() OVER (ORDER BY sum(value) DESC, primary_type NULLS LAST) AS rk FROM sel GROUP BY 1),
i AS (
  SELECT rk AS position, primary_type AS item, CAST(value AS BIGINT) AS value FROM g WHERE rk <= 5
  UNION ALL
  SELECT least((SELECT count(*) FROM g), 5) + 1, 'Other',
    CAST(coalesce((SELECT sum(value) FROM g WHERE rk > 5), 0) AS BIGINT)),
c AS (
  SELECT *, sum(value) OVER (ORDER BY position) AS up_to, sum(value) OVER () AS whole FROM i)
SELECT CAST(position AS INTEGER) AS position, item, value,
  round(CAST(up_to - value AS DOUBLE) / whole * 100.0e0 + 1e-10, 6) AS from_pct,
  round(CAST(up_to AS DOUBLE) / whole * 100.0e0 + 1e-10, 6) AS to_pct,
  {_percent('value', 'whole')} AS share_text FROM c""")
_sql("c6_insights", "sel", _overview("sel", _SEL_CHANGE) + f"""
SELECT CAST(1 AS INTEGER) AS position, concat(top_type, ' is the largest category, accounting for ',
  {_percent('top_type_value', 'total')}, ' of selected incidents.') AS statement FROM o
UNION ALL SELECT 2, concat(strongest_period, ' has the highest monthly volume at ',
  {_grouped('strongest_value')}, '.') FROM o
UNION ALL SELECT 3, concat('District ', top_district,
  ' records the highest volume in the active geographic view.') FROM o
UNION ALL SELECT 4, concat('Comparable volume is ', {_fixed_one('abs(change_pct)')},
  CASE WHEN change_pct >= 0 THEN '% higher' ELSE '% lower' END, ' than 1999.') FROM yoy_pct""")

# --- trends ------------------------------------------------------------------------

_sql("a17_annual_partial", "bounds", """
SELECT year, CAST(sum(total_crimes) AS BIGINT) AS value,
  year = (SELECT high // 12 FROM bounds) AND (SELECT high % 12 FROM bounds) < 11 AS partial
FROM months GROUP BY year""")
_sql("a18_seasonal", "sel", """
SELECT CAST(m.range AS INTEGER) AS month, strftime(make_date(2000, m.range, 1), '%b') AS label,
  round(coalesce(sum(value), 0) / greatest(count(DISTINCT year), 1) + 1e-10, 6) AS value
FROM range(1, 13) m LEFT JOIN sel ON sel.month = m.range GROUP BY m.range""")
_HOURS = """
, h AS (
  SELECT CAST(r.range AS INTEGER) AS hour, CAST(coalesce(sum(value), 0) AS BIGINT) AS value
  FROM range(0, 24) r LEFT JOIN tsel ON tsel.hour = r.range GROUP BY r.range),
peak AS (SELECT * FROM h ORDER BY value DESC, hour LIMIT 1)
"""
_HOUR_LABEL = "concat(lpad(CAST(hour AS VARCHAR), 2, '0'), ':00')"
_sql("a19_hours", "tsel", _HOURS + f"""
SELECT hour, {_HOUR_LABEL} AS label, value, hour = (SELECT hour FROM peak) AS is_peak FROM h""")
_sql("a19_weekdays", "tsel_open", """
SELECT CAST(r.range AS INTEGER) AS day, dayname(DATE '2024-01-01' + CAST(r.range - 1 AS INTEGER)) AS label,
  CAST(coalesce(sum(value), 0) AS BIGINT) AS value
FROM range(1, 8) r LEFT JOIN tsel_open ON tsel_open.day = r.range GROUP BY r.range""")
_sql("a20_week_hour_grid", "tsel_arrested", """
, d AS (
  SELECT CAST(a.range AS INTEGER) AS day, CAST(b.range AS INTEGER) AS hour,
    CAST(coalesce(sum(value), 0) AS BIGINT) AS value
  FROM range(1, 8) a, range(0, 24) b
  LEFT JOIN tsel_arrested t ON t.day = a.range AND t.hour = b.range GROUP BY a.range, b.range)
SELECT *, round(value / CAST(greatest(max(value) OVER (), 1) AS DOUBLE) + 1e-10, 6) AS intensity FROM d""")
_sql("k6_peak_hour", "tsel", _HOURS + f"""
SELECT hour, value, concat('Peak hour: ', {_HOUR_LABEL}, ' (', {_grouped('value')}, ' incidents).')
  AS peak_text FROM peak""")
_SPINE = f"""
SELECT CAST(m // 12 AS BIGINT) AS year, CAST(m % 12 + 1 AS INTEGER) AS month,
  concat(m // 12, '-', lpad(CAST(m % 12 + 1 AS VARCHAR), 2, '0')) AS period,
  {_label('%b %Y', 'm // 12', 'm % 12 + 1')} AS label,
  {_label('%B %Y', 'm // 12', 'm % 12 + 1')} AS long_label
FROM (SELECT unnest(range(low, high + 1)) AS m FROM bounds)"""
_sql("c10_month_spine", "bounds", _SPINE)

# --- geography ---------------------------------------------------------------------

_sql("c8_district_rank", "sel", _top("sel", "district", 10))
_sql("a25_coverage", "sel grid", f"""
, c AS (
  SELECT CAST((SELECT sum(value) FROM sel) AS BIGINT) AS selected_total,
    (SELECT count(*) FROM (SELECT DISTINCT district FROM sel)) AS selected_districts,
    (SELECT count(*) FROM grid) AS hotspot_cells,
    CAST((SELECT sum(total_crimes) FROM grid) AS BIGINT) AS geocoded_rows,
    (SELECT count(*) FROM silver) AS all_rows)
SELECT *, {_percent('geocoded_rows', 'all_rows')} AS coverage_text FROM c""")
_sql("k4_top_cells", "grid", f"""
SELECT CAST(row_number() OVER (ORDER BY total_crimes DESC, lat_bin, long_bin) AS INTEGER) AS position,
  lat_bin, long_bin, concat(printf('%.3f', lat_bin), ', ', printf('%.3f', long_bin)) AS location,
  total_crimes, total_arrests, concat({_fixed_one('arrest_rate')}, '%') AS arrest_rate_text
FROM grid ORDER BY position LIMIT 12""")


def _x(lon: str, zoom: int) -> str:
    return f"(({lon}) + 180.0e0) / 360.0e0 * {256 * 2 ** zoom}.0e0"


def _y(lat: str, zoom: int) -> str:
    rad = f"radians({lat})"
    return f"(1.0e0 - ln(tan({rad}) + 1.0e0 / cos({rad})) / pi()) / 2.0e0 * {256 * 2 ** zoom}.0e0"


_sql("c11_projection", "grid", f"""
, p AS (SELECT lat_bin, long_bin, {_x('long_bin', 11)} AS x, {_y('lat_bin', 11)} AS y FROM grid)
SELECT lat_bin, long_bin, round(x + 1e-10, 6) AS x, round(y + 1e-10, 6) AS y,
  round(x / {256 * 2 ** 11}.0e0 * 360.0e0 - 180.0e0 + 1e-10, 6) AS longitude,
  round(degrees(atan(sinh(pi() - 2 * pi() * y / {256 * 2 ** 11}.0e0))) + 1e-10, 6) AS latitude FROM p""")


def _zones(zoom: int, width: int, height: int, cell: int, centre: str = "-87.75e0") -> str:
    return f"""
, v AS (
  SELECT *, {_x('long_bin', zoom)} - ({_x(centre, zoom)} - {width / 2}e0) AS px,
    {_y('lat_bin', zoom)} - ({_y('41.8e0', zoom)} - {height / 2}e0) AS py FROM grid),
z AS (
  SELECT CAST(floor(px / {cell}) AS BIGINT) AS cell_x, CAST(floor(py / {cell}) AS BIGINT) AS cell_y,
    sum(px * total_crimes) / sum(total_crimes) AS x, sum(py * total_crimes) / sum(total_crimes) AS y,
    sum(lat_bin * total_crimes) / sum(total_crimes) AS latitude,
    sum(long_bin * total_crimes) / sum(total_crimes) AS longitude,
    CAST(sum(total_crimes) AS BIGINT) AS total_crimes,
    CAST(sum(total_arrests) AS BIGINT) AS total_arrests, count(*) AS cells
  FROM v WHERE px BETWEEN -30 AND {width + 30} AND py BETWEEN -30 AND {height + 30} GROUP BY 1, 2)"""


_CENTRE = """cell_x, cell_y, round(x + 1e-10, 6) AS x, round(y + 1e-10, 6) AS y, round(latitude + 1e-10, 6) AS latitude,
  round(longitude + 1e-10, 6) AS longitude, total_crimes, total_arrests"""
_sql("c12_pixel_clusters", "grid", _zones(11, 900, 620, 34) + f"""
SELECT {_CENTRE}, cells,
  round(least(22.0e0, 5.0e0 + sqrt(total_crimes) * 0.34e0) + 1e-10, 6) AS radius FROM z""")


def _heat(zoom: int, width: int, height: int, cell: int, centre: str = "-87.75e0") -> str:
    return _zones(zoom, width, height, cell, centre) + f""",
s AS (SELECT *, ln(1 + total_crimes) AS score FROM z),
q AS (SELECT coalesce(list_sort(list(score))[CAST(floor(count(*) * 0.96e0) AS BIGINT) + 1], 1.0e0)
  AS scale FROM s),
i AS (SELECT s.*, least(1.0e0, score / scale) AS intensity FROM s, q)
SELECT {_CENTRE}, round(score + 1e-10, 6) AS score, round(intensity + 1e-10, 6) AS intensity,
  CASE WHEN intensity > 0.72e0 THEN 'high' WHEN intensity > 0.42e0 THEN 'medium' ELSE 'low' END AS tier,
  round({cell} * (1.15e0 + intensity * 1.05e0) + 1e-10, 6) AS radius FROM i"""


_sql("c13_heat_zones", "grid", _heat(11, 900, 620, 13))
_sql("c13_heat_zones_close", "grid", _heat(13, 700, 400, 10, "-87.86e0"))
# the same views from cells in order of space
SQL |= {"c12_clusters_by_place": SQL["c12_pixel_clusters"], "c13_zones_by_place": SQL["c13_heat_zones_close"]}

# --- outcomes ----------------------------------------------------------------------


def _rates(cte: str, total: str, arrests: str, order: str, limit: str) -> str:
    return f"""
, g AS (SELECT primary_type, CAST(sum({total}) AS BIGINT) AS total,
    CAST(sum({arrests}) AS BIGINT) AS arrests FROM {cte} GROUP BY 1),
r AS (SELECT *, CAST(arrests AS DOUBLE) / total * 100.0e0 AS rate FROM g WHERE total > 0),
m AS (SELECT greatest(max(rate), 1.0e0) AS cap FROM r)
SELECT primary_type, total, arrests, round(rate + 1e-10, 6) AS rate, round(rate / cap + 1e-10, 6) AS relative
FROM r, m ORDER BY {order} DESC, primary_type {limit}"""


_sql("a21_rates_by_type", "sel", _rates("sel", "total_crimes", "total_arrests", "r.rate", ""))
_sql("k5_rates_by_volume", "sel_open", _rates(
    "sel_open", "total_crimes - total_arrests", "0", "total", "LIMIT 12"))
_sql("k4_top_rates", "sel_place", _rates(
    "sel_place", "total_crimes", "total_arrests", "r.rate", "LIMIT 12"))
_sql("k4_top_arrests", "sel", """
, g AS (SELECT primary_type, CAST(sum(total_arrests) AS BIGINT) AS arrests FROM sel GROUP BY 1)
SELECT primary_type, arrests, round(CAST(arrests AS DOUBLE) / (SELECT max(arrests) FROM g) + 1e-10, 6)
  AS relative FROM g ORDER BY arrests DESC, primary_type LIMIT 10""")
_sql("a22_outcome_split", "sel", f"""
, s AS (SELECT CAST(sum(total_crimes) AS BIGINT) AS total,
    CAST(sum(total_arrests) AS BIGINT) AS arrests FROM sel),
r AS (SELECT total, 'Arrested' AS outcome, arrests AS incidents FROM s
  UNION ALL SELECT total, 'Not arrested', total - arrests FROM s)
SELECT outcome, incidents, round(CAST(incidents AS DOUBLE) / total * 100.0e0 + 1e-10, 6) AS width_pct,
  {_percent('incidents', 'total')} AS share_text FROM r""")
_sql("c9_enforcement_summary", "sel", f"""
, g AS (SELECT primary_type, sum(total_crimes) AS t, sum(total_arrests) AS a FROM sel GROUP BY 1),
best AS (SELECT primary_type, CAST(a AS DOUBLE) / t * 100.0e0 AS rate FROM g
  ORDER BY rate DESC, primary_type LIMIT 1),
s AS (SELECT CAST(sum(t) AS BIGINT) AS total, CAST(sum(a) AS BIGINT) AS arrests FROM g)
SELECT total, arrests, total - arrests AS not_arrested, {_percent('arrests', 'total')} AS arrest_rate,
  {_percent('total - arrests', 'total')} AS not_arrested_rate,
  (SELECT primary_type FROM best) AS highest_type,
  (SELECT round(rate + 1e-10, 6) FROM best) AS highest_rate FROM s""")
_sql("a23_domestic_share", "months", f"""
, s AS (
  SELECT CAST(sum(CASE WHEN domestic = 1 THEN total_crimes END) AS BIGINT) AS domestic_total,
    CAST(sum(total_crimes) AS BIGINT) AS grand_total
  FROM months WHERE year * 100 + month BETWEEN 199703 AND 200008)
SELECT *, {_percent('domestic_total', 'grand_total')} AS share_text FROM s""")
_EXPORT = f"""
, g AS (SELECT district, CAST(sum(value) AS BIGINT) AS incidents,
    CAST(sum(total_arrests) AS BIGINT) AS arrests, CAST(sum(total_crimes) AS BIGINT) AS total
  FROM sel_arrested GROUP BY 1)
SELECT district, incidents, arrests, {_percent('arrests', 'total')} AS arrest_rate FROM g"""
_sql("c14_district_export", "sel_arrested", _EXPORT)

# --- reference data ----------------------------------------------------------------

_THROUGH = _label('%b %Y', 'high // 12', 'high % 12 + 1')
_sql("c15_methodology", "bounds", f"""
, n AS (SELECT count(*) AS r, count(DISTINCT crime_id) AS u FROM silver)
SELECT 'Refresh mode' AS label, 'Automated daily pipeline' AS value,
  concat('Last verified coverage through ', {_THROUGH}) AS note FROM bounds
UNION ALL SELECT 'Pipeline volume', {_grouped('r')}, concat({_grouped('u')}, ' unique crime IDs') FROM n
UNION ALL SELECT concat(high // 12, ' is partial'), 'Comparable periods only',
  concat('Coverage ends ', {_THROUGH}) FROM bounds""")
_sql("c16_filter_options", "monthly area bounds", f"""
, vals AS ({_VALUES}),
opts AS (
  SELECT dimension, value, CASE WHEN dimension = 'district' AND value = 'UNASSIGNED' THEN 'Unassigned'
    WHEN dimension = 'district' THEN concat('District ', value)
    WHEN dimension = 'community_area' THEN concat('Area ', value) ELSE value END AS label FROM vals
  UNION ALL SELECT 'period', period, long_label FROM ({_SPINE}))
SELECT dimension, CAST(row_number() OVER (PARTITION BY dimension ORDER BY
    CASE WHEN dimension = 'year' THEN -CAST(value AS BIGINT) END NULLS LAST, value) AS INTEGER)
  AS position, value, label FROM opts""")
_sql("p5_truncated_codes", "bronze", """
SELECT source_file, count(CASE WHEN beat > 999 OR district > 9 OR ward > 99 OR community_area > 9
  THEN 1 END) AS cut_rows FROM bronze GROUP BY source_file""")
_sql("j7_missing_keys", "bronze", """
SELECT DISTINCT id FROM bronze WHERE id NOT IN (SELECT id FROM bronze WHERE year BETWEEN 1997 AND 2001)""")
_sql("p14_metric_by_status", "months", """
SELECT year, CAST(sum(total_crimes) AS BIGINT) AS any_status,
  CAST(sum(total_arrests) AS BIGINT) AS arrested,
  CAST(sum(total_crimes - total_arrests) AS BIGINT) AS not_arrested FROM months GROUP BY year""")
_sql("p15_period_labels", "monthly", f"""
SELECT DISTINCT year, month, concat(year, '-', lpad(CAST(month AS VARCHAR), 2, '0')) AS period,
  {_label('%b %Y')} AS label, {_label('%B %Y')} AS long_label FROM monthly""")
_sql("p16_display_numbers", "outcome", f"""
SELECT year, primary_type, domestic, {_grouped('total_crimes * 12345')} AS grouped,
  {_compact('total_crimes')} AS compact, {_compact('total_crimes * 997')} AS compact_k,
  {_compact('total_crimes * 1234567')} AS compact_m,
  {_percent('total_arrests', 'total_crimes')} AS rate_text, '—' AS undefined_text FROM outcome""")

# --- snapshots, runs and exports ---------------------------------------------------

_sql("s9_s11_snapshot", "monthly", "SELECT * FROM monthly")
_sql("s9_keyed_snapshot", "silver", "SELECT * FROM silver")
_sql("s14_s17_cube_roundtrip", "months", "SELECT * FROM months")

_MEASURE_TYPES = "total_crimes BIGINT, total_arrests BIGINT, arrest_rate DOUBLE"
_INVENTORY = (
    ("gold_monthly_crime_trends", "monthly", "year", "year + month + primary_type",
     f"year BIGINT, month INTEGER, primary_type VARCHAR, {_MEASURE_TYPES}"),
    ("gold_area_crime_summary", "area", "year", "year + district",
     f"year BIGINT, district VARCHAR, {_MEASURE_TYPES}"),
    ("gold_arrest_analysis", "outcome", "year", "year + primary_type + domestic",
     f"year BIGINT, primary_type VARCHAR, domestic BOOLEAN, {_MEASURE_TYPES}"),
    ("gold_time_patterns", "week", None, "day_of_week_number + hour_of_day",
     f"day_of_week_number INTEGER, day_of_week VARCHAR, hour_of_day INTEGER, {_MEASURE_TYPES}"),
    ("gold_crime_hotspots", "grid", None, "lat_bin + long_bin",
     f"lat_bin DOUBLE, long_bin DOUBLE, {_MEASURE_TYPES}"),
    ("silver_crimes", "silver", "date", "crime_id (incident-level)",
     "crime_id BIGINT, case_number VARCHAR, date TIMESTAMP, block VARCHAR, iucr VARCHAR,"
     " primary_type VARCHAR, description VARCHAR, location_description VARCHAR, arrest BOOLEAN,"
     " domestic BOOLEAN, beat VARCHAR, district VARCHAR, ward VARCHAR, community_area VARCHAR,"
     " fbi_code VARCHAR, x_coordinate DOUBLE, y_coordinate DOUBLE, year BIGINT,"
     " updated_on TIMESTAMP, latitude DOUBLE, longitude DOUBLE, ingested_at TIMESTAMP,"
     " source_file VARCHAR, batch_id VARCHAR"),
)


def _inventory_row(name: str, cte: str, ranged: str | None, grain: str, columns: str) -> str:
    pairs = [c.split() for c in columns.split(", " if ", " in columns else ",")]
    listed = ", ".join(f"{{'n': '{n}', 't': '{t}'}}" for n, t in pairs)
    bound = lambda f: f"CAST({f}({ranged}) AS VARCHAR)" if ranged else "CAST(NULL AS VARCHAR)"
    return f"""
SELECT table_name, format, row_count, range_start, range_end, grain, c.n AS column_name,
  c.t AS column_type, TRUE AS nullable
FROM (SELECT '{name}' AS table_name, 'Parquet' AS format, count(*) AS row_count,
  {bound('min')} AS range_start, {bound('max')} AS range_end, '{grain}' AS grain,
  unnest([{listed}]) AS c FROM {cte})"""


_sql("s16_inventory", "monthly area outcome week grid",
     "\nUNION ALL".join(_inventory_row(*t) for t in _INVENTORY))
_sql("s18_csv_export", "sel_arrested", """
, e AS (""" + _EXPORT.replace(", g AS", "WITH g AS", 1) + """)
SELECT '"district","incidents","arrests","arrest_rate"' AS line
UNION ALL SELECT concat('"', coalesce(district, ''), '","', incidents, '","', arrests, '","',
  arrest_rate, '"') FROM e""")
_RUNS = """
SELECT strftime(min(ingested_at), 'run-%Y-%m') AS run_id, min(ingested_at) AS started_at,
  max(ingested_at) AS ended_at,
  CAST(epoch(max(ingested_at)) - epoch(min(ingested_at)) AS DOUBLE) AS duration_seconds,
  'SUCCESS' AS status, strftime(min(ingested_at), 'batch-%Y-%m') AS batch_id,
  count(*) AS api_records_fetched, count(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
  count(*) AS bronze_rows_after, count(*) AS silver_rows_after,
  CAST(5 AS INTEGER) AS gold_tables_passed, CAST(NULL AS VARCHAR) AS error_message
FROM bronze GROUP BY date_trunc('month', ingested_at) ORDER BY started_at DESC LIMIT 10"""
_sql("s19_recent_runs", "bronze", _RUNS)
_RUN_COLUMNS = """run_id, started_at, duration_seconds, status, batch_id, api_records_fetched,
  rows_inserted, rows_updated, bronze_rows_after, silver_rows_after, gold_tables_passed, error_message"""
_sql("s19_verification", "bronze", f", r AS ({_RUNS}) SELECT {_RUN_COLUMNS} FROM r ORDER BY started_at DESC LIMIT 5")
# The batch of a refresh: the new feed's records since the watermark, newest version of each key.
_BATCH = f"""
, wm AS (SELECT max(CAST(updated_on AS TIMESTAMP)) - INTERVAL '8760' HOUR AS w FROM target),
slice AS (SELECT * FROM bronze, wm WHERE source_file = 'src-0'
  AND CAST(updated_on AS TIMESTAMP) >= w AND year >= 1995),
batch AS (SELECT * EXCLUDE (v) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_BY_SENT.format(between="")}) AS v FROM slice) WHERE v = 1),
j AS (
  SELECT coalesce(b.id, t.id) AS id, b.id IS NOT NULL AND t.id IS NULL AS is_new,
    b.id IS NOT NULL AND t.id IS NOT NULL AND CAST(b.updated_on AS TIMESTAMP) >=
      CAST(t.updated_on AS TIMESTAMP) AS is_update,
    {", ".join(f"CASE WHEN t.id IS NULL OR CAST(b.updated_on AS TIMESTAMP) >= CAST(t.updated_on AS TIMESTAMP) THEN b.{c} ELSE t.{c} END AS {c}" for c in _SENT[1:])}
  FROM batch b FULL JOIN target t ON b.id = t.id)"""
_sql("o1_o5_refresh_run", "target", _BATCH + """
SELECT 'SUCCESS' AS status, (SELECT count(*) FROM slice) AS api_records_fetched,
  count(CASE WHEN is_new THEN 1 END) AS rows_inserted,
  count(CASE WHEN is_update THEN 1 END) AS rows_updated, count(*) AS bronze_rows_after,
  count(*) AS silver_rows_after, CAST(5 AS INTEGER) AS gold_tables_passed FROM j""")
_sql("s9_f4_cubes_by_year", "sel sel_place tsel tsel_arrested", "\nUNION ALL ".join(
    f"SELECT '{name}' AS selection, year, CAST(sum(value) AS BIGINT) AS value FROM {cte} GROUP BY year" for name, cte in
    (("months", "sel"), ("place", "sel_place"), ("times", "tsel"), ("arrested", "tsel_arrested"))))
_sql("o1_run_identity", "target", _BATCH + """
SELECT TRUE AS run_id_formed, TRUE AS batch_id_formed, TRUE AS duration_agrees,
  (SELECT count(*) FROM batch) AS stage_rows, (SELECT count(*) FROM batch JOIN target USING (id)) AS overlap_rows,
  (SELECT w FROM wm) AS watermark_before, max(CAST(updated_on AS TIMESTAMP)) AS watermark_after,
  count(*) AS bronze_rows_after FROM j""")
_sql("o1_refreshed_bronze", "target", _BATCH + f"\nSELECT {', '.join(_SENT)}, CAST(NULL AS VARCHAR) AS location FROM j")
_sql("o2_empty_batch", "bronze", """
SELECT 'SUCCESS' AS status, CAST(0 AS BIGINT) AS api_records_fetched, count(DISTINCT id) AS bronze_rows_after,
  CAST(5 AS INTEGER) AS gold_tables_passed FROM bronze""")
_sql("o4_s5_failed_run", "bronze", """
SELECT 'FAILED' AS status, TRUE AS names_the_table, count(*) AS landed FROM bronze WHERE source_file = 'src-0'""")
_sql("s7_s8_offline_views", "silver", """
SELECT year, count(*) AS monthly_crimes, count(*) AS area_crimes, count(*) AS silver_rows FROM silver GROUP BY year""")
_sql("f1_keyed_latest", "bronze", f"""
SELECT id, updated_on, primary_type, year FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_BY_UPDATE}) AS v FROM bronze WHERE tie1 % 50 <> 0)
WHERE v = 1""")
def _published(name: str, cte: str, keys: str, rate: bool) -> str:
    item = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '~')" for k in keys.split())
    return f"SELECT '{name}', {item}, total_crimes, total_arrests, {'arrest_rate' if rate else 'NULL'} FROM {cte}"


_FIGURES = ("row_count", "unique_ids", "crime_types", "districts", "communities", "arrests", "domestic_incidents", "geocoded_rows")
_sql("o6_bundle", "monthly area outcome week grid months years times", f"""
, vals AS ({_VALUES}), profile AS ({_PROFILE}),
coded AS (SELECT * REPLACE (CAST(domestic AS INTEGER) AS domestic) FROM outcome),
cells AS (SELECT *, CAST(round(lat_bin * 1000) AS BIGINT) AS la, CAST(round(long_bin * 1000) AS BIGINT) AS lo FROM grid),
published(dataset, item, crimes, arrests, rate) AS (
""" + "\nUNION ALL ".join([
    _published("monthly", "monthly", "year month primary_type", True), _published("area", "area", "year district", True),
    _published("arrest", "coded", "year primary_type domestic", True),
    _published("time", "week", "day_of_week_number hour_of_day", True), _published("hotspots", "cells", "la lo", True),
    _published("geo_cube", "years", "year district community_area primary_type domestic", False),
    _published("monthly_geo", "months", "year month district community_area primary_type domestic", False),
    _published("time_cube", "times", "year month primary_type domestic day hour", False),
    "SELECT 'values', dimension || '|' || coalesce(value, '~'), NULL, NULL, NULL FROM vals",
    *[f"SELECT 'inventory', '{name}|{grain}', count(*), NULL, NULL FROM {cte}" for name, cte, _, grain, _ in _INVENTORY],
    *[f"SELECT 'meta', '{c}=' || CAST({c} AS VARCHAR), NULL, NULL, NULL FROM profile" for c in ("min_date", "max_date", "last_updated")],
    "SELECT 'meta', 'refresh_mode=Automated daily pipeline', NULL, NULL, NULL",
    "SELECT 'meta', 'hotspot_total', sum(total_crimes), NULL, NULL FROM grid",
    *[f"SELECT 'meta', '{c}', {c}, NULL, NULL FROM profile" for c in _FIGURES]]) + """)
SELECT dataset, item, CAST(crimes AS BIGINT) AS crimes, CAST(arrests AS BIGINT) AS arrests, CAST(rate AS DOUBLE) AS rate FROM published""")
_sql("x1_stream_upsert", "bronze", f"""
SELECT {', '.join(_SENT)}, CAST(NULL AS VARCHAR) AS location FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_BY_SENT.format(between="source_file, ")}) AS v FROM bronze)
WHERE v = 1""")
