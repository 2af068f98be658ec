"""Compare a Spark result with the same query's SQL result, value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

# Spark type -> SQL types that hold the same values
SAME_TYPE = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"}, "timestamp_ntz": {"TIMESTAMP", "TIMESTAMP_NS"},
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def differences(spark_df, con, sql: str) -> list[str]:
    """Human-readable differences, empty if the results are equal."""
    con.execute(sql)
    described = [(d[0], str(d[1])) for d in con.description]
    expected = _rows([n for n, _ in described], con.fetchall())
    types = {n: t for n, t in described}
    found = []
    if sorted(spark_df.columns) != sorted(types):
        return [f"columns {sorted(spark_df.columns)} != {sorted(types)}"]
    for name, kind in spark_df.dtypes:
        if types[name] not in SAME_TYPE.get(kind, {types[name]}):
            found.append(f"type of {name}: {kind} != {types[name]}")
    actual = _rows(spark_df.columns, spark_df.collect())
    if len(actual) != len(expected):
        found.append(f"rows {len(actual)} != {len(expected)}")
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first: {wrong[0][0]} != {wrong[0][1]}")
    return found
