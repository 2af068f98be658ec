"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The white space of every contract: space and the controls 9 to 13.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def modest_batches(spark: SparkSession, rows: int = 2000, size: int = 16 << 20) -> None:
    """Lower the session's Arrow batch limits to these: texts are long, and a worker holds a batch in
    several forms at once. Limits that are lower already stay; results do not depend on them."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        name = f"spark.sql.execution.arrow.{name}"
        now = int(spark.conf.get(name).rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(name, str(most))


def with_row(df: DataFrame, name: str = "row") -> DataFrame:
    """Number the rows of ``df``. The numbers hold only within one job, so settle the result
    before it is read twice. Repeated rows and null ids stay apart by them."""
    return df.withColumn(name, F.monotonically_increasing_id())


def columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever their names hold."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_hash(*columns: Column, seed: int = 0) -> Column:
    """60 bits of an MD5, which other SQL engines can compute as well; null counts as empty."""
    parts = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(parts), 1, 15), 16, 10).cast("bigint")


def row_hash(key: Column, text: Column, source: Column, seed: int = 0) -> Column:
    """``id_hash`` of a document's id, text and source: rows of one id spread, unless they are equal in all three."""
    return id_hash(key, F.md5(F.coalesce(text, F.lit(""))), source, seed=seed)


def small_runs(texts: Iterable[str], most_chars: int = 1 << 21, most: int = 512) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs [start, end) of bounded text, so that memory follows one run."""
    start = size = end = 0
    for end, text in enumerate(texts, 1):
        size += len(text)
        if size >= most_chars or end - start >= most:
            yield start, end
            start, size = end, 0
    if end > start:
        yield start, end


def arrow_runs(batch, text: str, most_bytes: int = 1 << 20, most: int = 4096) -> Iterator[tuple]:
    """Slices of an Arrow batch with bounded text, each with its texts (null as empty)."""
    import pyarrow.compute as pc

    column = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = int(ends[start - 1]) if start else 0
        end = min(start + most, max(start + 1, int(np.searchsorted(ends, done + most_bytes, "right"))))
        part = batch.slice(start, end - start)
        yield part, [t or "" for t in column.slice(start, end - start).to_pylist()]
        start = end
