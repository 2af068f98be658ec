"""Published tables: run-scoped folders and a small manifest that says which are current.

A run writes its tables under ``runs/<run id>`` and publishes all of them at once by adding one
manifest. Readers resolve tables through the newest manifest, so a run that fails before that
leaves nothing behind that anyone reads. There is one writer at a time; a second one is noticed, and
if two publish the same version, neither counts and readers keep the version before.

Keyed tables are bucketed by their key, and each bucket is a partition with a folder of its own. Ranking
versions, checking keys and merging a batch need no shuffle of the table, only of what joins it. A run writes
only the buckets it touches; the manifest says for every bucket which run's folder is current.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from dataclasses import astuple, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import scratch_path

BUCKET = "_bucket"  # the partition column of keyed tables; their own columns have other names
WRITERS = 8  # open files of a task; one with more buckets, which are small then, sorts the rest of its rows
MANIFEST_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("tables", T.MapType(T.StringType(), T.StructType([
        T.StructField("path", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("runs", T.ArrayType(T.StringType())),
        T.StructField("stamp", T.StringType()),
    ]))),
])


class SnapshotMissing(RuntimeError):
    """A table that must exist has not been published."""


class ConcurrentPublish(RuntimeError):
    """Another writer has published since this run read its input."""


@dataclass(frozen=True)
class TableRef:
    """Where a table is, its schema as JSON (an empty table has no file to read it from) and, of a keyed
    one, its bucketing, the folder that holds each bucket (None: no rows) and what it was derived with."""

    path: str
    schema: str
    key: str | None = None
    buckets: int | None = None
    runs: tuple[str | None, ...] | None = None
    stamp: str | None = None


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    run_id: str = ""
    tables: dict[str, TableRef] = field(default_factory=dict)
    highest: int = field(default=0, compare=False)  # the last version written, valid or not


def run_folder(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/runs/{run_id}"


def write_table(df: DataFrame, root: str, run_id: str, name: str, by: tuple[str, ...] = ()) -> TableRef:
    """Write a table into the run's folder, in folders by the columns in ``by``, whose values must be few."""
    ref = TableRef(f"{run_folder(root, run_id)}/{name}", df.schema.json())
    df.write.partitionBy(*by).parquet(ref.path, compression="zstd")
    return ref


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket Spark puts a key into."""
    return F.pmod(F.hash(F.col(key)), F.lit(buckets))


def touched_buckets(batch: DataFrame, key: str, ref: TableRef) -> list[int]:
    """Buckets of a keyed table that hold a key of ``batch`` or would."""
    return sorted(r[0] for r in batch.select(bucket_of(key, ref.buckets)).distinct().collect())


def write_keyed(parts: list[DataFrame], root: str, run_id: str, name: str, key: str, buckets: int,
                over: TableRef | None = None, touched: list[int] | None = None, stamp: str | None = None) -> TableRef:
    """Write ``parts`` as one table bucketed by ``key``, or as the ``touched`` buckets of ``over``.

    Parts are written one after the other instead of as a union, which would forget how the
    larger one is partitioned. Each part should come partitioned by its key or be small. What is
    read from a keyed table is read bucket by bucket, so that a bucket stays one file per part
    however often the table is rewritten. Files of buckets that are not touched stay as they are.
    """
    path = f"{run_folder(root, run_id)}/{name}"
    schema = parts[0].schema.json()
    table = f"tidemark_{uuid.uuid4().hex}"
    spark = parts[0].sparkSession
    with _whole_buckets(spark, buckets):
        for position, part in enumerate(parts):
            (part.withColumn(BUCKET, bucket_of(key, buckets)).write.format("parquet").mode("append" if position else "error")
             .partitionBy(BUCKET).bucketBy(buckets, key).options(path=path, compression="zstd").saveAsTable(table))
        written = {int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        spark.sql(f"DROP TABLE {table}")  # a name only; the files are outside
    runs = list(over.runs) if over and touched is not None else [None] * buckets
    for bucket in range(buckets) if touched is None else touched:
        runs[bucket] = path if bucket in written else None
    return TableRef(path, schema, key, buckets, tuple(runs), stamp)


@contextmanager
def _whole_buckets(spark: SparkSession, buckets: int):
    """One task per bucket also where no operator asks for that partitioning; what is ranked or joined by key on the
    way is shuffled into buckets at once. A task that holds few buckets writes them side by side: its rows are not
    sorted by bucket first."""
    settings = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false", "spark.sql.shuffle.partitions": str(buckets),
                "spark.sql.maxConcurrentOutputFileWriters": str(WRITERS)}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def by_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Partition for ``write_keyed``: one task, and so one file, per bucket."""
    return df.repartition(buckets, key)


def _name(ref: TableRef) -> str:
    return "tidemark_" + uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([ref.path, ref.runs])).hex


def read_table(spark: SparkSession, ref: TableRef, only: list[int] | None = None) -> DataFrame:
    """A written table; a bucketed one is announced to the catalog with its bucketing and the folder of each
    bucket. With ``only`` a keyed table's other buckets are not read."""
    schema = T.StructType.fromJson(json.loads(ref.schema))
    if ref.key is None:
        return spark.read.schema(schema).parquet(ref.path).select(*schema.names)  # folder columns come last otherwise
    table = _name(ref)
    quoted = lambda path: path.replace("'", "\\'")
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
                  f"CLUSTERED BY (`{ref.key}`) INTO {ref.buckets} BUCKETS LOCATION '{quoted(ref.path)}'")
        places = [f"PARTITION ({BUCKET}={i}) LOCATION '{quoted(path)}/{BUCKET}={i}'" for i, path in enumerate(ref.runs) if path]
        if places:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(places)}")
    found = spark.table(table)
    if only is not None:
        found = found.where(F.col(BUCKET).isin(only))
    return found.drop(BUCKET)


def settle_keyed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``session.settle`` in buckets by key: what joins or groups the table by key does not shuffle it."""
    spark = df.sparkSession
    return read_table(spark, write_keyed([df], scratch_path(spark, name), "run-1", name, key, buckets))


def _manifests(root: str) -> str:
    return f"{root.rstrip('/')}/manifests"


def _all_manifests(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return (spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true")
                .json(_manifests(root)))
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _valid(rows: DataFrame) -> DataFrame:
    """(version, n, manifest) per version; one that two writers wrote (n > 1) is nobody's."""
    return rows.groupBy("version").agg(F.count(F.lit(1)).alias("n"), F.first(F.struct("*")).alias("manifest"))


def current(spark: SparkSession, root: str) -> Manifest:
    """The newest valid manifest; version 0 without tables if nothing was published."""
    rows = _all_manifests(spark, root)
    if rows is None:
        return Manifest()
    valid = F.when(F.col("n") == 1, F.col("version"))
    found = _valid(rows).agg(F.max("version").alias("highest"), F.max_by("manifest", valid).alias("manifest")).first()
    row, highest = found["manifest"], found["highest"] or 0
    if row is None:
        return Manifest(highest=highest)
    tables = {name: TableRef(*t[:4], tuple(t["runs"]) if t["runs"] else None, t["stamp"]) for name, t in row["tables"].items()}
    return Manifest(row["version"], row["run_id"], tables, highest)


def stale_tables(spark: SparkSession, root: str, keep: int) -> DataFrame:
    """Folders (path) that only manifests older than the newest ``keep`` valid ones name: free to be
    deleted by whatever manages the storage, once no reader of an older snapshot is left."""
    rows = _all_manifests(spark, root)
    if rows is None:
        return spark.createDataFrame([], "path string")
    named = _valid(rows).select("version", F.when(F.col("n") == 1, F.col("version")).alias("good"),
                                F.explode(F.flatten(F.transform(
                                    F.map_values("manifest.tables"), lambda t: F.array_compact(F.coalesce(t["runs"], F.array(t["path"])))))).alias("path"))
    kept = (_valid(rows).where("n = 1").orderBy(F.desc("version")).limit(keep)
            .agg(F.min("version")).scalar())
    per = named.groupBy("path").agg(F.max("good").alias("last"))
    return per.where(F.coalesce(F.col("last") < kept, F.lit(True))).select("path")


def forget(spark: SparkSession, ref: TableRef) -> None:
    """Drop the catalog's name of a bucketed table; its files stay."""
    if ref.key is not None:
        spark.sql(f"DROP TABLE IF EXISTS {_name(ref)}")


def promote(spark: SparkSession, root: str, run_id: str, parent: Manifest,
            tables: dict[str, TableRef]) -> Manifest:
    """Publish ``tables`` on top of ``parent``; tables not named keep their parent's version."""
    found = current(spark, root)
    if (found.version, found.run_id) != (parent.version, parent.run_id):
        raise ConcurrentPublish(
            f"version {found.version} was published by {found.run_id} while {run_id} ran")
    new = Manifest(found.highest + 1, run_id, {**parent.tables, **tables}, found.highest + 1)
    row = (new.version, new.run_id, {n: astuple(t) for n, t in new.tables.items()})
    (spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write
     .json(f"{_manifests(root)}/{new.version:012d}", ignoreNullFields=False))
    after = current(spark, root)
    if (after.version, after.run_id) != (new.version, run_id):
        raise ConcurrentPublish(f"another run published version {new.version} together with {run_id}")
    return new


def resolve(manifest: Manifest, name: str) -> TableRef:
    if name not in manifest.tables:
        raise SnapshotMissing(f"{name} does not exist; load the historical table first")
    return manifest.tables[name]


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The published version of a table."""
    return read_table(spark, resolve(current(spark, root), name))


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Short names for SQL."""
    for alias, frame in tables.items():
        frame.createOrReplaceTempView(alias)
