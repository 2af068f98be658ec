"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# The JVM never compiles a method above 8000 bytes, and one projection of all of Bronze or Silver is above; below this
# limit Spark generates it in small methods instead.
HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"

# Results must not depend on the machine's zone; everything else is left to AQE.
SETTINGS = {
    HUGE_METHOD: "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings this package relies on (keys in ``extra`` use ``_`` for ``.``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **{k.replace("_", "."): v for k, v in extra.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: there the driver and
    the executors are one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    Used where several branches of one plan read the same derived table: each branch
    then prunes columns and pushes filters on its own scan instead of recomputing the
    derivation, and a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, **figures: Column) -> tuple[DataFrame, Observation]:
    """``df`` and the figures that its write will have counted on the way.

    To be put last before a write: the tasks that write are counted once each, also when executors are lost,
    which does not hold for tasks before a shuffle.
    """
    seen = Observation(uuid.uuid4().hex)
    return df.observe(seen, *[c.alias(name) for name, c in figures.items()]), seen


def together(jobs: list[Callable]) -> list:
    """Run independent Spark jobs side by side, so that one's last tasks do not idle the cluster.

    Results come in the order of ``jobs``; the first failure is raised after all have ended.
    """
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]
