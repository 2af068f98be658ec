"""Shards that each match the mixture, by proportional stratified interleaving.

Rows get a seeded hash; within its source a row's rank in hash order, over the source's rows, is its
fractional rank. All rows in order of fractional rank interleave the sources in proportion; cutting
that order into runs of equal length (at most one row apart) gives the shards.

No order is made in one task. A rank is the rows in earlier buckets (a small histogram) plus the rank
inside the bucket; hashes and fractional ranks are both uniform, so equal buckets hold few rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import settle
from .common import row_hash
from .mixing import HASH_BITS


@dataclass(frozen=True)
class ShardConfig:
    """``bucket_rows`` is about the number of rows ranked together, ``block`` the number of buckets summed together;
    they change no result."""

    shards: int = 40
    seed: int = 0
    bucket_rows: int = 2048
    block: int = 4096


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    on = F.lit(True)
    for c in columns:
        on = on & left[c].eqNullSafe(right[f"o_{c}"])
    return on


def _offsets(counts: DataFrame, by: list[str], bucket: str, block: int) -> DataFrame:
    """Rows in earlier buckets (``before``) and in all (``all_n``), from (by, bucket, n).

    Summed in two levels, ``block`` buckets at a time, so that no task orders all buckets: the one window without
    buckets sees a row per block.
    """
    counts = settle(counts.withColumn("block", F.floor(F.col(bucket) / block)), "shard-counts")
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    blocks = counts.groupBy(*by, "block").agg(F.sum("n").alias("block_n"))
    blocks = (blocks.withColumn("block_before", F.sum("block_n").over(group.orderBy("block")) - F.col("block_n"))
              .withColumn("all_n", F.sum("block_n").over(group)).drop("block_n"))
    blocks = blocks.select(*[F.col(c).alias(f"o_{c}") for c in [*by, "block"]], "block_before", "all_n")
    inside = counts.withColumn("earlier", F.sum("n").over(W.partitionBy(*by, "block").orderBy(bucket)) - F.col("n"))
    joined = inside.join(blocks, _same(inside, blocks, [*by, "block"]))
    return joined.select(*by, bucket, (F.col("block_before") + F.col("earlier")).alias("before"), "all_n")


def _ranked(rows: DataFrame, by: list[str], bucket: str, order: list[Column], name: str, block: int) -> DataFrame:
    """Add ``name`` (rank from 0 within ``by``) and ``all_n`` (rows of ``by``)."""
    offsets = _offsets(rows.groupBy(*by, bucket).agg(F.count("*").alias("n")), by, bucket, block)
    offsets = offsets.select(*[F.col(c).alias(f"o_{c}") for c in [*by, bucket]], "before", "all_n")
    inside = rows.withColumn("inside", F.row_number().over(W.partitionBy(*by, bucket).orderBy(*order)) - 1)
    joined = inside.join(offsets, _same(inside, offsets, [*by, bucket]))
    return joined.withColumn(name, F.col("before") + F.col("inside")).drop("before", "inside", *offsets.columns[:-2])


def assign_shards(docs: DataFrame, config: ShardConfig = ShardConfig(), key: str = "doc_id", text: str = "text",
                  source: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes + 16), text_crc32, source, shard, slot, fraction.

    A null text has no bytes (its CRC-32 is 0, that of no bytes). Null is a source like any other.
    Rows equal in id, text and source share a hash and are interchangeable, so a rerun gives the same result; rows
    that only share an id spread over the buckets. An empty table has no shards.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    slim = settle(docs.select(
        F.col(key).alias("doc_id"), (F.octet_length(body) + 16).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"), F.col(source).alias("source"),
        row_hash(F.col(key), F.col(text), F.col(source), config.seed).alias("h")), "shard-rows")
    total = slim.count()
    buckets = max(1, -(-total // config.bucket_rows))
    ties = [F.col("h"), F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    by_hash = slim.withColumn("bucket", F.floor(F.col("h") / (float(1 << HASH_BITS) / buckets)))
    ranked = _ranked(by_hash, ["source"], "bucket", ties, "source_rank", config.block)
    ranked = ranked.withColumn("fraction", (F.col("source_rank") * 2 + 1) / (F.col("all_n") * 2)).drop("all_n", "bucket")
    ranked = settle(ranked.withColumn("bucket", F.floor(F.col("fraction") * buckets)), "shard-ranks")
    placed = _ranked(ranked, [], "bucket", [F.col("fraction"), F.col("source").asc_nulls_last(), *ties], "at", config.block)
    shard = F.expr(f"at * {config.shards} div all_n")
    first = F.expr(f"(shard * all_n + {config.shards - 1}) div {config.shards}")
    return (placed.withColumn("shard", shard).withColumn("slot", F.col("at") - first)
            .select("doc_id", "size", "text_crc32", "source", F.col("shard").cast("int").alias("shard"), "slot", "fraction"))


def op10_shards(docs: DataFrame, config: ShardConfig = ShardConfig()) -> DataFrame:
    """The contract's columns; counts of any two shards are at most one apart (law ``rows``)."""
    return assign_shards(docs, config).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


#: The same by sorting. CRC-32 is folded over the bytes by its polynomial's table.
ORACLE_SQL = r"""
WITH steps(i, v) AS (
  SELECT i, list_reduce([i::UBIGINT] || list_transform(range(8), lambda x: 0::UBIGINT),
                        lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END)
  FROM range(256) t(i)),
crc AS (SELECT list(v ORDER BY i) AS t FROM steps),
hexed AS (SELECT doc_id, source, text, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
summed AS (
  SELECT doc_id, source, n + 16 AS size,
         ('0x' || substr(md5('0|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) || '|' || coalesce(source, '')), 1, 15))::BIGINT AS h,
         xor(4294967295::UBIGINT, list_reduce([4294967295::UBIGINT] || list_transform(range(n), lambda k: ('0x' || substr(x, 2 * k + 1, 2))::UBIGINT),
             lambda a, b: xor(a >> 8, t[((xor(a, b) & 255) + 1)::BIGINT])))::BIGINT AS text_crc32
  FROM hexed, crc),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, text_crc32, size) * 2 - 1)::DOUBLE
            / (count(*) OVER (PARTITION BY source) * 2) AS fraction FROM summed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source NULLS LAST, h, doc_id NULLS FIRST, text_crc32, size) - 1 AS pos,
         count(*) OVER () AS n FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, (pos * 40 // n)::INT AS shard,
       pos - ((pos * 40 // n) * n + 39) // 40 AS slot, NULL::INT AS grown_shard
FROM placed
"""
