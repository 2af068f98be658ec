"""Exact copies by content-defined chunk recipes.

A text (white space runs made one space) is cut where a rolling hash of its last 32 bytes has
leading zeros, so equal texts are cut alike. Chunks are deduplicated to verified identifiers: a
digest names a chunk, and the distinct contents under one digest are compared, so that different
contents get different identifiers. Equal ordered identifier lists are equal texts; only those
short lists are grouped and joined. A chunk's bytes move once, and copies within a task not at all.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import settle
from .common import SPACE, columns, modest_batches, small_runs, with_row


@dataclass(frozen=True)
class ChunkConfig:
    """Chunk sizes in bytes: about ``2**bits``, at least ``least`` and at most ``most``. ``digest_bytes``
    may be small: collisions are found and told apart."""

    bits: int = 11
    least: int = 512
    most: int = 16384
    digest_bytes: int = 16


def normalised(text: Column) -> Column:
    """The compared form, as a column: null counts as empty, each run of white space is one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " ")


def _normal_bytes(text: str) -> bytes:
    blanks = bytes(32 if 9 <= i <= 13 else i for i in range(256))
    return re.sub(rb" {2,}", b" ", text.encode("utf-8", "surrogatepass").translate(blanks))


def _gear() -> np.ndarray:
    digests = (hashlib.blake2b(bytes([i]), digest_size=4).digest() for i in range(256))
    return np.frombuffer(b"".join(digests), "<u4").astype(np.uint32)


def cut(data: bytes, config: ChunkConfig, gear: np.ndarray, step: int = 1 << 20) -> list[bytes]:
    """Chunks of ``data`` in order; none for no bytes. The rolling hash goes through in slices."""
    spots = []
    for at in range(0, len(data), step):
        start = max(0, at - 31)
        h = gear[np.frombuffer(data, np.uint8, min(len(data), at + step) - start, start)]
        for k in (1, 2, 4, 8, 16):  # windows of 2, 4, ... 32 bytes
            h[k:] += h[:-k] << np.uint32(k)
        spots.append(np.flatnonzero(h[at - start:] >> np.uint32(32 - config.bits) == 0) + (at + 1))
    out, last = [], 0
    for spot in [*np.concatenate(spots).tolist(), len(data)] if spots else []:
        while spot - last > config.most:
            out.append(data[last:last + config.most])
            last += config.most
        if spot - last >= config.least or spot == len(data) > last:
            out.append(data[last:spot])
            last = spot
    return out


def _chunked(rows: DataFrame, config: ChunkConfig, what: str) -> DataFrame:
    """From (row, doc_id, text): recipes (row, doc_id, text_sha256, h[]), with ``body`` also body[]."""
    gear = _gear()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].fillna("").tolist()
            for a, b in small_runs(texts):
                whole = [_normal_bytes(t) for t in texts[a:b]]
                bodies = [cut(w, config, gear) for w in whole]
                digests = [[hashlib.blake2b(c, digest_size=config.digest_bytes).digest() for c in d] for d in bodies]
                out = pdf.iloc[a:b][["row", "doc_id"]].assign(text_sha256=[hashlib.sha256(w).hexdigest() for w in whole], h=digests)
                yield out.assign(body=bodies) if what == "body" else out

    schema = f"row long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_sha256 string, h array<binary>"
    return rows.mapInPandas(run, schema + ", body array<binary>" * (what == "body"))


def _chunks(rows: DataFrame, config: ChunkConfig) -> DataFrame:
    """(h, body) of all chunks, distinct within each batch."""
    gear = _gear()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].fillna("").tolist()
            for a, b in small_runs(texts):
                found = list({c for t in texts[a:b] for c in cut(_normal_bytes(t), config, gear)})
                yield pd.DataFrame({"h": [hashlib.blake2b(c, digest_size=config.digest_bytes).digest() for c in found], "body": found})

    return rows.select("text").mapInPandas(run, "h binary, body binary")


def recipes(rows: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """(row, doc_id, text_sha256, ids): ids lists the verified chunk identifiers in order."""
    slim = settle(_chunked(rows, config, "h"), "dedup-recipes")
    clashes = settle(_chunks(rows, config).distinct().groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "dedup-clashes")
    none = F.array().cast("array<int>")
    if clashes.isEmpty():  # a digest names one content, so it identifies the chunk
        return slim.withColumn("ids", F.struct("h", none.alias("n")))
    full = settle(_chunked(rows, config, "body"), "dedup-chunks")
    pieces = full.select("row", F.posexplode(F.arrays_zip("h", "body")).alias("at", "c")).select("row", "at", "c.h", "c.body")
    pieces = pieces.join(clashes, "h", "left_semi")
    numbers = pieces.select("h", "body").distinct().withColumn("n", F.row_number().over(W.partitionBy("h").orderBy("body")))
    told = pieces.join(numbers, ["h", "body"]).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("told"))
    return full.drop("body").join(told, "row", "left").withColumn(
        "ids", F.struct("h", F.coalesce(F.col("told.n"), none).alias("n"))).drop("told")


def op5_exact_dedup(docs: DataFrame, config: ChunkConfig = ChunkConfig(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null and empty texts are equal to each other. The smallest id stays, a null id only if there is
    no other; of rows with the same id and text exactly one is kept. An empty table gives no rows.
    """
    modest_batches(docs.sparkSession)
    rows = with_row(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")))
    listed = recipes(rows, config)
    listed = listed.withColumn("me", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    groups = listed.groupBy("ids").agg(F.min("me").alias("first"), F.count("*").alias("group_size")).where("group_size > 1")
    groups = settle(groups.withColumnRenamed("ids", "group_ids"), "dedup-groups")
    found = listed.join(groups, listed["ids"] == groups["group_ids"], "left")
    first = F.coalesce("first", "me")
    return found.select("doc_id", first["doc_id"].alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
                        (first["row"] == F.col("row")).alias("kept"), "text_sha256")


def keep_rows(docs: DataFrame, decided: DataFrame, digest: Column) -> DataFrame:
    """The rows of ``docs`` that ``decided`` (doc_id, digest, kept; a row each) keeps, all columns as they came.

    Rows are told apart by id and digest. Where only some rows of one id and digest are kept, which
    are then equal, as many distinct ones stay.
    """
    per = decided.groupBy("doc_id", "digest").agg(F.sum(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n"))
    per = settle(per.where("kept < n").select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest"), "kept"), "dedup-gone")
    on = docs["doc_id"].eqNullSafe(per["gone_id"]) & (digest == per["gone_digest"])
    stay = docs.join(per, on, "left_anti")
    some = per.where("kept > 0")
    if some.isEmpty():
        return stay
    once = docs.select(F.struct(*columns(docs)).alias("whole"), F.col("doc_id"), digest.alias("digest")).join(
        some, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("digest") == F.col("gone_digest")))
    once = once.groupBy("gone_id", "gone_digest").agg(F.first("whole").alias("whole")).select("whole.*")
    return stay.unionByName(once)


def drop_copies(docs: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """``docs`` without exact copies."""
    decided = op5_exact_dedup(docs, config).select("doc_id", F.unhex("text_sha256").alias("digest"), "kept")
    return keep_rows(docs, decided, F.unhex(F.sha2(normalised(F.col("text")), 256)))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""
