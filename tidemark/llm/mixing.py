"""Mixing sources to target weights with hash thresholds.

A source is taken ``floor(target / size)`` times as a whole; what is left of its target is a budget
for documents whose hash lies below a threshold. The threshold is found without sorting: sum sizes
by source and hash bucket, find the bucket in which the budget ends, and look again only at the rows
of that bucket with the next bits of the hash, until it holds one hash value. A larger budget
always takes all the documents that a smaller one takes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import settle
from .common import SPACE, columns, row_hash, with_row

HASH_BITS = 60


@dataclass(frozen=True)
class MixConfig:
    """Sources in code point order (null last) get ``weights`` in turn; a source is repeated at most
    ``most_repeats`` times. ``level_bits`` is the size of one histogram."""

    weights: Sequence[float] = (5, 2, 1)
    most_repeats: int = 3
    level_bits: int = 12
    seed: int = 0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, config: MixConfig) -> DataFrame:
    """From (source, source_size) also ``target``: shares of the total by weight, none above
    ``most_repeats`` times its size, what is above dealt again by weight.

    That is a water level: sources sorted by where they fill up, a source is full if the level
    that remains for it and all later ones is at least its own. One row per source is windowed.
    """
    weights = F.array(*[F.lit(float(w)) for w in config.weights])
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", F.element_at(weights, (F.row_number().over(by_name) - 1) % len(config.weights) + 1))
    most = ranked.withColumn("most", F.col("source_size") * config.most_repeats)
    order = [(F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    before = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    onward = W.orderBy(*order).rowsBetween(W.currentRow, W.unboundedFollowing)
    total = F.sum("source_size").over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(onward)
    full = F.col("level") * F.col("weight") >= F.col("most")
    leveled = most.withColumn("level", level)
    # The first source that is not full has the level of all after it; theirs, computed so, would be lower.
    shared = F.max(F.when(~full, F.col("level"))).over(
        W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return leveled.select("source", "source_size", F.when(full, F.col("most").cast("double")).otherwise(
        shared * F.col("weight")).alias("target"))


def _boundary(sized: DataFrame, state: DataFrame, shift: int, bits: int) -> DataFrame:
    """One refinement: per source the bucket of the next ``bits`` bits in which the budget ends."""
    bucket = F.shiftright("h", shift)
    parent = F.shiftright("h", shift + bits)
    rows = sized.join(state, sized["source"].eqNullSafe(state["s"]) & (parent == state["prefix"]))
    hist = rows.groupBy("s", "left", bucket.alias("bucket")).agg(
        F.sum("size").alias("n"), F.min("h").alias("low"), F.max("h").alias("high"))
    below = F.sum("n").over(W.partitionBy("s").orderBy("bucket")) - F.col("n")
    return (hist.withColumn("below", below).where("below <= left and left < below + n")
            .select("s", F.col("bucket").alias("prefix"), (F.col("left") - F.col("below")).alias("left"),
                    "n", (F.col("low") == F.col("high")).alias("single")))


def plan_mix(docs: DataFrame, config: MixConfig = MixConfig(), key: str = "doc_id", text: str = "text",
             source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(every row as row, key, size, source, h; every source as s, source_size, target, whole, cut)."""
    sized = docs.select("row", F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                        row_hash(F.col(key), F.col(text), F.col(source), config.seed).alias("h"))
    sized = settle(sized, "mix-sizes")
    aims = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), config)
    aims = aims.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    aims = settle(aims.withColumnRenamed("source", "s"), "mix-targets")
    live = sized.where("size > 0")
    state = aims.select("s", F.lit(0).cast("bigint").alias("prefix"),
                        (F.col("target") - F.col("whole") * F.col("source_size")).alias("left")).where("left > 0")
    found = []
    for done in range(0, HASH_BITS, config.level_bits):
        bits = min(config.level_bits, HASH_BITS - done)
        shift = HASH_BITS - done - bits
        level = settle(_boundary(live, state, shift, bits), "mix-level")
        # A bucket with one hash value ends the search: it is taken if that comes nearer to the budget.
        end = level.where(F.col("single") | F.lit(shift == 0))
        found.append(end.select("s", (F.shiftleft(F.col("prefix") + (F.col("left") * 2 >= F.col("n")).cast("bigint"), shift)).alias("cut")))
        state = level.where(~F.col("single")).select("s", "prefix", "left")
        if shift == 0 or state.isEmpty():
            break
    cuts = found[0]
    for more in found[1:]:
        cuts = cuts.unionByName(more)
    cuts = cuts.withColumnRenamed("s", "cut_s")
    aims = aims.join(cuts, aims["s"].eqNullSafe(cuts["cut_s"]), "left").drop("cut_s")
    return sized, aims.withColumn("cut", F.coalesce("cut", F.lit(0).cast("bigint")))


def op3_mix(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """One row per document: doc_id, size (words), source_size, target, taken (size x copies).

    Null and empty texts have size 0 and are never taken. Null is a source of its own, last in
    order. Rows equal in id, text and source share a hash and are taken alike; rows that only share an id are
    not. Whole documents are taken, so a source misses its target by half the document (or the group of equal
    rows) at its threshold at most.
    """
    sized, aims = plan_mix(with_row(docs.select("doc_id", "text", "source")), config)
    copies = F.col("whole") + (F.col("h") < F.col("cut")).cast("bigint")
    return sized.join(aims, sized["source"].eqNullSafe(aims["s"])).select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def mix(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The mixture itself: rows of ``docs``, each as often as it is taken. Rows without words stay out."""
    _, aims = plan_mix(with_row(docs.select("doc_id", "text", "source")), config)
    picked = docs.select(F.struct(*columns(docs)).alias("d"), F.col("source").alias("src"),
                         row_hash(F.col("doc_id"), F.col("text"), F.col("source"), config.seed).alias("h"), word_count(F.col("text")).alias("size"))
    picked = picked.where("size > 0").join(aims, picked["src"].eqNullSafe(aims["s"]))
    copies = (F.col("whole") + (F.col("h") < F.col("cut")).cast("bigint")).cast("int")
    return picked.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies))).select("d.*")


#: The same mix by sorting: targets as above, documents in hash order with running sums.
ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('0|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) || '|' || coalesce(source, '')), 1, 15))::BIGINT AS h
  FROM documents),
named AS (
  SELECT source, source_size, 3 * source_size AS most,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)),
leveled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM named),
aims AS (
  SELECT source, source_size, CASE WHEN level * weight >= most THEN most::DOUBLE
    ELSE (SELECT max(level) FROM leveled WHERE level * weight < most) * weight END AS target
  FROM leveled),
grouped AS (SELECT source, h, sum(size)::BIGINT AS n FROM sized GROUP BY source, h),
cuts AS (
  SELECT g.source, g.h, g.n, a.source_size, a.target,
         CASE WHEN a.source_size > 0 THEN floor(a.target / a.source_size) ELSE 0 END AS whole,
         sum(g.n) OVER (PARTITION BY g.source ORDER BY g.h) - g.n AS below
  FROM grouped g JOIN aims a ON g.source IS NOT DISTINCT FROM a.source)
SELECT s.doc_id, s.size, c.source_size, c.target,
       (s.size * (c.whole + CASE WHEN c.n > 0 AND c.below + c.n / 2.0 <= c.target - c.whole * c.source_size
                                 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source AND s.h = c.h
"""
