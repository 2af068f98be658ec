"""Newest version per key, and the newer-wins upsert.

Every step works per key with a map-side reduction first, or splits on the side that may
hold a hot key, so a key that holds a large part of all versions never meets one task whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import casts
from ..functions.measures import count_where
from ..spec import LINEAGE_FIELDS

KEY = "id"
# What decides between equally new versions where nothing else is named and rows are pruned: few columns,
# because every one named is read and ranked. Enough where a table has one row per key.
TIES = ("batch_id", "source_file", "case_number")


def _newest_first(df: DataFrame, order: list[Column], tie_breakers: tuple[str, ...]) -> list[Column]:
    ties = tie_breakers or tuple(c for c in TIES if c in df.columns)
    return [c.desc_nulls_last() for c in order] + [F.col(c).desc_nulls_last() for c in ties]


def all_ties(df: DataFrame, key: str, first: tuple[str, ...] = ()) -> tuple[str, ...]:
    """Every column but the key, the ones in ``first`` before the others: a total order of different rows."""
    return first + tuple(c for c in df.columns if c != key and c not in first)


def keep_latest(df: DataFrame, key: str, order: list[Column],
                tie_breakers: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``key``: the first by ``order`` descending, then by the tie-breakers.

    The filter on the row number becomes a group limit that runs before the shuffle, so
    each task sends at most one version per key. Where rows with one key may tie in all of these, the
    winner is undefined: name ``all_ties`` then.
    """
    newest = Window.partitionBy(key).orderBy(*_newest_first(df, order, tie_breakers))
    return (df.withColumn("_version", F.row_number().over(newest))
            .where(F.col("_version") == 1).drop("_version"))


def content_order(columns: list[str], first: tuple[str, ...] = ()) -> tuple[str, ...]:
    """All stored columns but the key, in the order that decides between equally new versions by content: the
    ones in ``first``, what was sent, and how it came in. With it, the newest version of a key is the largest in
    one total order, so merging is commutative, associative and idempotent."""
    first = tuple(c for c in first if c in columns)
    sent = tuple(c for c in columns if c != KEY and c not in first and c not in LINEAGE_FIELDS)
    return first + sent + tuple(c for c in LINEAGE_FIELDS if c in columns and c not in first)


def latest_stage(records: DataFrame, tie_breakers: tuple[str, ...] = (), by_content: tuple[str, ...] = (),
                 unpack: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """A batch ready to merge: keyed rows only, newest version of each key.

    Equally new versions are told apart by the tie-breakers, then by every column, all of which a batch carries
    anyway: the result does not depend on how the batch is cut or in what order it is read. With ``by_content``
    (``content_order``) these columns decide alone, in the same way as in a merge by content. ``unpack`` adds columns
    that follow from those of ``records``, after the ranking, so that they are not shuffled.
    """
    keyed = records.where(F.col(KEY).isNotNull()).withColumn("_updated", casts.to_timestamp(F.col("updated_on")))
    ties = by_content or all_ties(records, KEY, tie_breakers or tuple(c for c in TIES if c in records.columns))
    return unpack(keep_latest(keyed, KEY, [F.col("_updated")], ties).drop("_updated"))


def _time(side: str) -> Column:
    return casts.to_timestamp(F.col(f"{side}.updated_on"))


def _source_wins(by_content: tuple[str, ...] = ()) -> Column:
    """True when the staged version is at least as new; unknown times never win. By content it must be larger by
    time, then by the columns named, where an unknown value (also an unknown time) is the smallest."""
    if by_content:
        rank = lambda side: F.struct(_time(side), *[F.col(f"{side}.{c}") for c in by_content])
        return F.col(f"source.{KEY}").isNotNull() & (rank("source") > rank("target"))
    return F.coalesce(_time("source") >= _time("target"), F.lit(False))


MERGE_MARKS = ("_found", "_replace")


def merge_known(target: DataFrame, stage: DataFrame, by_content: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``target`` with the staged version where that wins, and two marks: whether the key is staged
    at all (``_found``) and whether the staged version was taken (``_replace``)."""
    same_key = F.col(f"target.{KEY}") == F.col(f"source.{KEY}")
    joined = (target.alias("target").join(stage.alias("source"), same_key, "left")
              .withColumn("_found", F.col(f"source.{KEY}").isNotNull()).withColumn("_replace", _source_wins(by_content)))
    return joined.select(*[
        F.when(F.col("_replace"), F.col(f"source.{c}")).otherwise(F.col(f"target.{c}")).alias(c)
        for c in target.columns], *MERGE_MARKS)


def merge_parts(target: DataFrame, stage: DataFrame, by_content: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``target`` after merging ``stage`` (one row per key), as the rows whose keys it had already
    (replaced when the staged version is at least as new) and the rows with new keys.

    With ``by_content`` (``content_order``) equal and unknown times are decided by the rows themselves and not by
    which came first, so that any split of the same rows into batches, in any order, gives one table.

    Not one full outer join: here the target only ever sits on the left of a left join, so a small
    stage is broadcast by its measured size and the target is not shuffled at all, a large one is
    joined by key and a hot target key is split at run time. The new rows are the staged ones whose
    key a left semi join does not find.
    """
    columns = target.columns
    kept = merge_known(target, stage, by_content).drop(*MERGE_MARKS)
    known = target.select(KEY).join(stage.select(KEY), KEY, "left_semi").distinct()
    added = stage.select(*columns).join(known, KEY, "left_anti").select(*columns)
    return kept, added


def upsert_newer(target: DataFrame, stage: DataFrame, by_content: tuple[str, ...] = ()) -> DataFrame:
    """``target`` with ``stage`` merged in: newer or equally old versions replace (by content: larger ones), new
    keys are added."""
    kept, added = merge_parts(target, stage, by_content)
    return kept.unionByName(added)


def change_counts(target: DataFrame, stage: DataFrame) -> DataFrame:
    """One row: rows a merge of ``stage`` (one row per key) would insert, update and find present.

    Only staged keys that are present are joined: an inner join broadcasts a small stage and may
    split either side at a hot key. Staged keys not among them are the new ones.
    """
    found = (target.select(KEY, "updated_on").alias("target")
             .join(stage.select(KEY, "updated_on").alias("source"),
                   F.col(f"target.{KEY}") == F.col(f"source.{KEY}"))
             .groupBy(F.col(f"source.{KEY}").alias(KEY))
             .agg(F.count(F.lit(1)).alias("copies"), count_where(_source_wins()).alias("replaced")))
    staged = stage.agg(F.count(F.lit(1))).scalar()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return found.agg(
        F.count(F.lit(1)).alias("known"), total("replaced").alias("rows_updated"),
        total("copies").alias("overlap_rows"),
    ).select((staged - F.col("known")).alias("rows_inserted"), "rows_updated", "overlap_rows")


def late_rows(counts: DataFrame) -> DataFrame:
    """Add ``rows_kept``: present keys whose stored version stays (older or undated arrivals)."""
    return counts.withColumn("rows_kept", F.col("overlap_rows") - F.col("rows_updated"))


def missing_keys(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Bronze keys without a Silver row: shows which keys a reconciliation difference is about."""
    return (bronze.select(F.col(KEY)).where(F.col(KEY).isNotNull()).distinct()
            .join(silver.select(F.col("crime_id").alias(KEY)), KEY, "left_anti"))
