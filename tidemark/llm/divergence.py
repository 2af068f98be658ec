"""How far the sources of a language differ in their words, by a frequent-pattern tree of term rows.

Per language the terms in enough documents are kept. A source gives every kept term a smoothed share p; two
sources differ by the sum over all terms of (p - q)^2 / (p + q), rounded down term by term. Most terms are
absent from most sources, so the sum starts from the value that absent terms have, for all terms. Two
corrections follow: one for each term a source has, against a source without it, summed by how many terms
have the same count; and one for each term that both have.

The latter come from a tree. A term's row lists the sources that have it, in order, with its counts; equal
rows are one row with a multiplicity. Sorted rows are the paths of a prefix tree in depth-first order. A node
is a source with a count, its ancestors are the sources before it on the path, and the correction of
a node and an ancestor is worked out once and weighed with all terms that pass through the node. Corrections add
up, so any cut of the rows into tasks gives the same sums; rows are cut by ranges to share most.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import settle
from .common import arrow_runs, modest_batches

UNIT = 1_000_000_000
# Letters are lower-cased A to Z and every byte of a non-ASCII character; anything else parts terms.
_LOWER = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


@dataclass(frozen=True)
class AuditConfig:
    """``flush`` bounds the sums a task holds before it passes them on, ``cells`` the rows by depth that it walks
    together; they change no result."""

    least_documents: int = 10
    top_terms: int = 10
    flush: int = 200_000
    cells: int = 1 << 17


def term_counts(docs: DataFrame, config: AuditConfig, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): how often a term occurs and in how many documents. A group's own row has
    a null term, so that groups without terms are there too."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out() -> pa.RecordBatch:
            columns = []
            for (g, s), counts in held.items():
                terms, size = list(counts), len(counts) + 1
                columns.append((
                    pa.repeat(pa.scalar(g, pa.string()), size), pa.repeat(pa.scalar(s, pa.string()), size),
                    pa.array([*terms, None], pa.binary()).cast(pa.string()), pa.array([*counts.values(), 0], pa.int64()),
                    pa.array([*map(found[g, s].__getitem__, terms), 0], pa.int64())))
            return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*columns)], names=["lang", "source", "term", "n", "docs"])

        held: dict[tuple, Counter] = {}
        found: dict[tuple, Counter] = {}
        for batch in batches:
            for part, texts in arrow_runs(batch, "text"):
                for g, s, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts):
                    terms = body.encode().translate(_LOWER).split(b" ")
                    held.setdefault((g, s), Counter()).update(terms)
                    held[g, s].pop(b"", None)
                    once = found.setdefault((g, s), Counter())
                    once.update(set(terms))
                if sum(map(len, held.values())) > config.flush:
                    yield out()
                    held, found = {}, {}
        if held:
            yield out()

    modest_batches(docs.sparkSession)
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    slim = docs.select(plain(lang).alias("lang"), plain(source).alias("source"), plain(text).alias("text"))
    parts = slim.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a term, in billionths; exact for counts far beyond a corpus."""
    wide = (n + 2).cast("decimal(28,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return (F.lit(1) + F.call_function("div", wide, (total + terms * 2).cast("decimal(28,0)"))).cast("bigint")


def gap(p: Column, q: Column) -> Column:
    """(p - q)^2 / (p + q) rounded down; shares are at most about 10^9, so squares fit a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _gap(p, q):
    return (p - q) * (p - q) // (p + q)


def _window(lengths: np.ndarray, at: np.ndarray, sources: np.ndarray, p: np.ndarray, p0: np.ndarray, many: np.ndarray):
    """Corrections of the part of the tree that sorted rows of one language span: arrays (earlier source, later
    source, value), one entry for each node and ancestor. Row i is ``lengths[i]`` entries from ``at[i]`` on."""
    wide = int(lengths.max())
    inside = np.arange(wide) < lengths[:, None]
    spot = np.where(inside, at[:, None] + np.arange(wide), 0)
    src, p, p0 = np.where(inside, sources[spot], -1), p[spot], p0[spot]
    differ = (src[1:] != src[:-1]) | ((p[1:] != p[:-1]) & inside[1:])
    shared = np.append(-1, np.where(differ.any(1), differ.argmax(1), wide))  # components shared with the row before
    for depth in range(1, wide):
        begins = np.flatnonzero(shared <= depth)
        through = np.add.reduceat(many, begins)  # terms that pass through each node of this depth
        real = inside[begins, depth]
        node, weight = begins[real], through[real, None]
        mine, mine0 = p[node, depth][:, None], p0[node, depth][:, None]
        above, above0 = p[node, :depth], p0[node, :depth]
        value = _gap(mine, above) - _gap(mine, above0) - _gap(mine0, above) + _gap(mine0, above0)
        yield src[node, :depth].reshape(-1), np.repeat(src[node, depth], depth), (weight * value).reshape(-1)


def tree_corrections(rows: DataFrame, config: AuditConfig) -> DataFrame:
    """(lang, source, item, value) with source < item: corrections of terms that both sources have.

    ``rows`` hold lang, path (source, n, p, p0: its share and that of an absent term) and many, sorted in each
    task. The walk takes them in windows; a node that two windows share is worked out in both, each with its terms.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums: dict[tuple, int] = {}

        def add(lang: str, part: pa.RecordBatch) -> None:
            path = part.column(1)
            lengths, flat = path.value_lengths().to_numpy().astype(np.int64), path.flatten()
            names = flat.field(0).dictionary_encode()
            known = names.dictionary.to_pylist()
            p, p0 = flat.field(2).to_numpy(), flat.field(3).to_numpy()
            made = list(_window(lengths, np.cumsum(lengths) - lengths, names.indices.to_numpy().astype(np.int64), p, p0, part.column(2).to_numpy()))
            if made:
                left, right, value = (np.concatenate(c) for c in zip(*made))
                code, which = np.unique(left * len(known) + right, return_inverse=True)
                total = np.zeros(len(code), np.int64)
                np.add.at(total, which, value)
                for c, v in zip(code.tolist(), total.tolist()):
                    key = lang, known[c // len(known)], known[c % len(known)]
                    sums[key] = sums.get(key, 0) + v

        def out() -> pa.RecordBatch:
            made = [(g, a, b, Decimal(v)) for (g, a, b), v in sums.items()]
            types = [pa.string(), pa.string(), pa.string(), pa.decimal128(38, 0)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names=["lang", "source", "item", "value"])

        for batch in batches:
            langs = batch.column(0).to_pylist()
            ends = np.cumsum(batch.column(1).value_lengths().to_numpy())
            at = 0
            while at < batch.num_rows:
                done, end = int(ends[at - 1]) if at else 0, at + 1
                longest = int(ends[at]) - done
                while end < batch.num_rows and langs[end] == langs[at]:
                    longest = max(longest, int(ends[end] - ends[end - 1]))
                    if longest * (end + 1 - at) > config.cells:
                        break
                    end += 1
                add(langs[at], batch.slice(at, end - at))
                at = end
                if len(sums) > config.flush:
                    yield out()
                    sums.clear()
        if sums:
            yield out()

    return rows.mapInArrow(run, "lang string, source string, item string, value decimal(38,0)")


def audit(docs: DataFrame, config: AuditConfig = AuditConfig(), text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank.

    A null text, language or source is an empty one, and empty ones are a language or source like any other.
    Rows with a repeated or null id are documents of their own; ids and other columns take no part. A language
    without kept terms has pairs of value 0 and no terms; a language with one source has no pairs. Ties go to the
    item that comes first in UTF-8. An empty table gives no rows. Pairs are as many as the result has rows: all
    sources of a language against each other; terms of a language are never gathered in one place.
    """
    counts = settle(term_counts(docs, config, text, lang, source), "audit-counts")
    terms = counts.where(F.col("term").isNotNull())
    kept = settle(terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
                  .where(F.col("docs") >= config.least_documents).select("lang", "term", "lang_n"), "audit-kept")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    of_kept = settle(terms.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "audit-terms")
    groups = counts.where(F.col("term").isNull()).select("lang", "source").join(
        of_kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(sizes, "lang", "left")
    none = F.lit(0).cast("bigint")
    filled = groups.select("lang", "source", *[F.coalesce(c, none).alias(c) for c in ("total", "v", "lang_total")])
    # A language without kept terms has no shares.
    groups = settle(filled.withColumn("p0", F.when(F.col("v") > 0, share(none, F.col("total"), F.col("v")))), "audit-groups")

    rated = of_kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
    by_term = rated.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "n", "p", "p0"))).alias("path"))
    rows = by_term.where(F.size("path") > 1).groupBy("lang", "path").agg(F.count("*").alias("many"))
    rows = rows.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path").select("lang", "path", "many")
    both = settle(tree_corrections(rows, config), "audit-tree")
    both = both.unionByName(both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))

    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    wide = lambda c: c.cast("decimal(38,0)").alias("value")
    apart = F.col("source") != F.col("item")
    absent = groups.join(other, "lang").where(apart).select(
        "lang", "source", "item", wide(F.when(F.col("v") > 0, gap(F.col("p0"), F.col("q0")).cast("decimal(20,0)") * F.col("v")).otherwise(F.lit(0))))
    # Terms of a source with one count have one share, so they are corrected together.
    alike = rated.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("many"))
    change = gap(F.col("p"), F.col("q0")) - gap(F.col("p0"), F.col("q0"))
    one = alike.join(other, "lang").where(apart).select("lang", "source", "item", wide(change.cast("decimal(20,0)") * F.col("many")))
    one = one.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    swapped = one.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    pairs = absent.unionByName(one).unionByName(swapped).unionByName(both)
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").cast("bigint").alias("value"))
    ranked = lambda df: df.withColumn("rank", F.row_number().over(
        W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

    q = share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    above = rated.withColumn("q", q).where(F.col("p") > F.col("q"))
    marked = ranked(above.select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value")))
    parts = ranked(pairs).withColumn("part", F.lit("pair")).unionByName(
        marked.where(F.col("rank") <= config.top_terms).withColumn("part", F.lit("term")))
    return parts.select("lang", "source", "part", "item", "value", "rank")


def op11_divergence(docs: DataFrame, config: AuditConfig = AuditConfig()) -> DataFrame:
    """The contract's columns over all documents."""
    return audit(docs, config)


#: The same from every term's share in every source.
ORACLE_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (
  SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
shares AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (coalesce(total, 0) + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v) AS q
  FROM groups JOIN kept USING (lang) JOIN langs USING (lang)
  LEFT JOIN totals USING (lang, source) LEFT JOIN counts USING (lang, source, term)),
gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
