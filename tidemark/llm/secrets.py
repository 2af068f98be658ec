"""Secrets in texts, found with a trigram inverted index.

Each rule's regular expression gives a Boolean query: some alternative must have all its trigrams.
The index holds, for the trigrams that any rule asks for, the documents whose lower-cased text has
them (one scan). Posting rows meet per document and alternative; where all trigrams met, the
document is a candidate and only there the regular expression runs. A rule with an alternative
that has no trigram runs on every text.
"""

from __future__ import annotations

import re._parser as parser
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import settle


@dataclass(frozen=True)
class Rule:
    """Matches are leftmost and do not overlap; those whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base rules, in their order. A run of 16 hex digits is matched as a whole
# from its start, and so is an access key of 18, so the length stands in the pattern.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
# Added kinds, after the base ones: private key headers and prefixed access tokens.
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("prefixed", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE + ADDED


def trigram_query(pattern: str, most: int = 64) -> list[frozenset[str]]:
    """Alternatives, each a set of trigrams that its matches must have; an empty set asks for a full scan.

    Trigrams are lower case, so the query holds for either case.
    """
    State = tuple[frozenset, str]

    def put(states: set[State], text: str) -> set[State]:
        out = set()
        for grams, tail in states:
            tail += text.lower()
            out.add((grams | {tail[i:i + 3] for i in range(len(tail) - 2)}, tail[-2:]))
        return out

    def cut(states: set[State]) -> set[State]:
        return {(grams, "") for grams, _ in states}

    def follow(items, states: set[State]) -> set[State]:
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                states = put(states, chr(arg))
            elif name == "BRANCH":
                states = set().union(*[follow(branch, states) for branch in arg[1]])
            elif name == "SUBPATTERN":
                states = follow(arg[3], states)
            elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] == 1:
                states = follow(arg[2], states) | (states if arg[0] == 0 else set())
            elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] > 0:
                states = cut(follow(arg[2], states))
            elif name != "AT":
                states = cut(states)
            if len(states) > most:  # too many alternatives: ask for what all of them share
                states = {(frozenset.intersection(*[g for g, _ in states]), "")}
        return states

    found = {grams for grams, _ in follow(parser.parse(pattern), {(frozenset(), "")})}
    return sorted((g for g in found if not any(o < g for o in found)), key=sorted)


def postings(docs: DataFrame, rules: Sequence[Rule], key: str, text: str) -> DataFrame:
    """(trigram, key): which texts have which of the trigrams the rules ask for."""
    wanted = sorted({g for r in rules for alternative in trigram_query(r.pattern) for g in alternative})
    low = docs.select(F.col(key).alias("key"), F.lower(F.col(text)).alias("low"))
    has = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in wanted]))
    return low.select("key", F.explode(has).alias("trigram"))


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(key, rules): bit i is set where rule i's query holds. Rows of one key count together."""
    uses: dict[str, list[tuple[int, int]]] = {}
    full, owner = [], []
    for i, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        if not all(query):
            continue
        for alternative in query:
            for bit, gram in enumerate(sorted(alternative)):
                uses.setdefault(gram, []).append((len(full), 1 << bit))
            full.append((1 << len(alternative)) - 1)
            owner.append(1 << i)
    if not full:
        return index.select("key", F.lit(0).cast("bigint").alias("rules")).limit(0)
    asked = F.create_map(*[x for g, at in uses.items() for x in (F.lit(g), F.array(*[
        F.struct(F.lit(c).alias("alternative"), F.lit(b).cast("bigint").alias("bit")) for c, b in at]))])
    met = index.select("key", F.inline(asked[F.col("trigram")]))
    met = met.groupBy("key", "alternative").agg(F.bit_or("bit").alias("bits"))
    literal = lambda values: F.array(*[F.lit(v).cast("bigint") for v in values])
    at = F.col("alternative") + 1
    return (met.where(F.col("bits") == F.element_at(literal(full), at))
            .groupBy("key").agg(F.bit_or(F.element_at(literal(owner), at)).alias("rules")))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _spans(text: Column, rule: Rule, rank: int, block: int = 256) -> Column:
    """Array of struct(start, rank, end, kind) in code points, from the matches and the text between them.

    Lengths are summed up by blocks, so that a text with very many matches stays cheap.
    """
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    lengths = lambda a: F.transform(a, lambda x: F.length(x).cast("bigint"))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole

    def placed(s: Column) -> Column:
        gaps, own, kept = s["gaps"], s["own"], s["kept"]
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(own)), own, lambda g, m: g + m)
        bases = F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / block).cast("int")),
                            lambda b: _sum(F.slice(steps, F.lit(1), b * block)))

        def span(i: Column) -> Column:
            b = F.floor((i - 1) / block).cast("int")
            start = F.element_at(bases, b + 1) + _sum(F.slice(steps, b * block + 1, i - 1 - b * block)) + F.element_at(gaps, i)
            return F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + F.element_at(own, i)).alias("end"),
                            F.lit(rule.kind).alias("kind"))

        at = F.filter(F.sequence(F.lit(1), F.size(own)), lambda i: F.element_at(kept, i) >= rule.least)
        return F.transform(at, span)

    # One struct holds the lengths, so that a match is not searched again for each use.
    measured = F.transform(F.array(F.struct(lengths(F.split(text, rule.pattern, -1)).alias("gaps"),
                                            lengths(whole).alias("own"), lengths(values).alias("kept"))), placed)
    return F.when(F.regexp_like(text, pattern), F.element_at(measured, 1)).otherwise(none)


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text", out: str = "found") -> DataFrame:
    """Add ``out``: array of struct(start, rank, end, kind) by start, then rule order; ends are exclusive.

    Null and empty texts have none. Rows that share an id, or have none, are scanned when any of
    them is a candidate, so repeated and null ids lose nothing. All rows and columns are kept.
    """
    found = settle(candidates(postings(docs, rules, key, text), rules).withColumnsRenamed(
        {"key": "candidate_key", "rules": "candidate_rules"}), "secret-candidates")
    # The candidates' size is known here, so Spark broadcasts them if small and else joins by shuffle.
    joined = docs.join(found, docs[key].eqNullSafe(found["candidate_key"]), "left")
    body = F.coalesce(F.col(text), F.lit(""))
    parts = []
    for i, rule in enumerate(rules):
        spans = _spans(body, rule, i)
        if all(trigram_query(rule.pattern)):
            bits = F.coalesce("candidate_rules", F.lit(0).cast("bigint"))
            spans = F.when(bits.bitwiseAND(1 << i) != 0, spans).otherwise(
                F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>"))
        parts.append(spans)
    return joined.withColumn(out, F.array_sort(F.concat(*parts))).drop("candidate_key", "candidate_rules")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: counts of the base kinds, the digest of the base spans, all spans as text."""
    found = scan(docs.select("doc_id", "text"), rules).select("doc_id", "found")
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
                        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


def _oracle() -> str:
    """Every pattern on every text, no index."""
    rows = []
    for rank, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        rows.append(f"SELECT row, {rank} AS rank, '{r.kind}' AS kind, {r.least} AS least, string_split_regex(t, '{p}') AS gaps, "
                    f"regexp_extract_all(t, '{p}', 0) AS own, regexp_extract_all(t, '{p}', {r.group}) AS kept FROM d")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS row FROM documents),
m AS ({' UNION ALL '.join(rows)}),
s AS (SELECT row, rank, kind, least, gaps, own, kept, unnest(range(1, len(own) + 1)) AS i FROM m),
p AS (SELECT row, rank, kind, length(own[i]) AS n,
        list_sum(list_transform(gaps[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(own[1:i - 1], lambda x: length(x))), 0) AS start
      FROM s WHERE length(kept[i]) >= least),
l AS (SELECT row, rank, start, kind || ':' || start::BIGINT || ':' || (start + n)::BIGINT AS span FROM p)
SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
       count(*) FILTER (rank = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM d LEFT JOIN l USING (row) GROUP BY row, doc_id
"""


ORACLE_SQL = _oracle()
