"""Near copies by ProbMinHash, banding and verification.

A text is the multiset of its five-word shingles, weighted by how often each occurs. Every shingle
sends arrivals of a Poisson process whose rate is its weight to random registers; a register keeps
its first arrival's shingle. A shingle stops as soon as its next arrival is later than all registers
of the text. Two registers agree with the probability Jaccard similarity of the texts,
``sum over x of 1 / sum over y of max(a(y)/a(x), b(y)/b(x))``, which is the plain Jaccard similarity
where no shingle repeats.

Texts with the same words are one node. Nodes that share a band meet in a bucket. First each node is
compared with its bucket's leader, and links verified on the whole shingle sets make components. Then,
in buckets that still hold several components, all pairs across components are compared in blocks, and
the promising ones verified where their nodes' shingles meet. So no pair rows are made within a group,
and no link that would join two classes is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import settle
from .common import SPACE, modest_batches, small_runs, with_row
from .components import components
from .exactdup import keep_rows


@dataclass(frozen=True)
class NearConfig:
    """``bands`` of ``band_rows`` registers make candidates: at the threshold of 0.8 a pair is missed
    with probability (1 - 0.8**4)**32 = 5e-8. Pairs whose share of equal registers, out of
    ``registers``, is ``slack`` below the threshold (4.5 standard errors) are not verified. ``block`` and
    ``cluster_shingles`` bound a task's memory and change no result."""

    words: int = 5
    threshold: float = 0.8
    registers: int = 256
    bands: int = 32
    band_rows: int = 4
    slack: float = 0.1125
    block: int = 512
    cluster_shingles: int = 1 << 22


U = np.uint64
SLICE = 1024  # rows of a bucket that are dealt together


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingles(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, shingle hash, count) sorted by index and hash, over whole texts.

    A text of fewer words than ``words`` has one shingle of all of them; one without words has none.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    letter = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate([[0], letter.view(np.int8), [0]])))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none
    # A word's hash is a polynomial in an odd base: prefix sums, shifted back by the base's inverse.
    base, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
    power = np.full(len(data), U(base))
    power[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + U(1)) * np.cumprod(power))])
    power[1:] = U(inverse)
    word = _mix((sums[ends] - sums[starts]) * np.cumprod(power)[starts] + (ends - starts).astype(np.uint64))
    owner = np.searchsorted(begins, starts, "right") - 1
    n = np.bincount(owner, minlength=len(texts))
    factor = [U(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in range(words)]
    last = len(word) - words + 1
    doc, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if last > 0:
        whole = owner[:last] == owner[words - 1:]
        h = sum(word[k:last + k] * factor[k] for k in range(words))[whole]
        doc = owner[:last][whole]
    short = np.flatnonzero((n > 0) & (n < words))
    if len(short):
        first = np.searchsorted(owner, short)
        some = np.array([sum(int(word[f + k]) * int(factor[k]) for k in range(c)) % (1 << 64) for f, c in zip(first, n[short])], np.uint64)
        doc, h = np.concatenate([doc, short]), np.concatenate([h, some ^ n[short].astype(np.uint64)])
    h = _mix(h)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]))
    return doc[new], h[new], np.diff(np.concatenate([new, [len(doc)]]))


def signatures(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """ProbMinHash registers (texts x registers) of shingle hashes; rows without shingles stay 0."""
    first = np.full(texts * registers, np.inf)
    kept = np.zeros(texts * registers, np.uint64)
    x, seed, step = np.zeros(len(h)), h.copy(), 0
    latest = np.full(texts, np.inf)
    while len(doc):
        many = 1 if len(doc) > 512 else 32  # arrivals of a shingle drawn at once
        steps = np.array([(step + k) * 0x9E3779B97F4A7C15 % (1 << 64) for k in range(1, many + 1)], np.uint64)
        step += many
        r = _mix(seed[:, None] + steps)
        x = x[:, None] + np.cumsum(-np.log(((r >> U(11)).astype(np.float64) + 1) * 2.0**-53) / weight[:, None], 1)
        at = doc[:, None] * registers + (_mix(r ^ U(0x5851F42D4C957F2D)) % U(registers)).astype(np.int64)
        soon = x < latest[doc][:, None]  # a later arrival changes nothing, nor does any after it
        who, when, where = np.broadcast_to(seed[:, None], x.shape)[soon], x[soon], at[soon]
        np.minimum.at(first, where, when)
        won = first[where] == when
        kept[where[won]] = who[won]
        latest = first.reshape(texts, registers).max(1)
        x = x[:, -1]
        live = x < latest[doc]
        if not live.all():
            doc, seed, weight, x = doc[live], seed[live], weight[live], x[live]
    return kept.reshape(texts, registers)


def similarity(a: np.ndarray, aw: np.ndarray | None, b: np.ndarray, bw: np.ndarray | None) -> float:
    """Probability Jaccard similarity of two weighted sets given as sorted distinct hashes and weights
    (None: all 1)."""
    if aw is None and bw is None:
        shared = len(np.intersect1d(a, b, assume_unique=True))
        return shared / max(1, len(a) + len(b) - shared)
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    aw, bw = np.ones(len(a), np.int64) if aw is None else aw, np.ones(len(b), np.int64) if bw is None else bw
    x, y = aw[i].astype(float), bw[j].astype(float)
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    # For each shared x, elements of a larger ratio count by a's weights, the others by b's.
    only_a, only_b = aw.sum() - x.sum(), bw.sum() - y.sum()
    lower = np.searchsorted(ratio, ratio, "left")
    above_a = x.sum() - np.concatenate([[0], np.cumsum(x)])[lower]
    below_b = np.concatenate([[0], np.cumsum(y)])[lower]
    return float((1 / ((only_a + above_a) / x + (only_b + below_b) / y)).sum())


def _words(text: str) -> bytes:
    return b" ".join(text.encode("utf-8", "surrogatepass").split())


def _sketch(rows: DataFrame, config: NearConfig) -> DataFrame:
    """(row, doc_id, digest, words, n, bands, low): words is the digest of the word sequence, n the number of
    shingles; bands and low (a byte of each register) are null where there are no words."""
    cut = config.bands * config.band_rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = np.arange(config.bands, dtype=np.uint64)
        for pdf in batches:
            texts = pdf["text"].fillna("").tolist()
            for a, b in small_runs(texts, 1 << 20, 4096):
                plain = [_words(t) for t in texts[a:b]]
                doc, h, weight = shingles(plain, config.words)
                kept = signatures(doc, h, weight, b - a, config.registers)
                bands = np.zeros((b - a, config.bands), np.uint64)
                for k in range(config.band_rows):
                    bands = _mix(bands * U(31) + kept[:, :cut].reshape(b - a, config.bands, config.band_rows)[:, :, k] + number)
                bands, low = bands.view(np.int64), (kept & U(255)).astype(np.uint8)
                yield pdf.iloc[a:b][["row", "doc_id", "digest"]].assign(
                    words=[hashlib.md5(p).digest() for p in plain], n=np.bincount(doc, minlength=b - a),
                    bands=[x if p else None for x, p in zip(bands, plain)],
                    low=[x.tobytes() if p else None for x, p in zip(low, plain)])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"row long, doc_id {kind}, digest binary, words binary, n long, bands array<long>, low binary")


def _promising(pairs: DataFrame, nodes: DataFrame, config: NearConfig) -> DataFrame:
    """The pairs (a, b) whose registers agree often enough to be verified."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x, y = (np.frombuffer(b"".join(pdf[c]), np.uint8).reshape(len(pdf), -1) for c in ("x", "y"))
                yield pdf.loc[(x == y).mean(1) >= config.threshold - config.slack, ["a", "b"]]

    x = nodes.select(F.col("node").alias("a"), F.col("low").alias("x"))
    y = nodes.select(F.col("node").alias("b"), F.col("low").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInPandas(run, "a long, b long")


def _sets(rows: DataFrame, wanted: DataFrame, config: NearConfig) -> DataFrame:
    """(node, h, w) of ``wanted`` (node, words): the shingles of the whole texts, w null where each occurs once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in small_runs(texts, 1 << 20, 4096):
                doc, h, weight = shingles([_words(t) for t in texts[a:b]], config.words)
                ends = np.searchsorted(doc, np.arange(b - a + 1))
                cuts = list(zip(ends, ends[1:]))
                yield pd.DataFrame({"node": pdf["node"].to_numpy()[a:b], "h": [h[i:j].view(np.int64) for i, j in cuts],
                                    "w": [weight[i:j] if (weight[i:j] > 1).any() else None for i, j in cuts]})

    words = F.unhex(F.md5(F.trim(F.regexp_replace("text", f"[{SPACE}]+", " "))))
    wanted = wanted.select("node", F.col("words").alias("wanted_words"))
    # One shuffle of the texts, whatever the size; of equal texts each task sends one.
    texts = rows.where("text is not null").groupBy(words.alias("words")).agg(F.first("text").alias("text"))
    texts = texts.join(wanted.hint("merge"), F.col("words") == F.col("wanted_words")).select("node", "text")
    return settle(texts.mapInPandas(run, "node long, h array<long>, w array<long>"), "near-shingles")


def _verified(pairs: DataFrame, sets: DataFrame, config: NearConfig) -> DataFrame:
    """The pairs that reach the threshold."""
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = [similarity(*p) >= config.threshold for p in zip(pdf["h"], pdf["w"], pdf["h2"], pdf["w2"])]
            yield pdf.loc[np.array(ok, bool), ["a", "b"]]

    x = sets.select(F.col("node").alias("a"), "h", "w")
    y = sets.select(F.col("node").alias("b"), F.col("h").alias("h2"), F.col("w").alias("w2"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "h", "w", "h2", "w2").mapInPandas(check, "a long, b long")


def _unpack(low: pd.Series, bands: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(low), np.uint8).reshape(len(low), -1), np.stack(bands.to_list())


def _close(low: np.ndarray, bands: np.ndarray, comp: np.ndarray, k: int, others: np.ndarray, band: int, share: float) -> np.ndarray:
    """Of ``others`` those in another component than k, with enough equal registers, and no equal band before ``band``,
    so that a pair is looked at in one bucket only."""
    others = others[(comp[others] != comp[k])]
    others = others[(low[others] == low[k]).mean(1) >= share]
    return others[(bands[others] == bands[k]).argmax(1) == band]


def _root(parent: dict, x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = x = parent[parent[x]]
    return x


def _by_bucket(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """``rows`` (bucket, size, node, …) with the facts of their buckets (bucket, size, …). A large bucket is dealt in
    slices by node, so that no task gets it whole; a bucket's facts go once to each slice."""
    slices = F.ceil(F.col("size") / SLICE).cast("int")
    sliced = facts.withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("size")
    return rows.withColumn("slice", F.pmod(F.xxhash64("node"), slices).cast("int")).join(sliced, ["bucket", "slice"]).drop("slice")


def _clusters(members: DataFrame, config: NearConfig) -> DataFrame:
    """Where links across components may be: rows (cluster, band, node, comp, part) of nodes that hang together by
    promising pairs in a block of a bucket.

    What hangs together is cut into parts of at most half of ``cluster_shingles``, or one text; a cluster holds the
    nodes of promising pairs inside a part, or between two (``part`` 0 and 1), so that one task can hold its shingles.
    """
    mine = members.withColumn("blocks", F.ceil(F.col("size") / config.block).cast("int"))
    mine = mine.withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "comp", "low", "bands", "n")
    share = config.threshold - config.slack

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node").reset_index(drop=True)
        low, bands = _unpack(pdf["low"], pdf["bands"])
        node, comp, own, n = (pdf[c].to_numpy() for c in ("node", "comp", "own", "n"))
        band = int((bands[0] == pdf["bucket"].iloc[0]).argmax())
        left, right = (np.flatnonzero(own == pdf[c].iloc[0]) for c in ("i", "j"))
        same, parent, pairs = pdf["i"].iloc[0] == pdf["j"].iloc[0], {}, {}
        for k in left:
            near = _close(low, bands, comp, k, right[right > k] if same else right, band, share)
            pairs[k] = near
            for other in near:
                parent[_root(parent, int(k))] = _root(parent, int(other))
        groups: dict[int, list[int]] = {}
        for k in parent:
            groups.setdefault(_root(parent, k), []).append(k)
        name = f"{pdf['bucket'].iloc[0]}:{pdf['i'].iloc[0]}:{pdf['j'].iloc[0]}"
        out = []
        for root, group in groups.items():
            part = dict(zip(group, (np.cumsum(n[group]) - 1) * 2 // config.cluster_shingles))
            held: dict[tuple, set[int]] = {}
            for k in group:
                for o in pairs.get(k, ()):
                    held.setdefault((min(part[k], part[o]), max(part[k], part[o])), set()).update((k, o))
            out += [(f"{name}:{node[root]}:{p}:{q}", band, node[k], comp[k], int(part[k] != p)) for (p, q), ks in held.items() for k in ks]
        return pd.DataFrame(out, columns=["cluster", "band", "node", "comp", "part"])

    return dealt.groupBy("bucket", "i", "j").applyInPandas(compare, "cluster string, band int, node long, comp long, part int")


def _joined(clusters: DataFrame, nodes: DataFrame, sets: DataFrame, config: NearConfig) -> DataFrame:
    """Verified links (a, b) inside each cluster, as many as join its components."""
    share = config.threshold - config.slack

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node").reset_index(drop=True)
        low, bands = _unpack(pdf["low"], pdf["bands"])
        node, comp, h, w, band = pdf["node"].to_numpy(), pdf["comp"].to_numpy(), pdf["h"], pdf["w"], pdf["band"].iloc[0]
        part = pdf["part"].to_numpy()
        later = lambda k: np.arange(k + 1, len(pdf))
        facing = (lambda k: later(k)[part[k + 1:] != part[k]]) if part.any() else later
        parent: dict[int, int] = {}
        out = []
        for k in range(len(pdf)):
            for o in _close(low, bands, comp, k, facing(k), band, share):
                x, y = _root(parent, int(comp[k])), _root(parent, int(comp[o]))
                if x != y and similarity(h[k], w[k], h[o], w[o]) >= config.threshold:
                    parent[x] = y
                    out.append((node[k], node[o]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    wide = clusters.join(nodes.select("node", "low", "bands"), "node").join(sets, "node")
    return wide.groupBy("cluster").applyInPandas(link, "a long, b long")


def near_classes(docs: DataFrame, config: NearConfig = NearConfig(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept, n_links, digest (MD5 of the text).

    class_id is the smallest id of the class, a null id only if it has no other; that row is kept, and
    of rows with one id exactly one. n_links counts the verified links by which the row's words joined
    different words, not all that exist. Null, empty and blank texts are near nothing: each is alone, unless
    its id and text repeat. Word sequences that are equal are near, whatever their length.
    """
    modest_batches(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = with_row(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.unhex(F.md5(body)).alias("digest")))
    sketch = settle(_sketch(rows, config), "near-sketch")
    nodes = settle(sketch.where("bands is not null").groupBy("words").agg(
        F.min("row").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("low").alias("low")), "near-nodes")
    bands = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = settle(bands.join(buckets, "bucket"), "near-buckets")
    # The leader is the node that meets most others, so that a group of copies has few leaders, and close ones.
    central = shared.groupBy("node").agg(F.sum("size").alias("central"))
    sets = _sets(rows, central.join(nodes, "node").select("node", "words"), config)
    leaders = shared.join(central, "node").groupBy("bucket").agg(
        F.max(F.struct("central", "node"))["node"].alias("leader"), F.first("size").alias("size"))
    stars = _by_bucket(shared, leaders).where("node <> leader").select(
        F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    links = settle(_verified(_promising(stars, nodes, config), sets, config), "near-links")
    comps = components(links)
    # What the leaders did not join: pairs across components of a bucket. Pairs of nodes have been compared.
    rest = shared.where("size > 2").join(comps, "node", "left").select("bucket", "size", "node", F.coalesce("comp", "node").alias("comp"))
    wide = rest.groupBy("bucket").agg((F.min("comp") < F.max("comp")).alias("wide"), F.first("size").alias("size")).where("wide").drop("wide")
    rest = _by_bucket(rest, wide).join(nodes.select("node", "low", "bands", "n"), "node")
    clusters = settle(_clusters(rest, config), "near-clusters")
    more = settle(_joined(clusters, nodes, sets, config), "near-links")
    if not more.isEmpty():
        links = links.unionByName(more).distinct()
        comps = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    named = nodes.select("node", F.col("words").alias("node_words")).join(comps, "node", "left").join(degree, "node", "left")
    named = named.select("node_words", F.coalesce("comp", "node").alias("comp"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))
    placed = sketch.drop("n", "low").join(named, F.when(F.col("bands").isNotNull(), F.col("words")) == F.col("node_words"), "left")
    placed = settle(placed.select("row", "doc_id", "digest", F.col("comp"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links")), "near-rows")
    # Texts without words: a class for each id and text.
    alone = F.when(F.col("comp").isNull(), F.struct("doc_id", "digest"))
    placed = placed.withColumn("alone", alone)
    me = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    classes = placed.groupBy("comp", "alone").agg(F.min(me).alias("first"), F.count("*").alias("class_size"))
    classes = settle(classes.where("class_size > 1").withColumnsRenamed({"comp": "c", "alone": "o"}), "near-classes")
    told = placed.join(classes, placed["comp"].eqNullSafe(classes["c"]) & placed["alone"].eqNullSafe(classes["o"]), "left")
    mine = told.withColumn("first", F.coalesce("first", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")))
    return mine.select("doc_id", F.col("first.doc_id").alias("class_id"), F.coalesce("class_size", F.lit(1).cast("bigint")).alias("class_size"),
                       (F.col("first.row") == F.col("row")).alias("kept"), "n_links", "digest")


def op8_near_dedup(docs: DataFrame, config: NearConfig = NearConfig()) -> DataFrame:
    return near_classes(docs, config).drop("digest")


def drop_near(docs: DataFrame, config: NearConfig = NearConfig()) -> DataFrame:
    """One document of each class, with the columns it came with."""
    return keep_rows(docs, near_classes(docs, config).select("doc_id", "digest", "kept"), F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))))
