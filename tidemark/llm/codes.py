"""Product codes of vectors, assigned by a trie over distinct parts.

A vector's components become integers and are cut into consecutive parts; each part position has a
codebook, trained by rounds of nearest-entry assignment and integer means. Distinct parts are sorted, so
they are the leaves of a lexicographic trie in depth-first order. The walk goes through the leaves in
windows: a node (a common beginning) gets its distances to all entries once, as its parent's plus one
squared difference, and all leaves below start from them; where a node has one leaf left, the rest
of its path is one product. Leaves take the nearest entry and add their part, weighted by how often it
occurs, to that entry's sum.

Training reads a table of distinct parts with their numbers, cut by ranges so that neighbours in the
trie stay together; a task returns one sum per entry. Only codebooks come to the driver. The final
codes need no shuffle: each batch of vectors sorts its own parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import settle
from .common import modest_batches

MOST = (1 << 63) - 1
EXACT = 1 << 52  # sums of integers below this are exact in double precision


@dataclass(frozen=True)
class CodeConfig:
    """``window`` leaves are walked together and bound a task's memory; it changes no result."""

    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    window: int = 4096
    most_lengths: int = 256


def finite(vector: Column) -> Column:
    """Not null, without null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def bounds(size: int, parts: int) -> list[tuple[int, int]]:
    """Where each part begins and ends; parts differ by one component at most if the size asks for it."""
    at = [i * size // parts for i in range(parts + 1)]
    return list(zip(at, at[1:]))


# --- the walk ----------------------------------------------------------------------


def _numbers(*arrays: np.ndarray, times: int = 1) -> list[np.ndarray]:
    """The arrays as doubles where squared distances, times ``times``, stay exact, else as Python integers."""
    most = max([abs(int(f(a))) for a in arrays if a.size for f in (np.min, np.max)], default=0)
    width = max(a.shape[1] for a in arrays)
    exact = max(4 * most * most * width, most * times) < EXACT
    return [a.astype(float) if exact else a.astype(object) for a in arrays]


def nearest(leaves: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of sorted distinct integer rows; ties to the lower entry."""
    x, c = _numbers(leaves, book)
    m, width = x.shape
    if not width:
        return np.zeros(m, np.int64), np.zeros(m, c.dtype)
    # By leaf: how much of its path it shares with the leaf before, and at what depth it is alone.
    differ = leaves[1:] != leaves[:-1]
    shared = np.concatenate([[-1], np.where(differ.any(1), differ.argmax(1), width)]) if m else np.zeros(0, int)
    alone = np.clip(np.maximum(shared, np.append(shared[1:], -1)) + 1, 1, width)
    distance = np.zeros((m, len(c)), c.dtype)
    rest = np.zeros((width + 1, len(c)), c.dtype)  # squared norms of the entries from each depth on
    rest[:-1] = np.cumsum((c * c).T[::-1], 0)[::-1]
    live, node = np.arange(m), np.zeros(m, int)
    sums = np.zeros((1, len(c)), c.dtype)
    for depth in range(width):
        begins = shared[live] <= depth
        first = live[begins]
        sums = sums[node[begins]] + (x[first, depth][:, None] - c[None, :, depth]) ** 2
        node = np.cumsum(begins) - 1
        ends = alone[live] == depth + 1
        done = live[ends]
        tail = x[done, depth + 1:]
        distance[done] = sums[node[ends]] + (tail * tail).sum(1)[:, None] - 2 * (tail @ c[:, depth + 1:].T) + rest[depth + 1]
        live, node = live[~ends], node[~ends]
        if not len(live):
            break
    entry = distance.argmin(1)
    return entry, distance[np.arange(m), entry]


def _sorted_parts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows in lexicographic order, which of them each row is)."""
    if not rows.shape[1]:
        return rows[:1], np.zeros(len(rows), int)
    order = np.lexsort(rows.T[::-1])
    new = np.ones(len(rows), bool)
    new[1:] = (rows[order[1:]] != rows[order[:-1]]).any(1)
    which = np.zeros(len(rows), int)
    which[order] = np.cumsum(new) - 1
    return rows[order[new]], which


# --- training ----------------------------------------------------------------------

Books = dict[int, list[np.ndarray]]


def integers(vectors: DataFrame, config: CodeConfig, key: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, v: array of integers) of the usable vectors. A component beyond a long counts as the
    nearest long."""
    v = F.col(vector).cast("array<double>")
    scaled = F.transform(v, lambda x: F.floor(x * F.lit(float(config.scale))).cast("bigint"))
    rows = vectors.where(finite(v))
    return rows.select(F.col(key).cast("bigint").alias("vec_id"), F.col(label).alias("label"), scaled.alias("v"))


def _matrix(column) -> np.ndarray:
    """A list column of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _start(rows: DataFrame, config: CodeConfig) -> Books:
    """Parts of the vectors with the smallest ids, by vector length; ``entries`` vectors at most for each length."""
    sizes = [r[0] for r in rows.select(F.size("v")).distinct().limit(config.most_lengths + 1).collect()]
    if len(sizes) > config.most_lengths:
        raise ValueError(f"vectors of more than {config.most_lengths} lengths")
    books: Books = {}
    for size in sorted(sizes):
        own = rows.where(F.size("v") == size).orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(config.entries)
        found = own.collect()
        first = np.array([r["v"] for r in found], np.int64).reshape(len(found), size)
        books[size] = [first[:, a:b] for a, b in bounds(size, config.parts)]
    return books


def distinct_parts(rows: DataFrame, config: CodeConfig) -> DataFrame:
    """(size, part, values, n): each distinct part once, in files cut by ranges and sorted within."""
    size = F.size("v")
    cut = [F.struct(F.lit(i).alias("part"), F.expr(f"slice(v, int(size(v) * {i} div {config.parts}) + 1, "
           f"int(size(v) * {i + 1} div {config.parts} - size(v) * {i} div {config.parts}))").alias("values")) for i in range(config.parts)]
    parts = rows.select(size.alias("size"), F.inline(F.array(*cut)))
    counted = parts.groupBy("size", "part", "values").agg(F.count("*").alias("n"))
    order = ["size", "part", "values"]
    return settle(counted.repartitionByRange(*order).sortWithinPartitions(*order), "code-parts")


def _round(parts: DataFrame, books: Books, config: CodeConfig) -> Books:
    """Every entry becomes the floor of its parts' mean; unused entries stay."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            sizes, which = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero(np.append(True, (sizes[1:] != sizes[:-1]) | (which[1:] != which[:-1])))
            for a, b in zip(edges, [*edges[1:], len(sizes)]):
                for at in range(a, b, config.window):
                    here = batch.slice(at, min(config.window, b - at))
                    size, part = int(sizes[a]), int(which[a])
                    book = books[size][part]
                    leaves, n = _matrix(here.column(2)), here.column(3).to_numpy()
                    entry, _ = nearest(leaves, book)
                    (weighted,) = _numbers(leaves, times=int(n.sum()))
                    sums, counts = held.setdefault((size, part), (np.zeros(book.shape, object), np.zeros(len(book), object)))
                    add, count = np.zeros(book.shape, weighted.dtype), np.zeros(len(book), np.int64)
                    np.add.at(add, entry, weighted * n[:, None].astype(weighted.dtype))
                    np.add.at(count, entry, n)
                    sums += add.astype(object) if add.dtype == object else add.astype(np.int64).astype(object)
                    counts += count.astype(object)
        out = [(s, p, e, i, Decimal(int(v)), int(counts[e]))
               for (s, p), (sums, counts) in held.items() for e in np.flatnonzero(counts) for i, v in enumerate(sums[e])]
        if out:
            types = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["size", "part", "entry", "at", "total", "n"])

    schema = "size int, part int, entry int, at int, total decimal(38,0), n bigint"
    sums = parts.mapInArrow(run, schema).groupBy("size", "part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    after = {size: [b.copy() for b in book] for size, book in books.items()}
    for r in sums.collect():  # one number per component of a codebook
        after[r["size"]][r["part"]][r["entry"], r["at"]] = int(r["total"]) // r["n"]
    return after


def train(rows: DataFrame, config: CodeConfig) -> Books:
    """Codebooks by vector length, one per part position."""
    books = _start(rows, config)
    if books:
        parts = distinct_parts(rows, config)
        for _ in range(config.rounds):
            books = _round(parts, books, config)
    return books


# --- codes -------------------------------------------------------------------------


def books_digest(book: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for b in book for x in b.reshape(-1)).encode()).hexdigest()


def encode(rows: DataFrame, books: Books, config: CodeConfig) -> DataFrame:
    """Rows with their code (two hex digits a part), error and the digest of the codebooks used."""
    digests = {size: books_digest(book) for size, book in books.items()}
    label = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            sizes = pc.list_value_length(batch.column(2)).to_numpy()
            for size in np.unique(sizes):
                mine = batch.filter(pa.array(sizes == size))
                for at in range(0, mine.num_rows, config.window):
                    here = mine.slice(at, config.window)
                    v, codes, error = _matrix(here.column(2)), [], 0
                    for (a, b), book in zip(bounds(int(size), config.parts), books[int(size)]):
                        leaves, which = _sorted_parts(v[:, a:b])
                        entry, far = nearest(leaves, book)
                        codes.append(entry[which])
                        error = error + far[which].astype(object)
                    code = ["".join(f"{e:02x}" for e in row) for row in zip(*codes)]
                    yield pa.RecordBatch.from_arrays(
                        [here.column(0), here.column(1), pa.array(code), pa.array([min(int(e), MOST) for e in error], pa.int64()),
                         pa.array([digests[int(size)]] * here.num_rows)], names=["vec_id", "label", "code", "error", "codebooks_sha256"])

    return rows.mapInArrow(run, f"vec_id bigint, label {label}, code string, error bigint, codebooks_sha256 string")


def compress(vectors: DataFrame, config: CodeConfig = CodeConfig(), key: str = "vec_id", vector: str = "embedding",
             label: str = "label") -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256.

    Vectors that are null or hold a null or non-finite component are dropped; an empty vector has code zeros
    and no error. A null id comes after all others where the first codebook is chosen, equal ids by their
    vector; repeated rows count each. Null labels are one label. Vectors of different lengths have codebooks of
    their own (at most ``most_lengths`` lengths). A length that the parts do not divide has parts that differ by
    one component. Errors beyond a long are the largest long. An empty table has no codes.
    """
    modest_batches(vectors.sparkSession, rows=4096)
    rows = settle(integers(vectors, config, key, vector, label), "code-vectors")
    coded = settle(encode(rows, train(rows, config), config), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("bigint")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_vector_codes(vectors: DataFrame, config: CodeConfig = CodeConfig()) -> DataFrame:
    """The contract's columns for every usable vector."""
    return compress(vectors.select("vec_id", "embedding", "label"), config)


def _oracle(config: CodeConfig = CodeConfig()) -> str:
    """The same by comparing every part with every entry."""
    steps = [f"""
kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, vec_id, label, v FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor({config.scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)),
parts AS (
  SELECT r, p, v[p * (len(v) // {config.parts}) + 1 : (p + 1) * (len(v) // {config.parts})] AS x FROM kept, range({config.parts}) t(p)),
book0 AS (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= {config.entries})"""]
    for i in range(config.rounds + 1):
        steps.append(f"""
near{i} AS MATERIALIZED (
  SELECT r, p, x, min({{'d': d, 'e': e}}) AS best FROM (
    SELECT r, parts.p, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts JOIN book{i} ON parts.p = book{i}.p) GROUP BY r, p, x)""")
        if i < config.rounds:
            steps.append(f"""
sums{i} AS (
  SELECT p, best.e AS e, j, sum(x[j]) AS s, count(*) AS n FROM near{i}, range(1, (SELECT max(len(x)) FROM parts) + 1) t(j) GROUP BY ALL),
means{i} AS (SELECT p, e, list((((s - ((s % n) + n) % n)) // n)::BIGINT ORDER BY j) AS c FROM sums{i} GROUP BY p, e),
book{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{i} b LEFT JOIN means{i} m ON b.p = m.p AND b.e = m.e)""")
    last = config.rounds
    return f"""
WITH {",".join(steps)},
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{last}),
coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{last} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""


ORACLE_SQL = _oracle()
