"""Source divergence, packing and vector codes, against plainer ways."""

import random
import zlib
from collections import Counter, defaultdict

import cases
import compare
import duckdb
import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidemark.llm import codes, divergence, packing

WORDS = "river stone heron bridge Évening plain water Children fish bank slow wide".split()


# --- divergence --------------------------------------------------------------------


def test_divergence_of_many_sources_equals_sql(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i % 90, " ".join(rng.choices(WORDS, [rng.random() ** 3 for _ in WORDS], k=rng.randrange(40))) + "!",
             rng.choice(["en", "", None]), rng.choice(["a", "b", "é", "z", None, ""]), 0) for i in range(400)]
    rows += [(1, "seldom seen", "fr", "only", 0), (2, None, "de", "a", 0), (3, "", "de", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    con = cases.connect(docs, tmp_path / "docs")
    got = divergence.op11_divergence(docs.repartition(7), divergence.AuditConfig(flush=20, cells=40))
    assert compare.differences(got, con, divergence.ORACLE_SQL) == []
    rows = {(r.lang, r.source, r.part, r.item): r.value for r in got.collect()}
    assert rows["de", "a", "pair", "b"] == 0 and not [k for k in rows if k[0] == "fr"]
    assert all(rows[g, i, p, s] == v for (g, s, p, i), v in rows.items() if p == "pair")


def test_tree_corrections_count_each_term(spark):
    """Every row's pairs, one by one."""
    rng = random.Random(2)
    node = lambda s: (s, (n := rng.randrange(1, 4)), n * 100 + ord(s), 50 + ord(s))
    rows = [("x" if rng.random() < 0.7 else "y", tuple(node(s) for s in sorted(rng.sample("abcdef", rng.randrange(2, 6)))), rng.randrange(1, 5))
            for _ in range(200)]
    expected = Counter()
    for lang, path, many in rows:
        for i, (a, _, q, q0) in enumerate(path):
            for b, _, p, p0 in path[i + 1:]:
                gap = divergence._gap
                expected[lang, a, b] += many * (gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0))
    table = spark.createDataFrame(rows, "lang string, path array<struct<source:string,n:long,p:long,p0:long>>, many long")
    for order, cells in (([], 1 << 17), (["lang", "path"], 1 << 17), (["lang", "path"], 30)):  # sorting shares work and changes nothing
        sorted_rows = table.coalesce(1).sortWithinPartitions(*order) if order else table
        got = divergence.tree_corrections(sorted_rows, divergence.AuditConfig(cells=cells)).groupBy("lang", "source", "item").agg(F.sum("value").alias("v"))
        assert {(r.lang, r.source, r.item): int(r.v) for r in got.collect() if r.v} == {k: v for k, v in expected.items() if v}


# --- packing -----------------------------------------------------------------------


def check_packing(rows, docs, capacity=1024):
    """Every id once, pieces in order, sequences without gaps; returns (sequences, ids)."""
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.default_vocabulary())
    own.encode_special_tokens = True
    left = Counter()
    for key, text in docs:
        ids = own.encode(text or "", add_special_tokens=False).ids + [packing.END]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            left[key, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    left.subtract((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert not any(left.values())
    placed = defaultdict(list)
    for r in rows:
        placed[r.sequence_id].append((r.offset, r.length))
    for inside in placed.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
    return len(placed), sum(r.length for r in rows)


def test_packing_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sequences, ids = check_packing(packing.op12_packing(docs).collect(), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sequences <= -(-ids // 1024) * 1.01


def test_packing_of_awkward_documents(spark):
    docs = cases.awkward(spark)
    got = packing.op12_packing(docs).collect()
    check_packing(got, [(r[0], r[1]) for r in cases.rows()])
    assert [(r.length, r.start) for r in got if r.doc_id == 6] == [(1, 0)]
    assert packing.op12_packing(cases.empty(spark)).count() == 0


def test_tokeniser_equals_the_vocabulary_library():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.default_vocabulary())
    own.encode_special_tokens = True
    mine = packing.Tokeniser(packing.default_vocabulary(), packing.load_vocabulary(packing.default_vocabulary()))
    rng = random.Random(4)
    letters = "ab'sTllé   \n\t1२日本🎉ß.,!  ​\u0085<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(3000)]
    texts += ["<|endoftext|>", " " * 5000 + "x", "\n" * 300000, "ab" * 200000, "", " "]
    assert [mine.ids(t).tolist() for t in texts] == [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("lengths", [
    [], [1], [1024] * 5, [512] * 7 + [511] * 3, list(range(1, 1025)), [700] * 50 + [324] * 20 + [100] * 31 + [24] * 9, [1] * 5000,
    [341] * 10 + [342] * 5])
def test_plan_holds_every_piece_once(lengths):
    histogram = Counter(lengths)
    slots = packing.plan(dict(histogram))
    room = defaultdict(list)
    for length, n in histogram.items():
        sequence, offset = packing.places(slots, np.full(n, length), np.arange(n))
        for s, o in zip(sequence, offset):
            room[s].append((o, length))
    for inside in room.values():
        ends = [0, *np.cumsum([length for _, length in sorted(inside)])]
        assert [o for o, _ in sorted(inside)] == ends[:-1] and ends[-1] <= 1024
    assert sorted(room) == list(range(len(room)))
    # No more than sorting pieces from the longest and taking the first room that fits.
    bins = []
    for length in sorted(lengths, reverse=True):
        at = next((i for i, b in enumerate(bins) if b >= length), None)
        if at is None:
            bins.append(1024 - length)
        else:
            bins[at] -= length
    assert len(room) <= len(bins) + 1


def test_fit_is_a_least_squares_optimum():
    """No pattern in use pulls, and no other one would lower the misfit."""
    rng = np.random.RandomState(3)
    patterns = packing.length_patterns(24)
    histogram = np.append(0, rng.randint(1, 50, 24)).astype(float)
    x = packing.fit_repeats(histogram, patterns, packing.PackConfig(capacity=24, short_weight=1.0, fit_rounds=500, tolerance=1e-9))
    held = np.zeros(25)
    for p, n in zip(patterns, x):
        for length in p[p > 0]:
            held[length] += n
    pull = np.append(0, (histogram - held)[1:])[patterns].sum(1)
    assert (x >= 0).all() and abs(pull[x > 0]).max() < 1e-4 and pull.max() < 1e-4


# --- vector codes ------------------------------------------------------------------


def brute(x, book):
    far = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, e)) for e in book] for r in x]
    return [f.index(min(f)) for f in far], [min(f) for f in far]


@pytest.mark.parametrize(("most", "width"), [(3, 4), (40, 5), (10 ** 6, 3), (10 ** 12, 3), (2 ** 62, 2), (5, 0), (2, 1)])
def test_trie_finds_the_nearest_entry(most, width):
    rng = random.Random(width)
    make = lambda n: np.array([[rng.randint(-most, most) for _ in range(width)] for _ in range(n)], np.int64).reshape(n, width)
    rows, book = make(300), make(7)
    leaves, which = codes._sorted_parts(rows)
    assert (leaves[which] == rows).all() and len({tuple(r) for r in rows}) == len(leaves)
    entry, far = codes.nearest(leaves, book)
    assert (entry.tolist(), [int(f) for f in far]) == brute(leaves, book)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string, v int")


def test_codes_equal_sql_for_any_window(spark, tmp_path):
    rng = random.Random(8)
    make = lambda: [rng.choice([-1.5, -0.001, 0.0, 0.25, 2.0]) + rng.choice([0, 0.01]) for _ in range(8)]
    rows = [(i // 2 if i < 600 else None, make(), rng.choice([None, 1, 2]), "c", 0) for i in range(620)]
    rows += [(5, None, 1, "c", 0), (1, [1.0, None] * 4, 1, "c", 0), (2, [float("nan")] * 8, 1, "c", 0), (3, [float("inf")] * 8, None, "c", 0)]
    table = vectors(spark, rows)
    table.write.parquet(str(tmp_path / "v"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/v/*.parquet')")
    for window in (3, 4096):
        assert compare.differences(codes.op13_vector_codes(table, codes.CodeConfig(window=window)), con, codes.ORACLE_SQL) == []


def test_codes_of_odd_vectors(spark):
    got = codes.op13_vector_codes(vectors(spark, [(1, [], None, "", 0), (2, [], 3, "", 0)])).collect()
    assert [(r.code, r.error, r.label_error) for r in got] == [("00" * 4, 0, 0)] * 2
    assert codes.op13_vector_codes(vectors(spark, [])).count() == 0
    assert codes.op13_vector_codes(vectors(spark, [(1, None, 1, "", 0)])).count() == 0
    huge = codes.op13_vector_codes(vectors(spark, [(i, [3e38 * (-1) ** i] * 4 + [float(i)], 1, "", 0) for i in range(300)])).collect()
    assert len(huge) == 300 and all(len(r.code) == 8 and r.error >= 0 for r in huge)


def test_parts_are_stored_once_and_sorted(spark):
    rows = codes.integers(spark.read.parquet(f"{SF}/embeddings.parquet").limit(50), codes.CodeConfig(), "vec_id", "embedding", "label")
    parts = codes.distinct_parts(rows.unionByName(rows), codes.CodeConfig())
    assert parts.agg(F.sum("n")).first()[0] == 400 and parts.count() == parts.select("part", "values").distinct().count()
