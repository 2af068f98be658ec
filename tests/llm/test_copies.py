"""Exact and near copies against brute force, and the pipeline."""

import itertools
from collections import Counter

import cases
import compare
import numpy as np
import pytest
from conftest import SF

import corpus_pipeline
from tidemark.llm import components, exactdup, minhash
from tidemark.session import settle


def test_colliding_digests_are_told_apart(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    config = exactdup.ChunkConfig(bits=8, least=64, most=1024, digest_bytes=1)
    assert compare.differences(exactdup.op5_exact_dedup(d, config), compare.connect(SF), exactdup.ORACLE_SQL) == []


def test_chunks_follow_content():
    rng, gear, config = np.random.RandomState(0), exactdup._gear(), exactdup.ChunkConfig()
    data = rng.bytes(200_000)
    chunks = exactdup.cut(data, config, gear)
    assert b"".join(chunks) == data and max(map(len, chunks)) <= config.most and min(map(len, chunks[:-1])) >= config.least
    assert exactdup.cut(data, config, gear, step=5000) == chunks
    moved = exactdup.cut(b"new start " + data, config, gear)
    assert len(set(moved) & set(chunks)) > 0.9 * len(chunks)
    assert exactdup.cut(b"", config, gear) == [] and exactdup.cut(b"x", config, gear) == [b"x"]


def test_rows_without_copies_keep_their_columns(spark):
    d = cases.awkward(spark)
    kept = exactdup.drop_copies(d)
    assert kept.columns == d.columns
    texts = [" ".join((r[1] or "").split(" ")) for r in kept.collect()]
    normal = Counter(exactdup._normal_bytes(t) for t in texts)
    assert set(normal.values()) == {1}
    assert set(normal) == {exactdup._normal_bytes(r[1] or "") for r in cases.rows()}
    assert exactdup.drop_copies(cases.empty(spark)).count() == 0


def weights(text, n=5):
    w = (text or "").split()
    return Counter(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else Counter()


def probability_jaccard(a, b):
    both = set(a) | set(b)
    return sum(1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in both) for x in a if x in b)


def brute_classes(docs):
    """Smallest id by document, over all pairs that share a shingle."""
    sets = {i: weights(t) for i, t in docs.items()}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    root = {i: i for i in docs}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in {p for h in holders.values() for p in itertools.combinations(h, 2)}:
        if top(i) != top(j) and probability_jaccard(sets[i], sets[j]) >= 0.8:
            root[max(top(i), top(j))] = min(top(i), top(j))
    return {i: top(i) for i in docs}


def test_similarity_equals_its_definition():
    rng = np.random.RandomState(2)
    for _ in range(50):
        a, b = (dict(zip(rng.choice(40, 20, False).tolist(), rng.randint(1, 6, 20).tolist())) for _ in "ab")
        pack = lambda d: (np.array(sorted(d), np.uint64), np.array([d[k] for k in sorted(d)]))
        assert minhash.similarity(*pack(a), *pack(b)) == pytest.approx(probability_jaccard(Counter(a), Counter(b)))


def test_registers_estimate_probability_jaccard():
    words = [f"w{i}" for i in range(400)]
    one, two = " ".join(words + words[:100] * 3), " ".join(words[:350] + words[:100] * 3)
    doc, h, n = minhash.shingles([minhash._words(t) for t in (one, two)], 5)
    kept = minhash.signatures(doc, h, n, 2, 4096)
    assert abs((kept[0] == kept[1]).mean() - probability_jaccard(weights(one), weights(two))) < 0.03


def test_shingles_equal_words():
    texts = [r[1] or "" for r in cases.rows()]
    doc, _, n = minhash.shingles([minhash._words(t) for t in texts], 5)
    for i, t in enumerate(texts):
        assert sorted(n[doc == i].tolist()) == sorted(weights(t).values())


def test_near_classes_equal_brute_force(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = minhash.op8_near_dedup(d).toPandas()
    assert dict(zip(got.doc_id, got.class_id)) == brute_classes({r.doc_id: r.text for r in d.collect()})
    assert (got.kept == (got.doc_id == got.class_id)).all()
    assert (got.class_size == got.groupby("class_id").doc_id.transform("size")).all()


def test_one_large_group_of_near_copies(spark, monkeypatch):
    """Chains of edits: neighbours are similar, the ends are not, and more than one component meets in a bucket."""
    rng = np.random.RandomState(5)
    base = [f"t{i}" for i in range(120)]
    texts = {}
    for i in range(150):
        if i % 3 == 0:
            base[rng.randint(120)] = f"n{i}"
        mine = list(base)
        mine[rng.randint(120)] = f"m{i}"
        texts[i] = " ".join(mine)
    for i in range(150, 200):  # similar, but not enough
        mine = [f"u{k}" for k in range(80)]
        for k in rng.choice(80, 4, False):
            mine[k] = f"v{i}_{k}"
        texts[i] = " ".join(mine)
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected = brute_classes(texts)
    for most, piece in ((1 << 22, 1024), (300, 8)):  # one task a cluster, and about one pair of texts a task
        monkeypatch.setattr(minhash, "SLICE", piece)
        got = minhash.op8_near_dedup(d, minhash.NearConfig(block=16, cluster_shingles=most)).toPandas()
        assert dict(zip(got.doc_id, got.class_id)) == expected


def test_awkward_near_copies(spark):
    d = cases.awkward(spark)
    got = minhash.op8_near_dedup(d).toPandas()
    assert len(got) == len(cases.rows())
    assert got[got.doc_id.isin([1, 2, 3, 4])].class_id.tolist() == [1.0] * 4 and got.class_size.max() == 5
    assert set(got[got.doc_id.isin([6, 7, 8])].class_size) == {1}
    assert got[got.doc_id == 5].kept.tolist().count(True) == 1
    kept = minhash.drop_near(d)
    assert kept.columns == d.columns and kept.count() == got.kept.sum()
    assert minhash.op8_near_dedup(cases.empty(spark)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (102, 101)]
    got = dict(components.components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 104)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("make", [cases.awkward, cases.empty, lambda spark: spark.read.parquet(f"{SF}/documents.parquet")])
def test_pipeline_stages(spark, make):
    docs, names = make(spark), make(spark).columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, settle(stage(spark, docs, SF), f"test-{name}")
        if i < 4:
            assert docs.columns == names, name
        if name == "exact_dedup":
            assert docs.count() == before.select(exactdup.normalised(before["text"])).distinct().count()
        if name == "near_dedup":
            ids = {r.doc_id: r.text for r in before.collect()}
            if None not in ids and len(ids) == before.count():
                classes = brute_classes(ids)
                assert sorted(r.doc_id for r in docs.collect()) == sorted(set(classes.values()))
    assert "text" not in docs.columns


def test_pipeline_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
