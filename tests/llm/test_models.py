"""Language identification, pieces, pages and neighbours."""

import random
import time

import cases
import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidemark.llm import langid, neighbours, pages, pieces


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.op1_language_id(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 200 and (got.lang == got.lang_pred).mean() >= 0.98
    assert got.score.between(0, 1).all() and got.rejected.mean() < 0.01


def test_awkward_languages(spark):
    d = cases.awkward(spark)
    config = langid.LangConfig(sample_per_lang=50)
    got = langid.op1_language_id(d, config).toPandas()
    assert len(got) == len(cases.rows())
    blank = sum(not any(c.isalpha() for c in r[1] or "") for r in cases.rows())
    assert (got.lang_pred == "und").sum() == blank and not got.held_out[got.doc_id.isna()].any()
    assert set(got.lang_pred) <= {"en", "de", "und"}
    kept = langid.keep_identified(d, config)
    assert kept.columns == d.columns and kept.where("text is null").count() == 0
    assert langid.op1_language_id(cases.empty(spark)).count() == 0
    assert set(r.lang_pred for r in langid.op1_language_id(d.withColumn("lang", F.lit(None).cast("string"))).collect()) == {"und"}


def test_slices_of_long_texts_count_alike():
    kinds = np.repeat(*langid._kind_runs())
    text = "Häuser am  Fluß, 12 Stück! " * 30
    whole, _ = langid._counts(text, 13, kinds)
    for step in (7, 64, 1000):
        assert (langid._counts(text, 13, kinds, step)[0] == whole).all()


def test_strange_script_is_rejected(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit_held_in(d)
    odd = spark.createDataFrame([("Широкая река медленно течёт по равнине и дети смотрят на неё с моста " * 5,), (d.first().text,)], "text string")
    assert [r.language.rejected for r in langid.identify(odd, model).collect()] == [True, False]


@pytest.fixture(scope="module")
def strings(spark):
    rng = random.Random(3)
    letters = "abcdeé   \n\tthein日本語🎉ß.,!0123"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(1500)]
    return [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + made + ["", " ", "   x", "a" * 300, " " * 100, "the" * 200]


def test_pieces_equal_the_library(strings):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    got = pieces.Encoder(pieces.load(), most_words=500).encode(strings)
    assert [g.tolist() for g in got] == lib.encode(strings, num_threads=1)


def test_unigram_pieces_equal_the_library(strings):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    m.ParseFromString(open(pieces.DEFAULT_MODEL, "rb").read())
    m.trainer_spec.model_type = pieces.UNIGRAM
    rng = random.Random(1)
    for p in m.pieces:
        if p.type == pieces.NORMAL:
            p.score = -rng.uniform(4, 12)
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    texts = [t[:300] for t in strings]
    model = pieces.from_proto(m)
    score = {i: model.scores[p] for p, i in model.ids.items()}
    total = lambda ids: sum(score.get(i, 0) for i in ids)
    differ = 0
    for mine, theirs in zip(pieces.Encoder(model).encode(texts), lib.encode(texts, num_threads=1)):
        # Equal sums, as of one sign three times, leave a choice.
        assert mine.tolist() == theirs or total(mine) == pytest.approx(total(theirs), abs=1e-6)
        differ += mine.tolist() != theirs
    assert differ < len(texts) / 50


def test_round_trip_and_nulls(spark):
    got = {(r.doc_id, r.n_tokens): r for r in pieces.op2_pieces(cases.awkward(spark)).collect()}
    assert all(r.round_trip or r.token_ids is None for r in got.values())
    assert got[6, 0].token_ids is None and got[7, 0].token_ids == []
    assert pieces.op2_pieces(cases.empty(spark)).count() == 0
    model = pieces.load()
    odd = spark.createDataFrame([([1, 5, 99999, -1, None],), (None,), ([],)], "token_ids array<int>")
    assert [r.decoded is None for r in pieces.decode_column(odd, model).collect()] == [False, True, False]
    names = pieces.tokenised(cases.awkward(spark)).columns
    assert "text" not in names and names[-1] == "_token_ids"


def test_pages_without_marks():
    long, more = "word " * 60, "more " * 40
    page = (f'<div class="menu"><a href=x>Home</a></div><div id=content><p>{long}</p><p>short.</p><p>{more}</p></div>'
            f'<div class="cookie-notice">We use cookies</div><section id="comments"><p>{"said " * 30}</p></section>'
            '<ul><li><a>one</a></li><li><a>two</a></li><li><a>three</a></li><li><a>four</a></li></ul><p>(c) us</p>')
    assert pages.main_text(page) == f"{long}short. {more}".strip()


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("only text", "only text"), ("<p>a &amp; b &lt;c&gt;<p>d\n  e", "a & b <c> d e"),
    ("<nav><ul><li><a>x</a></ul><article><h1>T</h1><p>Hello <b>wor</b>ld<br>x</p><aside>s</aside><form><input>N<button>Go</button></form>"
     '<div class="comments"><p>c</p></div>tail</article><footer>f</footer>', "T Hello world x tail"),
    ('<article><header><h1>T</h1></header><p>a</p><script>var t="</p>";</script><!-- b --><p hidden>h</p><p>c</article><header>H</header>', "T a c"),
    ("<article><p>cut off <a hre", "cut off"), ('<div title="a > b">x</div>', "x"), ("<script>if(a<b)", ""), ("1 < 2 &copy 3", "1 < 2 © 3"),
])
def test_pages(page, text):
    assert pages.main_text(page) == text


LONG, TALE = ("long " * 60).strip(), ("tale " * 30).strip()


@pytest.mark.parametrize(("page", "text"), [
    (f"<div id=content><p>{LONG}</p></div><aside><article><h3>Related</h3></article></aside>", LONG),
    (f"<div id=content><p>{LONG}</p></div><article><h3>Teaser</h3></article><p>Top</p>", f"{LONG} Teaser"),
    (f"<p>{LONG}</p><ul><li><a>1</a><li><a>2</a><li><a>3</a></ul><p>tiny</p><article>a</article>", f"{LONG} a"),
    (f"<p>Skip</p><article>T</article><p>Skip</p><section id=comments><article>{TALE}</article></section>", "T"),
    (f"<nav><a>Home</a><article>{LONG}</article><footer>f</footer>", LONG),
    (f"<form id=all><nav><article>n</article></nav><article>{LONG}</article></form>", LONG),
])
def test_page_marks_raise_only(page, text):
    assert pages.main_text(page) == text


@pytest.mark.parametrize(("page", "text"), [
    *((f'<article><div class="{name}">{LONG}</div></article>', LONG) for name in (
        "entry-content no-sidebar", "has-sidebar", "content-with-footer", "share-enabled", "social-science", "page-banner")),
    (f'<div class="has-sidebar"><p>{LONG}</p><div class="sidebar"><p>{TALE}</p></div></div>', LONG),
    (f'<p>{LONG} {LONG} {LONG}</p><div id="social-science"><p>{LONG}</p><p>{LONG}</p></div>', " ".join([LONG] * 5)),
    (f'<article><h1>T</h1><p class="notice">{LONG}</p><p class="notice">n</p></article>', f"T {LONG}"),
    (f'<article><h1>T</h1></article><div class="ad">{TALE[:100]}</div>', "T"),
    (f'<div class="banner"><p>hey</p><article>{LONG}</article><p>b</p>', LONG),
    (f'<article><p>{LONG}</p><div class="related"><ul>' + "<li><a>one more tale to read</a>" * 20 + "</ul></div></article>", LONG),
    (f'<article>{LONG}</article><div class="promo"><ul>' + "<li>one <a>more tale to read</a>" * 20 + "</ul></div>", LONG),
    ("".join(f'<article><h2>T{i}</h2><div class="has-sidebar">{TALE}</div></article>' for i in range(3)), " ".join(f"T{i} {TALE}" for i in range(3))),
])
def test_page_names_lower_only(page, text):
    assert pages.main_text(page) == text


SAID = ("they said " * 45).strip()


@pytest.mark.parametrize(("page", "text"), [
    (f'<article><p>{LONG}</p><div class="comments"><p>{SAID}</p></div></article>', LONG),
    (f'<div id="content"><p>{LONG}</p></div><div id="comments"><p>{SAID}</p><p>{SAID}</p><p>{SAID}</p></div>', LONG),
    (f'<article><p>{LONG}</p></article><ul class="commentlist"><li>{SAID}</li><li>{SAID}</li></ul>', LONG),
    (f'<article><p>{LONG}</p><div class="advert">{SAID}</div><p>{TALE}</p></article>', f"{LONG} {TALE}"),
    (f'<div class="cookie-consent"><p>{SAID}</p></div><div id="content"><p>{LONG}</p></div>', LONG),
    (f'<article><p class="newsletter-box">{SAID}</p><p>{LONG}</p></article>', LONG),
    # What a name only touches, the page's only text, and a wrapper around the article stay.
    (f'<div class="has-comments"><p>{LONG}</p></div>', LONG), (f'<div class="notice"><p>{LONG}</p></div><p>by us</p>', f"{LONG} by us"),
    (f'<div class="subscription"><article>{LONG}</article></div><p>{TALE}</p>', f"{LONG} {TALE}"),
    (f'<div class="notice-of-meeting"><p>{LONG}</p><p>{LONG}</p></div>', f"{LONG} {LONG}"),
])
def test_parts_that_are_plainly_no_text(page, text):
    assert pages.main_text(page) == text


@pytest.mark.parametrize("unit", ['<div class="ad">', '<div class="ad">x', "<ul><li>", "<article><div>", "<article></article><nav>", "</section><div hidden>",
                                  '<div class="comments"><p>x</p>'])
def test_hostile_pages_take_linear_time(unit):
    began = time.process_time()
    pages.main_text(unit * ((1 << 20) // len(unit)))
    assert time.process_time() - began < 15


def test_window_sums_equal_brute_force():
    """Surge and dive by looking at every window by itself."""
    rng = random.Random(6)
    for _ in range(300):
        sizes = [rng.choice([0, 1, 20, 50, 90, 200]) for _ in range(rng.randrange(1, 25))]
        page = "".join(f"<p>{'x' * n}</p>" if n else "<p><a>link</a></p>" for n in sizes)
        sums = [sum(sizes[i:i + 3]) for i in range(len(sizes))]
        least = min(80, 0.5 * max(sums)) or 1
        want, inside = [], False
        for n, total in zip(sizes, sums):
            inside = (total >= least and n > 0) if not inside else total > 0 and (total >= least or n > 0)
            if inside and n:
                want.append("x" * n)
        assert pages.main_text(page) == " ".join(want)


def test_page_query(spark):
    d = spark.createDataFrame([(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<p>é🎉</p>", "y"), (2, "v", "<p>" + "z " * 100000, "q")],
                              "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text[:4], r.n_chars) for r in pages.op7_pages(d).collect()]
    assert got == [(1, "", 0), (1, "", 0), (None, "é🎉", 2), (2, "z z ", 199999)]
    assert pages.op7_pages(d.limit(0)).count() == 0


def brute(vectors, k=20):
    want = {}
    for i, v in vectors.items():
        if i % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vectors.items() if j != i and len(v) == len(w))
            want[i] = [j for _, j in found[:k]]
    return want


def test_neighbours_recall(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    vectors = {r.vec_id: np.asarray(r.embedding, np.float64) for r in d.collect()}
    for config in (neighbours.GraphConfig(), neighbours.GraphConfig(shard_rows=100, block=7, degree=16, beam=40)):
        got = neighbours.op4_neighbours(d, config).toPandas().sort_values(["query_id", "rank"])
        found = got.groupby("query_id").vec_id.apply(list)
        want = brute(vectors)
        assert set(found.index) == set(want)
        assert np.mean([len(set(found[i]) & set(w)) / len(w) for i, w in want.items()]) >= 0.95
        assert all(abs(r.score - float(vectors[r.query_id] @ vectors[r.vec_id])) < 1e-12 for r in got.itertuples())


def test_neighbours_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100 + i, [0.5, float(i)]) for i in range(30)] + [
        (200, None), (220, []), (240, [0.0, 0.0]), (260, [nan, 1.0]), (280, [1.0, None]), (300, [inf, 1.0]), (None, [1.0, 1.0]),
        (320, [1.0, 2.0, 3.0]), (321, [1.0, 0.0, 0.0]), (340, [3.0, 1.0]), (340, [3.0, 1.0]), (340, [2.0, 1.0])]
    d = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, shard string")
    got = neighbours.op4_neighbours(d, neighbours.GraphConfig(shard_rows=40)).toPandas().sort_values(["query_id", "rank"])
    vectors = {i: v for i, v in rows if i is not None and v and i not in (240, 260, 280, 300)}
    vectors[340] = [2.0, 1.0]
    assert got.groupby("query_id").vec_id.apply(list).to_dict() == brute(vectors)
    assert neighbours.op4_neighbours(d.limit(0)).count() == 0


def test_neighbours_of_ids_with_many_vectors(spark):
    # Id 7 has a third of all rows, each vector its own, all nearest to the queries; the graph's beam is full of it.
    rng = np.random.RandomState(3)
    rows = [(7, [2.0 + float(rng.rand()), float(rng.rand())]) for _ in range(400)] + [(9, [1.0, 1.0]), (9, [9.0, 9.0])] * 200
    rows += [(i, [float(a), float(b)]) for i, (a, b) in enumerate(rng.rand(400, 2), 100)] + [(20, [1.0, 0.5]), (40, [0.5, 1.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    config = neighbours.GraphConfig(shard_rows=300)
    index = neighbours.build_index(d, config).collect()
    kept = [len(r.ids) // 8 for r in index]
    assert sum(kept) == len({(i, tuple(v)) for i, v in rows}) and len(kept) == 3 and max(kept) < 330
    got = neighbours.op4_neighbours(d, config).toPandas().sort_values(["query_id", "rank"])
    for me, q in ((20, (1.0, 0.5)), (40, (0.5, 1.0))):
        best = {}
        for i, v in rows:
            if i != me:
                best[i] = max(best.get(i, -1), q[0] * v[0] + q[1] * v[1])
        want = sorted(best, key=lambda i: (-best[i], i))[:20]
        mine = got[got.query_id == me]
        assert mine.vec_id.tolist() == want and want[:2] == [9, 7]
        assert np.allclose(mine.score, [best[i] for i in want])


def test_pieces_do_not_depend_on_what_a_task_may_remember(spark):
    words = [f"w{i}x{i * i}" for i in range(3000)]
    rows = [(i, " ".join(words[i * 37 % 2000:i * 37 % 2000 + 400])) for i in range(60)] + [(60, None), (61, "")]
    docs, model = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), pieces.load()
    ids = lambda df: {r.doc_id: r.token_ids for r in df.collect()}
    usual = ids(pieces.encode_column(docs, model))
    assert usual == ids(pieces.encode_column(docs, model, most_words=50, run_bytes=1000))
    assert usual == ids(pieces.tokenised(docs)) and usual[60] is None and usual[61] == []
