"""Mixing, sharding, secrets and licences beyond their SQL."""

import pathlib
import re

import cases
import pytest
from pyspark.sql import functions as F

from tidemark.llm import licences, mixing, secrets, sharding


def docs(spark, sizes):
    return spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in enumerate(sizes)], "doc_id long, text string, source string")


def test_targets_fill_and_reshare(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes, mixing.MixConfig()).collect()}
    # a stops at 30; b and c share 1480 as 2 to 1; the empty source stops at 0.
    assert got["a"] == 30 and got[None] == 0
    assert got["b"] == pytest.approx(1480 * 2 / 3) and got["c"] == pytest.approx(1480 / 3)


def test_mix_takes_what_is_planned_and_larger_budgets_nest(spark):
    d = docs(spark, [("a", 3 + i % 50) for i in range(600)] + [("b", 5) for _ in range(100)])
    taken = {}
    for weights in ((1, 1), (1, 3)):
        config = mixing.MixConfig(weights=weights, level_bits=5)
        plan = {r.doc_id: r for r in mixing.op3_mix(d, config).collect()}
        mixed = dict(mixing.mix(d, config).groupBy("doc_id").count().collect())
        assert {i: r.taken for i, r in plan.items() if r.taken} == {i: n * plan[i].size for i, n in mixed.items()}
        for source in "ab":
            mine = [r for i, r in plan.items() if (source == "a") == (i < 600)]
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine) / 2 + 1e-6
            assert all(r.taken <= 3 * r.size for r in mine)
        taken[weights] = plan
    more, less = taken[1, 1], taken[1, 3]
    assert all(more[i].taken >= less[i].taken for i in range(600))


def test_mix_reaches_targets_where_a_third_of_the_rows_share_an_id(spark):
    rows = [(None if i % 3 == 0 else i, f"w{i} " * (1 + i % 7), "a" if i % 5 else "b") for i in range(1500)]
    got = mixing.op3_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    for _, mine in got.groupby("target"):
        assert abs(mine.taken.sum() - mine.target.iloc[0]) <= 3.5 + 1e-6


def test_mix_keeps_columns_of_awkward_documents(spark):
    d = cases.awkward(spark)
    assert mixing.mix(d).columns == d.columns and mixing.mix(cases.empty(spark)).count() == 0


def test_shards_match_the_mixture(spark):
    d = docs(spark, [("a", 1)] * 900 + [("b", 1)] * 90 + [(None, 1)] * 10)
    got = sharding.assign_shards(d, sharding.ShardConfig(shards=8, bucket_rows=64)).toPandas()
    per = got.groupby("shard").size()
    assert len(per) == 8 and per.max() - per.min() <= 1
    by = got.groupby(["shard", got.source.fillna("")]).size().unstack(fill_value=0)
    assert (abs(by["a"] - 112.5) <= 2).all() and (abs(by["b"] - 11.25) <= 2).all() and by[""].max() <= 2
    for _, slots in got.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))
    for config in (sharding.ShardConfig(shards=8, bucket_rows=7), sharding.ShardConfig(shards=8, bucket_rows=7, block=3)):
        small = sharding.assign_shards(d, config).toPandas()
        assert small.sort_values("doc_id").shard.tolist() == got.sort_values("doc_id").shard.tolist()


def test_trigram_queries():
    q = secrets.trigram_query
    assert q(r"AKIA[A-Z0-9]{14,}") == [frozenset({"aki", "kia"})]
    assert q(r"[0-9a-f]{16,}") == [frozenset()] and q("ab") == [frozenset()]
    assert set(q(r"(?i:(secret|api_?key))x?")) == {frozenset({"sec", "ecr", "cre", "ret"}), frozenset({"api", "pik", "ike", "key"}),
                                                  frozenset({"api", "pi_", "i_k", "_ke", "key"})}
    assert q(r"abc(def)+") == [frozenset({"abc", "bcd", "cde", "def"})]


def test_secret_spans_equal_python(spark):
    d = cases.awkward(spark)
    got = {r.row_: r for r in secrets.scan(d.withColumn("row_", F.monotonically_increasing_id()), out="found").select("row_", "text", "found").collect()}
    assert len(got) == len(cases.rows())
    for r in got.values():
        want = sorted((m.start(), i, m.end(), rule.kind) for i, rule in enumerate(secrets.RULES) for m in re.finditer(rule.pattern, r.text or "")
                      if len(m[rule.group]) >= rule.least)
        assert [tuple(x) for x in r.found] == want


def test_licences_in_other_shapes(spark):
    mit = licences.TEXTS["MIT"]
    d = spark.createDataFrame([
        (1, "MIT License\n\nCopyright (c) 2020 A. Body\n\n" + mit.upper().replace("NONINFRINGEMENT", "NON-INFRINGEMENT").replace(",", " ,")),
        (2, "Some code\n\n" + mit.replace("\n", " ").replace("sublicense", "sub-licence") + "\n\nmore"),
        (3, "Mit.\nLicensed under the MIT License and more"), (4, "(* Licensed under the Apache Licence, version 2.0. *)")],
        "doc_id long, text string")
    got = {r.doc_id: (r.licences, r.whole) for r in licences.scan(d).collect()}
    assert got[1] == (["MIT"], "MIT") and got[2] == (["MIT"], None) and got[3] == ([], None) and got[4] == (["Apache-2.0"], "Apache-2.0")
    assert licences.scan(d, known=[]).where("n_matches > 0").count() == 0


def test_licences_in_full_and_amid_other_text(spark):
    folder = pathlib.Path(licences.__file__).parent / "texts"
    full = {p.stem: p.read_text("utf-8") for p in folder.glob("*.txt")}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0", "Unlicense"} <= set(full)
    one_line = lambda t: t.replace("\n", " \n ")
    mit = licences.TEXTS["MIT"].replace("conditions:\n", "conditions:\n\n").replace("Software.\nTHE", "Software.\n\nTHE")
    header = licences.TEXTS["Apache-2.0"].replace(" http", "\n\n    http").replace("\nUnless", "\n\nUnless")
    bsd = {n: licences.TEXTS[f"BSD-{n}-Clause"].replace("met:\n", "met:\n\n").replace("\n2. R", "\n\n2. R").replace(
        "\n3. N", "\n\n3. N").replace("\nTHIS", "\n\nTHIS") for n in (2, 3)}
    comment = "/*\n" + "\n".join(" * " + x for x in mit.split("\n")) + "\n */\n\nint x;"
    cut = mit.replace("The above copyright notice", "The above notice")
    swapped = "\n\n".join(mit.split("\n\n")[i] for i in (0, 2, 1))
    texts = [(f"whole {k}", one_line(v), k, k) for k, v in full.items()]
    texts += [(f"amid {k}", f"Some words.\n\n{v}\n\nx = 1\n", k, None) for k, v in full.items()]
    texts += [("apache terms", full["Apache-2.0"][:full["Apache-2.0"].index("END OF")], "Apache-2.0", "Apache-2.0"),
              ("titled", "The MIT License (MIT)\n\nCopyright (c) 2020 Me\n\n" + mit, "MIT", "MIT"),
              ("titled code", "The MIT License (MIT)\n\nCopyright (c) 2020 Me\n\n" + mit + "\n\ndef f(): pass", "MIT", None),
              ("comment", comment, "MIT", None), ("header", f"# x\n\n{header}\n\nimport y", "Apache-2.0", None),
              ("bsd 2", f"x\n\n{bsd[2]}\n\ny", "BSD-2-Clause", None), ("bsd 3", f"x\n\n{bsd[3]}\n\ny", "BSD-3-Clause", None),
              ("two", f"x\n\n{mit}\n\n{bsd[3]}\n\n{mit}", "BSD-3-Clause,MIT", None),
              ("cut", f"x\n\n{cut}", "", None), ("swapped", f"x\n\n{swapped}", "", None),
              ("interrupted", "\n\n".join(p + "\n\nother" for p in mit.split("\n\n")), "", None)]
    d = spark.createDataFrame([(n, t) for n, t, _, _ in texts], "doc_id string, text string")
    rows = {r.doc_id: r for r in licences.scan(d).collect()}
    got = {n: (",".join(rows[n].licences), rows[n].whole) for n, *_ in texts}
    assert got == {n: (licence, whole) for n, _, licence, whole in texts}
    assert rows["two"].n_matches == 2
