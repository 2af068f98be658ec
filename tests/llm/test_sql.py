"""Queries that SQL can express, against their SQL, on the given tables and on awkward documents."""

import cases
import compare
import pytest
from conftest import SF

from tidemark.llm import divergence, exactdup, licences, mixing, queries, secrets, sharding

ON_DOCS = {"op3_mix": mixing.op3_mix, "op5_exact_dedup": exactdup.op5_exact_dedup, "op6_licences": licences.op6_licences,
           "op9_secrets": secrets.op9_secrets, "op10_shards": sharding.op10_shards, "op11_divergence": divergence.op11_divergence}


@pytest.fixture(scope="module")
def awkward_con(spark, tmp_path_factory):
    return cases.connect(cases.awkward(spark), tmp_path_factory.mktemp("sql") / "awkward")


@pytest.fixture(scope="module")
def empty_con(spark, tmp_path_factory):
    return cases.connect(cases.empty(spark), tmp_path_factory.mktemp("sql") / "empty")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_given_tables(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, SF), compare.connect(SF), queries.ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(ON_DOCS))
def test_awkward_documents(spark, awkward_con, name):
    assert compare.differences(ON_DOCS[name](cases.awkward(spark)), awkward_con, queries.ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(ON_DOCS))
def test_empty_table(spark, empty_con, name):
    assert compare.differences(ON_DOCS[name](cases.empty(spark)), empty_con, queries.ORACLES[name]) == []


def test_every_operator_has_a_query():
    assert sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0])) and {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
