"""The corpus queries against their SQL."""

import os

import pytest

import corpus_pipeline
from lodeworks.llm import queries
from oracle import connect, differences

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, duck, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), duck.sql(queries.ORACLE[name])) == []


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language",
        "near_duplicates",
        "decontamination",
        "secrets",
        "packing",
    ]


@pytest.mark.parametrize("name", ("op2_secrets", "op6_chat", "op11_url_filter"))
def test_native_plans_have_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"):
        assert unwanted not in plan
