"""The registered queries against SQL, and the pipeline against its own stages."""

import pytest

import __spark_entry__ as contract
from knownwhen.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL
from verification.compare import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SMALL), name, QUERIES[name], ORACLES[name], SMALL) == ""


def test_all_are_registered():
    assert set(QUERIES) < set(contract.queries()) and "pipeline" in contract.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_a_row_for_each_input_row(spark, name):
    source = "pages" if name == "op5_html_text" else "documents"
    rows = spark.read.parquet(f"{SMALL}/{source}.parquet").count()
    assert QUERIES[name](spark, SMALL).count() == rows
