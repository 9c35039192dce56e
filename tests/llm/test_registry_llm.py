"""What is registered, and that the native operators run no Python."""

import re

import pytest
from conftest import SF001

import __spark_entry__ as E
import corpus_pipeline
from tracklake.llm import suite


def test_every_operator_is_registered_once():
    names = list(suite.QUERIES)
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert suite.QUERIES.items() <= E.queries().items() and suite.ORACLE.items() <= E.oracle_sql().items()
    assert suite.ORACLE.keys() <= suite.QUERIES.keys() and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", ["op4_pii", "op5_sharding", "op6_chat_format"])
def test_native_operators_run_no_python(spark, name):
    df = suite.QUERIES[name](spark, SF001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_pipeline_runs_as_a_query(spark):
    out = suite.QUERIES["pipeline"](spark, SF001)
    assert out.columns == ["doc_id", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256"] and out.count() > 50
