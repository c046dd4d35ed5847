"""Every text query with a twin against DuckDB, and the registration of all."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry
import corpus_pipeline
from tidelog.llm.queries import QUERIES, TWINS

SF_DIR = os.environ.get("TIDELOG_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@needs_tables
@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_twin(spark, duck, name):
    assert not difference(spark, duck, name, QUERIES[name], TWINS[name], SF_DIR)


def test_all_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)}
    assert names["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "exact dedup", "n-gram Jaccard join", "benchmark decontamination",
        "byte-level BPE encoding and decoding"]


@needs_tables
@pytest.mark.parametrize("name", ["op1_chat_format", "op2_exact_dedup", "op7_url_filter", "op8_line_dedup"])
def test_native_queries_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    assert "NestedLoop" not in plan
