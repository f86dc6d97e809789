"""The registered queries against SQL, or for their columns, at the smallest scale."""

import pytest

import corpus_pipeline
from shelfsync.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, ROOT), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs_over_every_row(spark, con, name):
    table = "pages" if name in ("op1_html_text", "op2_warc") else "documents"
    assert QUERIES[name](spark, ROOT).count() == con.execute(f"SELECT count(*) FROM {table}").fetchall()[0][0]


def test_pipeline_has_its_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]
