"""Every registered query against its SQL counterpart on the smallest test tables."""

import os

import pytest
from compare import connect, difference, duck_rows, spark_rows

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


# Pages are read by the parser of the standard library, in Arrow batches.
PARSED = {"html_article_text", "article_lengths", "html_page_forms", "appended_articles"}
# No join without keys, and no Python in the rows' way.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "InPandas")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    allowed = {"ArrowEvalPython"} if name in PARSED else set()
    assert not [node for node in UNWANTED if node in plan and node not in allowed]
    problem = difference(spark_rows(df), duck_rows(duck, ORACLES[name]))
    assert problem is None, problem


def test_scan_reads_only_what_is_used(spark):
    plan = QUERIES["rt_proxy"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    plan = QUERIES["unmatched_zones"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "c_acctbal" not in plan and "props" not in plan


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["zone", "province", "cross_border_watch", "date", "anomaly_score", "rank"]
    assert result.count() > 0


def test_file_integrity(spark):
    rows = QUERIES["file_integrity"](spark, FOLDER).collect()
    assert len(rows) == 14 and not any(r["looks_broken"] for r in rows)
