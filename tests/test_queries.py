"""Every published query against its SQL twin, and what its plan may not hold."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from tools.check import connect, difference  # noqa: E402

QUERIES = contract.queries()
TWINS = contract.oracle_sql()
# Queries of the optional sub-package have their own tests.
OWN = [n for n in TWINS if n not in contract.optional()]


@pytest.fixture(scope="module")
def duck():
    from conftest import DATA

    return connect(DATA)


@pytest.mark.parametrize("name", OWN)
def test_equals_sql(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    assert difference(df, duck, TWINS[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert banned not in plan


def test_bucketed_join_does_not_shuffle(spark, data):
    plan = QUERIES["training_frame_bucketed"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_every_own_query_has_a_twin():
    assert set(OWN) == set(QUERIES) - contract.optional()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["shift", "n", "corr_real_estate_price", "corr_all_type_complaint"]
    assert df.count() == 7


def test_scores_only_where_a_record_exists(spark, data):
    scored = QUERIES["score_requests"](spark, data)
    assert scored.filter("(status = 'ok') <> has_prediction").count() == 0
    assert scored.filter("status <> 'ok'").count() > 0
    assert scored.count() == spark.read.parquet(f"{data}/orders.parquet").count()
