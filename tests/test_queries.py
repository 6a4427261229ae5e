"""Every registered query against its SQL twin on whole tables at the smallest scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as spark_entry
from tools.compare import compare, connect


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def sound(df):
    """No cross join and no Python step in the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"EvalPython|PythonUDF|MapInPandas|FlatMapGroupsInPandas", plan)


#: Queries of the corpus operators have tests of their own.
CORPUS = re.compile(r"op\d+_|pipeline$")
OWN = sorted(n for n in spark_entry.oracle_sql() if not CORPUS.match(n))


@pytest.mark.parametrize("name", OWN)
def test_matches_twin(spark, con, small, name):
    text, ok = compare(spark, con, small, name, sound)
    assert ok, text


def test_every_twin_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    assert all(CORPUS.match(n) for n in set(spark_entry.queries()) - set(spark_entry.oracle_sql()))


def fact_scans(df):
    """Scans of line items and the filters pushed into them, of all jobs' final plans below ``df``."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "FileScan" in line and "l_shipdate" in line]


def test_facts_are_read_once(spark, small, monkeypatch):
    """The evaluations read line items once, to store the facts, and nowhere else."""
    from flowgauge.plans import queries

    stored = []
    monkeypatch.setattr(queries, "stage", lambda df, label, own=queries.stage: stored.append(fact_scans(df)) or own(df, label))
    for name in ("weighted_f1", "regression_metrics", "model_drift", "evaluation_ledger", "evaluation_history"):
        stored.clear()
        df = spark_entry.queries()[name](spark, small)
        assert sum(map(len, stored)) == 1 and not fact_scans(df), name


def test_the_model_reads_only_its_period(spark, small):
    from flowgauge.plans import queries

    (scan,) = fact_scans(queries.model(spark, small, 2))
    pushed = scan[scan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(l_shipdate,1998-06-08" in pushed and "LessThan(l_shipdate,1998" in pushed


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).limit(1).count() == 1
