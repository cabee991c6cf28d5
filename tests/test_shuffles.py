"""What is shuffled on the way to stored views and landed files: tasks by the input's size, rows before they become lines."""

import re

import pytest

from conftest import SMALL
from loanlens.plans import catalog_maintain as maintained
from loanlens.plans import catalog_sources as sources
from loanlens.plans.adapter import Tables
from loanlens.session import scratch_path


@pytest.fixture
def small_tasks(spark, monkeypatch):
    spark.conf.set("loanlens.views.taskBytes", "4096")
    t = Tables(spark, SMALL, store=False)
    monkeypatch.setattr(t, "landed", lambda name, base=scratch_path(spark, "landed"): f"{base}/{name}")
    yield t
    spark.conf.unset("loanlens.views.taskBytes")


def _exchanges(df) -> list[str]:
    return re.findall(r"Exchange (\w+partitioning\(.*)", df._jdf.queryExecution().executedPlan().toString())


def test_views_are_shuffled_to_as_many_tasks_as_their_input_asks_for(small_tasks):
    n = small_tasks.write_tasks()
    assert n > int(small_tasks.spark.conf.get("spark.sql.shuffle.partitions"))
    for view in ("_build_loan_monthly", "_build_loan_months", "_build_pool_loans"):
        found = _exchanges(getattr(small_tasks, view)())
        assert found and all(f", {n})" in f for f in found), (view, found)


@pytest.mark.parametrize("view", ["_build_loan_static", "_build_econ"])
def test_orders_meet_customers_in_as_many_tasks_as_their_input_asks_for(small_tasks, view):
    """Where customers are too large to broadcast; where the session's partitions do, they are not dealt beforehand."""
    spark, name = small_tasks.spark, "spark.sql.autoBroadcastJoinThreshold"
    n, before = small_tasks.write_tasks(), spark.conf.get(name)
    try:
        spark.conf.set(name, "-1")
        df = getattr(small_tasks, view)()
        found = [f for f in _exchanges(df) if "custkey" in f]
        assert len(found) == 2 and all(f", {n})" in f for f in found), found
        spark.conf.unset("loanlens.views.taskBytes")
        plain = getattr(small_tasks, view)()
        assert all("ENSURE_REQUIREMENTS" in f for f in _exchanges(plain) if "custkey" in f)
        assert df.exceptAll(plain).count() == 0 and df.count() == plain.count()
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("land", ["_landed_ll", "_landed_lr", "_landed_mf"])
def test_no_rendered_line_is_shuffled_or_sorted(small_tasks, monkeypatch, land):
    made = []

    def keep(t, lines, path, **how):
        made.append(lines() if callable(lines) else lines)
        return path

    monkeypatch.setattr(sources, "_land", keep)
    getattr(sources, land)(small_tasks)
    plan = made[0]._jdf.queryExecution().executedPlan()
    assert "Exchange rangepartitioning" in plan.toString()
    for line in plan.toString().splitlines():
        assert not ("Exchange" in line and "value" in line), line


def test_landing_leaves_the_session_as_it_was(small_tasks):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = small_tasks.spark.conf.get(name)
    path = sources._landed_mf(small_tasks)
    assert small_tasks.spark.conf.get(name) == before
    lines = small_tasks.spark.read.option("recursiveFileLookup", "true").text(path)
    pools = small_tasks.pool_loans.count()
    assert {r["k"]: r["count"] for r in lines.groupBy(lines.value.substr(1, 1).alias("k")).count().collect()} == {"M": pools, "N": pools}


@pytest.mark.parametrize("query", ["_static_projection", "_liquidation_projection"])
def test_records_are_sorted_in_as_many_tasks_as_their_input_asks_for(small_tasks, query):
    """Every shuffle is that wide, none carries the text that ends an order, and the rows are one per key."""
    n = small_tasks.write_tasks()
    df = getattr(maintained, query)(small_tasks)
    found = _exchanges(df)
    assert found and all(int(re.search(r", (\d+)\)", f)[1]) >= n for f in found if "hashpartitioning" in f), found
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "Window [" in line)
    assert any("REPARTITION_BY_NUM" in line for line in plan[at:]) and not any("to_json" in line for line in plan[next(
        i for i, line in enumerate(plan) if i > at and "Exchange" in line):])
    want = small_tasks.loan_monthly
    rows = want.select("loan_id").distinct() if query == "_static_projection" else want.filter("current_month_liquidation = 'Y'")
    assert df.count() == rows.count()


def test_risk_joins_in_as_many_tasks_as_its_input_asks_for(small_tasks):
    """Loans and months meet in that many tasks; only the counts take the session's partitions."""
    n = small_tasks.write_tasks()
    found = [f for f in _exchanges(small_tasks._build_risk()) if "loan_id" in f or "l_orderkey" in f]
    assert found and all(f", {n})" in f for f in found), found


def test_risk_reads_the_stored_loan_months(spark, tmp_path):
    t = Tables(spark, SMALL, store=True)
    t.loan_months.count()
    plan = t._build_risk()._jdf.queryExecution().executedPlan().toString()
    assert "loan_months" in plan and "lineitem" not in plan and "Join" not in plan, plan


def test_loan_months_are_dealt_flat(small_tasks):
    """A key is shuffled once a row, not in each of the structs that hold it."""
    df = small_tasks._build_loan_months(small_tasks._dealt("loan_months"))
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "Exchange rangepartitioning" in line)
    assert any("named_struct" in line or "struct(" in line for line in plan[:at])
    assert not any("named_struct" in line or "struct(" in line for line in plan[at:])
    assert df.schema == small_tasks._build_loan_months().schema
    assert df.exceptAll(small_tasks._build_loan_months()).count() == 0 and df.count() == small_tasks._build_loan_months().count()
