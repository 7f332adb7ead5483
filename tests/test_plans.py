"""Physical-plan shape of the main chains: the properties the design relies on at scale."""

import os

import pytest

from smoke_tables import SMOKE


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.exists(SMOKE), reason="test tables not present")
def test_daily_chain_plan(spark):
    from skyledger.plans.marts import from_test_tables
    m = from_test_tables(spark, SMOKE, stamps=False)
    plan = physical(m.facts)
    # one exchange for the dedup (after a map-side top-1), one for the rolling means
    assert plan.count("Exchange hashpartitioning") == 2, plan
    assert "WindowGroupLimit" in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.skipif(not os.path.exists(SMOKE), reason="test tables not present")
def test_report_plan_prunes(spark):
    from skyledger.plans import reports as R
    from skyledger.plans.registry import _w
    w = _w(spark, SMOKE)
    df = R.hottest(w.facts, 7, 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "PartitionFilters: [isnotnull(year_month" in plan
    # only the columns the report reads are scanned
    assert "ReadSchema: struct<date:date,city_name:string,mesoregion:string,temp_max_c:decimal(18,9)>" in plan


@pytest.mark.skipif(not os.path.exists(SMOKE), reason="test tables not present")
@pytest.mark.parametrize("report", ["hour_profile", "day_profile", "max_dates"])
def test_hourly_anchor_prunes_partitions(spark, report):
    """The city's (or table's) latest date comes from the folder list: one scan, limited to the days it needs."""
    from skyledger.plans import reports as R
    from skyledger.plans.bridge import CITY
    from skyledger.plans.registry import _w
    h = _w(spark, SMOKE).hourly_facts
    if report == "max_dates":
        plan = physical(R.max_dates(_w(spark, SMOKE).facts, _w(spark, SMOKE).alerts, h))
        assert "hourly_facts" not in plan
        return
    df = getattr(R, report)(h, CITY)
    plan = physical(df)
    assert plan.count("FileScan parquet") == 1, plan
    assert "PartitionFilters: [isnotnull(date" in plan and "Subquery" not in plan, plan
    assert len(df.inputFiles()) > 0
