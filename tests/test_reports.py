"""Reports over the stored marts equal the registered queries, which start from raw tables."""

import re

import pytest
from pyspark.sql.types import DecimalType

import __spark_entry__ as registered
from conftest import TESTDATA

from coverloom.operators.staging import Staged
from coverloom.plans import warehouse
from coverloom.plans.reports import reports
from coverloom.sources.order_tables import AS_OF, OrderTables
from coverloom.sources.store import Store

SAME = {
    "monthly_revenue": "q1_monthly_revenue", "top_agents": "q2_top_agents", "churn_by_reason": "q3_churn_by_reason",
    "eligibility_gap": "q4_eligibility_gap", "churn_risk": "q5_churn_risk", "carrier_revenue": "q6_carrier_revenue",
    "exec_kpis": "d1_exec_kpis", "collection_trend": "d2_collection_trend", "carrier_month": "d3_carrier_month",
    "plan_mix": "d4_plan_mix", "tier_scatter": "d5_tier_scatter", "agent_scorecard": "d6_agent_scorecard",
    "agent_kpis": "d7_agent_kpis", "churn_waterfall": "d8_churn_waterfall", "churn_rate_by_plan": "d9_churn_rate_plan",
    "churn_monthly": "d10_churn_monthly", "churn_by_state": "d11_churn_state", "risk_by_state": "d11_churn_risk_state",
    "early_cancel_watchlist": "d12_early_cancel", "freshness": "d13_freshness",
}


@pytest.fixture(scope="module")
def found(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("marts")))
    s = Staged(OrderTables(spark, TESTDATA), AS_OF)
    warehouse.start(store, s)
    return reports(store, s)


def plain(frame):
    exact = [isinstance(f.dataType, DecimalType) for f in frame.schema.fields]
    return sorted(
        (tuple(float(v) if d and v is not None else v for v, d in zip(row, exact)) for row in frame.collect()), key=repr
    )


def test_every_report_is_compared(found):
    assert set(found) == {*SAME, "load_freshness"}


def test_sliced_reports_equal_the_sliced_queries(spark, found, tmp_path):
    store = Store(spark, str(tmp_path))
    s = Staged(OrderTables(spark, TESTDATA), AS_OF)
    warehouse.start(store, s)
    cut = reports(store, s, registered.SLICERS)
    for report, query in (("churn_by_reason", "sliced_churn"), ("tier_scatter", "sliced_tier_scatter")):
        assert plain(cut[report]) == plain(registered.queries()[query](spark, TESTDATA))
    assert cut["monthly_revenue"].agg({"due_period": "min"}).first()[0] >= "1996-03"


@pytest.mark.parametrize("name", sorted(SAME))
def test_report_equals_query(spark, found, name):
    query = registered.queries()[SAME[name]](spark, TESTDATA)
    assert found[name].columns == query.columns
    assert plain(found[name]) == plain(query)


@pytest.mark.parametrize("name", ["eligibility_gap", "churn_risk", "exec_kpis", "collection_trend", "top_agents", "freshness"])
def test_windows_open_their_months_only(found, name):
    text = found[name]._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"(due_period|period)#\d+ [<>]= (2001|1999)-\d\d", text)
    scans = [x for x in found[name]._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x]
    assert any(re.search(r"PartitionFilters: \[[^\]]*period", x) for x in scans)
