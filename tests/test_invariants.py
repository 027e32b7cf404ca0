"""Totals that must agree across models, on the derived tables."""

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA, one

from coverloom.operators.staging import Staged
from coverloom.plans import analyst, dashboard, marts
from coverloom.sources.order_tables import AS_OF, OrderTables


@pytest.fixture(scope="module")
def s(spark):
    return Staged(OrderTables(spark, TESTDATA), AS_OF)


def total(frame, *columns):
    return tuple(one(frame.agg(*[F.sum(c) for c in columns])))


def test_facts_keep_their_rows(s):
    assert marts.fct_payments(s).count() == s.payments.count() == s.raw.payments.count()
    assert marts.fct_member_churn(s).count() == s.cancellations.count()
    assert marts.dim_agents(s).count() == s.agents.count()


def test_billed_is_collected_plus_uncollected(s):
    billed, collected, open_ = total(
        analyst.monthly_revenue(s.payments), "total_billed", "total_collected", "total_uncollected"
    )
    assert billed == collected + open_


def test_totals_agree_between_models(s):
    fact, priced = marts.fct_payments(s), marts.priced_payments(s)
    due, paid, commission = total(fact, "amount_due", "amount_paid", "commission_earned")
    summary, monthly = marts.agent_commission_summary(s), marts.agent_commission_summary_monthly(s)
    measures = ("total_amount_due", "total_amount_collected", "total_commission_earned", "total_payments_due")
    expected = (due, paid, commission, fact.count())
    assert total(summary, *measures) == total(monthly, *measures) == expected
    assert total(analyst.carrier_revenue(priced), "total_billed", "total_collected", "total_commissions") == expected[:3]
    assert total(analyst.monthly_revenue(s.payments), "total_billed", "total_collected") == expected[:2]
    assert total(dashboard.carrier_month(s.payments), "amount_collected") == (paid,)
    assert total(dashboard.plan_mix(s.payments), "amount_collected") == (paid,)


def test_churn_adds_up_over_months_but_not_over_carriers(s):
    cancellations = s.cancellations.count()
    assert total(marts.agent_commission_summary_monthly(s), "members_churned") == (cancellations,)
    assert total(marts.agent_commission_summary(s), "members_churned")[0] != cancellations


def test_summary_grain(s):
    summary = marts.agent_commission_summary(s)
    assert summary.count() == summary.select("agent_id", "period", "carrier").distinct().count()
    monthly = marts.agent_commission_summary_monthly(s)
    assert monthly.count() == monthly.select("agent_id", "period").distinct().count()


def test_churn_counts_agree(s):
    n = s.cancellations.count()
    assert total(analyst.churn_by_reason(marts.priced_cancellations(s)), "total_cancellations") == (n,)
    assert total(dashboard.churn_waterfall(s.cancellations), "total_cancellations") == (n,)
    assert total(dashboard.churn_rate_by_plan(s.cancellations, s.policies), "churned", "total_policies") == (
        n, s.policies.count(),
    )
    assert total(dashboard.churn_by_state(s.cancellations, s.members), "churned", "total_members") == (
        n, s.members.count(),
    )


def test_queries_over_stored_facts_equal_queries_over_staged_tables(s):
    fact = marts.fct_payments(s)
    assert analyst.monthly_revenue(fact).collect() == analyst.monthly_revenue(s.payments).collect()
    assert analyst.carrier_revenue(fact).collect() == analyst.carrier_revenue(marts.priced_payments(s)).collect()
    churn = marts.fct_member_churn(s)
    assert (
        analyst.eligibility_gap(fact, churn, AS_OF).collect()
        == analyst.eligibility_gap(s.payments, s.cancellations, AS_OF).collect()
    )
    assert (
        analyst.churn_by_reason(churn).collect()
        == analyst.churn_by_reason(marts.priced_cancellations(s)).collect()
    )
