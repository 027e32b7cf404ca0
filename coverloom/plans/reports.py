"""Every analyst question and dashboard dataset over the stored marts: the daily refresh.

Facts are read by month where a question looks at a window only, and no fact is joined
again for what it already holds.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame

from coverloom.operators.slicing import Slicers
from coverloom.operators.staging import Staged
from coverloom.operators.upsert import BATCHES, VERSION
from coverloom.plans import analyst, dashboard, marts
from coverloom.sources.store import Store


def reports(store: Store, s: Staged, slicers: Slicers = Slicers(), now: datetime | None = None) -> dict[str, DataFrame]:
    """Lazy frames by name, as of ``s.as_of``. With slicers, facts are cut before they are
    summed up: due dates for payments, cancellation dates for churn, and the summaries are
    taken from the facts that are left. ``now`` dates the freshness of the loads."""
    as_of = s.as_of
    year = date(as_of.year, 1, 1), date(as_of.year, 12, 31)

    def fact(start: date | None = None, end: date | None = None) -> DataFrame:
        # Months outside the slicer are not opened either.
        first = max((d for d in (start, slicers.start) if d), default=None)
        last = min((d for d in (end, slicers.end) if d), default=None)
        return slicers.cut(store.between("fct_payments", first, last), "fct_payments")

    payments, churn = fact(), slicers.cut(store.read("fct_member_churn"), "fct_member_churn")
    dim = slicers.cut(store.read("dim_agents"), "dim_agents")
    if slicers.is_set():
        churned = marts.churned_by_agent(churn)
        summary = marts.commission_summary(marts.billed_by_agent_from_fact(payments, "carrier"), churned, s.agents)
        monthly = marts.commission_summary_monthly(marts.billed_by_agent_from_fact(payments), churned, s.agents)
        year_summary = summary
    else:
        summary, year_summary = store.read("agent_commission_summary"), store.between("agent_commission_summary", *year)
        monthly = store.read("agent_commission_summary_monthly")

    risk = analyst.churn_risk_from_fact(fact(as_of - timedelta(days=analyst.RISK_DAYS)), as_of)
    scorecard = dashboard.agent_scorecard(monthly, dim, s.policies, as_of)
    trend = fact(dashboard.month_start(as_of, dashboard.TREND_MONTHS - 1), dashboard.month_end(as_of))
    return {
        "monthly_revenue": analyst.monthly_revenue(payments),
        "top_agents": analyst.top_agents(year_summary, as_of),
        "churn_by_reason": analyst.churn_by_reason(churn),
        "eligibility_gap": analyst.eligibility_gap(fact(as_of - timedelta(days=analyst.ACTIVE_DAYS)), churn, as_of),
        "churn_risk": risk,
        "carrier_revenue": analyst.carrier_revenue(payments),
        "exec_kpis": dashboard.exec_kpis(fact(*year), s.policies, as_of),
        "collection_trend": dashboard.collection_trend(trend, as_of),
        "carrier_month": dashboard.carrier_month(payments),
        "plan_mix": dashboard.plan_mix(payments),
        "tier_scatter": dashboard.tier_scatter(summary, s.agents),
        "agent_scorecard": scorecard,
        "agent_kpis": dashboard.agent_kpis(scorecard),
        "churn_waterfall": dashboard.churn_waterfall(churn),
        "churn_rate_by_plan": dashboard.churn_rate_by_plan(churn, s.policies),
        "churn_monthly": dashboard.churn_monthly(churn),
        "churn_by_state": dashboard.churn_by_state(churn, s.members),
        "risk_by_state": dashboard.risk_by_state(risk),
        "early_cancel_watchlist": dashboard.early_cancel_watchlist(churn),
        "freshness": dashboard.freshness(store.between("fct_payments", end=as_of), "due_date", as_of),
        **(
            {"load_freshness": dashboard.freshness(store.read(BATCHES), VERSION, now or as_of)}
            if store.exists(BATCHES) else {}
        ),
    }
