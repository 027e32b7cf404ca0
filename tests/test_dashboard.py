from datetime import date, datetime
from decimal import Decimal

import pytest

from conftest import AS_OF, one, rows

from coverloom.operators.slicing import agent_book, calendar_year, payments_of_agent, slice_by
from coverloom.plans import analyst, dashboard, marts

D = Decimal


def test_month_helpers():
    assert dashboard.month_start(date(2024, 6, 15), 23) == date(2022, 7, 1)
    assert dashboard.month_start(date(2024, 1, 31), 1) == date(2023, 12, 1)
    assert dashboard.month_end(date(2024, 2, 5)) == date(2024, 2, 29)
    assert dashboard.month_end(date(2024, 12, 5)) == date(2024, 12, 31)


def test_exec_kpis(staged):
    s = staged(
        policies=[
            dict(policy_id="P1"), dict(policy_id="P2"), dict(policy_id="P3", member_id="M2"),
            dict(policy_id="P4", member_id="M3", status="expired"),
        ],
        payments=[
            dict(payment_id="1"), dict(payment_id="2", due_date=date(2024, 1, 1)),
            dict(payment_id="3", payment_status="failed", amount_paid=D(0), due_date=date(2024, 6, 30)),
            dict(payment_id="4", due_date=date(2023, 12, 31)), dict(payment_id="5", due_date=date(2024, 7, 1)),
        ],
    )
    row = one(dashboard.exec_kpis(marts.priced_payments(s), s.policies, AS_OF))
    assert tuple(row) == (2, D("60.00"), D("30.00"), D("50.00"), D("16.20"))


def test_exec_kpis_without_billing(staged):
    s = staged(payments=[dict(due_date=date(2020, 1, 1))])
    assert tuple(one(dashboard.exec_kpis(marts.priced_payments(s), s.policies, AS_OF))) == (1, None, None, None, None)


def test_collection_trend_is_24_calendar_months(staged):
    days = [date(2022, 6, 30), date(2022, 7, 1), date(2024, 6, 30), date(2024, 7, 1)]
    s = staged(payments=[dict(payment_id=str(d), due_date=d) for d in days])
    assert rows(dashboard.collection_trend(s.payments, AS_OF), "due_period") == [("2022-07",), ("2024-06",)]


def test_mixes(staged):
    s = staged(payments=[
        dict(payment_id="1", amount_paid=D("10.00")), dict(payment_id="2", plan_type="Vision Basic", carrier="Zurich"),
    ])
    assert [tuple(r) for r in dashboard.plan_mix(s.payments).collect()] == [
        ("Vision Basic", D("30.00"), D("75.00")), ("Dental Basic", D("10.00"), D("25.00")),
    ]
    assert [tuple(r) for r in dashboard.carrier_month(s.payments).collect()] == [
        ("2024-06", "VSP", D("10.00")), ("2024-06", "Zurich", D("30.00")),
    ]


def book(staged):
    agents = ["A1", "A2", "A3"]
    s = staged(
        agents=[dict(agent_id=a, is_active=a != "A3", tier="Silver" if a == "A3" else "Gold") for a in agents],
        members=[dict(member_id=f"M{a}", agent_id=a) for a in agents[:2]],
        policies=[
            dict(policy_id="P1", member_id="MA1"), dict(policy_id="P2", agent_id="A2", member_id="MA2", status="cancelled"),
            dict(policy_id="P3", member_id="MA1"),
        ],
        payments=[
            dict(payment_id="1", member_id="MA1"),
            dict(payment_id="2", member_id="MA2", policy_id="P2"),
            dict(payment_id="3", member_id="MA2", policy_id="P2", payment_status="failed", amount_paid=D(0)),
        ],
        cancellations=[dict(policy_id="P2", agent_id="A2", member_id="MA2")],
    )
    return s, dashboard.agent_scorecard(
        marts.agent_commission_summary_monthly(s), marts.dim_agents(s), s.policies, AS_OF
    )


def test_scorecard(staged):
    _, card = book(staged)
    assert rows(
        card, "agent_id", "active_members", "ytd_commission", "collection_rate_pct", "failure_rate_pct",
        "total_churns", "flag", "is_high_churn",
    ) == [
        ("A1", 1, D("5.40"), D("100.00"), D("0.00"), 0, "green", False),
        ("A2", 0, D("5.40"), D("50.00"), D("50.00"), 1, "red", True),
        ("A3", 0, D("0.00"), None, None, 0, None, False),
    ]
    assert tuple(one(dashboard.agent_kpis(card))) == (2, D("5.40"), D("50.00"))


def test_scorecard_with_given_limit(staged):
    s, _ = book(staged)
    card = dashboard.agent_scorecard(
        marts.agent_commission_summary_monthly(s), marts.dim_agents(s), s.policies, AS_OF, high_churn_pct=100.0
    )
    assert card.filter("is_high_churn").count() == 0


def test_tier_scatter(staged):
    s, _ = book(staged)
    got = rows(dashboard.tier_scatter(marts.agent_commission_summary(s), s.agents))
    assert got == [("gold", 3, D("75.00"), 2)]


def test_waterfall_order(staged):
    reasons = ["deceased", "NON_PAYMENT", "plan_upgrade", "something new", "member_request"]
    s = staged(cancellations=[dict(cancellation_id=r, cancellation_reason=r) for r in reasons])
    got = [(r.reason_rank, r.cancellation_reason) for r in dashboard.churn_waterfall(s.cancellations).collect()]
    assert got == [
        (1, "non_payment"), (2, "member_request"), (5, "plan_upgrade"), (6, "deceased"), (7, "something new"),
    ]


def test_churn_rates_keep_one_sided_and_null_keys(staged):
    s = staged(
        members=[dict(member_id="M1"), dict(member_id="M2"), dict(member_id="M3", state=None)],
        policies=[
            dict(policy_id="P1"), dict(policy_id="P2"), dict(policy_id="P3", plan_type="Vision Basic"),
            dict(policy_id="P4", plan_type=None),
        ],
        cancellations=[
            dict(cancellation_id="1"), dict(cancellation_id="2", plan_type="old plan", member_id="gone"),
            dict(cancellation_id="3", plan_type=None, member_id="M3"),
        ],
    )
    assert rows(dashboard.churn_rate_by_plan(s.cancellations, s.policies)) == [
        ("Dental Basic", 1, 2, D("50.00")), ("Vision Basic", 0, 1, D("0.00")), ("old plan", 1, 0, None),
        (None, 1, 1, D("100.00")),
    ]
    assert rows(dashboard.churn_by_state(s.cancellations, s.members)) == [
        ("OH", 1, 2, D("50.00")), (None, 2, 1, D("200.00")),
    ]


def test_churn_monthly_and_watchlist(staged):
    s = staged(cancellations=[
        dict(cancellation_id="1", months_active=2), dict(cancellation_id="2"),
        dict(cancellation_id="3", cancellation_reason="plan_upgrade", months_active=3),
    ])
    assert rows(dashboard.churn_monthly(s.cancellations)) == [
        ("2024-06", "involuntary", 2, 1, D("50.00")), ("2024-06", "voluntary", 1, 1, D("100.00")),
    ]
    watch = dashboard.early_cancel_watchlist(marts.fct_member_churn(s))
    assert rows(watch, "cancellation_id", "member_name", "agent_name", "months_active", "reason", "ltv_lost") == [
        ("1", "Mia Member", "Ann Agent", 2, "non_payment", D("150.00")),
        ("3", "Mia Member", "Ann Agent", 3, "plan_upgrade", D("150.00")),
    ]


@pytest.mark.parametrize(
    ("due", "age", "stale"),
    [(date(2024, 6, 14), 24, False), (date(2024, 6, 13), 48, True), (AS_OF, 0, False), (date(2024, 7, 1), None, True)],
)
def test_freshness(staged, due, age, stale):
    row = one(dashboard.freshness(staged(payments=[dict(due_date=due)]).payments, "due_date", AS_OF))
    assert (row.age_hours, row.is_stale) == (age, stale)


@pytest.mark.parametrize(("hour", "stale"), [(13, False), (11, True)])
def test_freshness_of_a_load_time(spark, hour, stale):
    loads = spark.createDataFrame([(datetime(2024, 6, 14, hour),), (datetime(2024, 6, 1),)], "loaded_at timestamp")
    assert one(dashboard.freshness(loads, "loaded_at", datetime(2024, 6, 15, 12))).is_stale is stale


def test_slicers_combine_and_default_to_everything(staged):
    s = staged(
        agents=[dict(agent_id="A1"), dict(agent_id="A2", tier="Bronze")],
        members=[dict(member_id="M1"), dict(member_id="M2", agent_id="A2", state="tx")],
        payments=[
            dict(payment_id="1"), dict(payment_id="2", member_id="M2"), dict(payment_id="3", carrier="Zurich"),
            dict(payment_id="4", due_date=date(2024, 7, 1)),
        ],
    )
    fact = marts.fct_payments(s)

    def ids(**wanted):
        return [r[0] for r in rows(slice_by(fact, **wanted), "payment_id")]

    assert ids() == ["1", "2", "3", "4"]
    assert ids(carriers=["VSP"], tiers=["gold"]) == ["1", "4"]
    assert ids(states=["TX"]) == ["2"]
    assert ids(date_column="due_date", start=date(2024, 6, 1), end=date(2024, 6, 1)) == ["1", "2", "3"]
    assert ids(plan_types=[]) == []


def test_agent_sees_own_book_only(staged):
    s = staged(
        agents=[dict(agent_id="A1"), dict(agent_id="A2", email="bea@x.com")],
        members=[dict(member_id="M1"), dict(member_id="M2", agent_id="A2")],
        payments=[dict(payment_id="1"), dict(payment_id="2", member_id="M2"), dict(payment_id="3", member_id="gone")],
    )
    fact = marts.fct_payments(s)
    assert rows(agent_book(fact, s.agents, "Bea@X.com"), "payment_id") == [("2",)]
    assert agent_book(fact, s.agents, "nobody@x.com").count() == 0
    assert rows(marts.fct_payments(payments_of_agent(s, "Bea@X.com"))) == rows(agent_book(fact, s.agents, "bea@x.com"))


def test_risk_by_state(staged):
    s = staged(
        members=[dict(member_id="M1"), dict(member_id="M2"), dict(member_id="M3", state="tx")],
        payments=[
            dict(payment_id=f"{m}{i}", member_id=m, payment_status="failed")
            for m, n in (("M1", 1), ("M2", 1), ("M3", 2)) for i in range(n)
        ],
    )
    risk = analyst.churn_risk(s.payments, s.members, s.agents, AS_OF)
    assert rows(dashboard.risk_by_state(risk)) == [("OH", "medium_risk", 2), ("TX", "high_risk", 1)]


def test_calendar_year_changes_nothing_but_the_scan(staged):
    days = [date(2023, 12, 31), date(2024, 1, 1), date(2024, 12, 31), date(2025, 1, 1)]
    s = staged(payments=[dict(payment_id=str(d), due_date=d) for d in days])
    year = calendar_year(s, AS_OF)
    assert rows(year.payments, "due_date") == [(d,) for d in days[1:3]]
    assert rows(analyst.top_agents(marts.agent_commission_summary(year), AS_OF)) == rows(
        analyst.top_agents(marts.agent_commission_summary(s), AS_OF)
    )
