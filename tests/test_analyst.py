from datetime import date, timedelta
from decimal import Decimal

import pytest

from conftest import AS_OF, one, rows

from coverloom.plans import analyst, marts

D = Decimal


def test_monthly_revenue(staged):
    s = staged(payments=[
        dict(payment_id="1"), dict(payment_id="2", payment_status="failed", amount_paid=D(0)),
        dict(payment_id="3", due_date=date(2024, 5, 1)),
    ])
    assert [tuple(r) for r in analyst.monthly_revenue(s.payments).collect()] == [
        ("2024-05", 2024, 5, D("30.00"), D("30.00"), D("0.00"), 0, D("100.00"), D("0.00")),
        ("2024-06", 2024, 6, D("60.00"), D("30.00"), D("30.00"), 1, D("50.00"), D("50.00")),
    ]


def test_top_agents_year_order_and_limit(staged):
    ids = ["A1", "A2", "A3"]
    s = staged(
        agents=[dict(agent_id=a) for a in ids],
        members=[dict(member_id=f"M{a}", agent_id=a) for a in ids],
        payments=[
            dict(payment_id="1", member_id="MA1"),
            dict(payment_id="2", member_id="MA2"),
            dict(payment_id="3", member_id="MA3", amount_paid=D("60.00")),
            dict(payment_id="4", member_id="MA1", due_date=date(2023, 12, 31), amount_paid=D("900.00")),
        ],
    )
    summary = marts.agent_commission_summary(s)
    got = [(r.agent_id, r.ytd_commission) for r in analyst.top_agents(summary, AS_OF, 2).collect()]
    assert got == [("A3", D("10.80")), ("A1", D("5.40"))]  # A1 and A2 tie: the id decides


def test_top_agents_mean_of_monthly_rates_is_unweighted(staged):
    s = staged(payments=[
        dict(payment_id="1", due_date=date(2024, 1, 1)),
        dict(payment_id="2", due_date=date(2024, 2, 1), payment_status="failed", amount_paid=D(0)),
        dict(payment_id="3", due_date=date(2024, 2, 1)),
        dict(payment_id="4", due_date=date(2024, 2, 1)),
    ])
    row = one(analyst.top_agents(marts.agent_commission_summary(s), AS_OF))
    assert row.avg_collection_rate == D("83.34")  # (100 + 66.67) / 2, a tie
    assert row.avg_failure_rate == D("16.67")
    assert row.avg_active_members == 2


def test_churn_by_reason(staged):
    s = staged(cancellations=[
        dict(cancellation_id="1", months_active=3), dict(cancellation_id="2", months_active=4),
        dict(cancellation_id="3", months_active=4), dict(cancellation_id="4", months_active=4),
        dict(cancellation_id="5", cancellation_reason=None),
    ])
    got = [tuple(r) for r in analyst.churn_by_reason(marts.priced_cancellations(s)).collect()]
    assert got == [
        ("Dental Basic", "non_payment", "involuntary", 4, D("3.80"), D("600.00"), D("1440.00"), 1, D("25.00")),
        ("Dental Basic", None, "voluntary", 1, D("5.00"), D("150.00"), D("360.00"), 0, D("0.00")),
    ]


def test_eligibility_gap_window_has_no_upper_bound(staged):
    def due(days):
        return AS_OF - timedelta(days=days)

    members = {"60 days": due(60), "61 days": due(61), "future": due(-400), "failed": due(1)}
    s = staged(
        payments=[
            dict(payment_id=m, member_id=m, due_date=d, payment_status="failed" if m == "failed" else "paid")
            for m, d in members.items()
        ],
        cancellations=[dict(cancellation_id=m, member_id=m) for m in [*members, "never billed", None]],
    )
    got = rows(analyst.eligibility_gap(s.payments, s.cancellations, AS_OF), "member_id")
    assert got == [("61 days",), ("failed",), ("never billed",), (None,)]


def test_eligibility_gap_reasons_in_order(staged):
    s = staged(
        payments=[dict(member_id="someone")],
        cancellations=[
            dict(cancellation_id="C3", cancellation_date=date(2024, 6, 1), cancellation_reason="deceased"),
            dict(cancellation_id="C2", cancellation_date=date(2024, 5, 1), cancellation_reason="plan_upgrade"),
            dict(cancellation_id="C1", cancellation_date=date(2024, 5, 1), cancellation_reason="non_payment"),
            dict(cancellation_id="C4", cancellation_date=date(2024, 5, 2), cancellation_reason=None),
            dict(cancellation_id="C5", member_id="M9", cancellation_reason=None),
        ],
    )
    got = analyst.eligibility_gap(s.payments, s.cancellations, AS_OF).collect()
    assert [tuple(r) for r in got] == [
        ("M9", date(2024, 6, 10), None, 5, "eligibility_gap"),
        ("M1", date(2024, 6, 1), "non_payment, plan_upgrade, deceased", 14, "eligibility_gap"),
    ]


@pytest.mark.parametrize(
    ("failed", "late", "tier"),
    [(2, 0, "high_risk"), (1, 0, "medium_risk"), (0, 2, "medium_risk"), (1, 3, "medium_risk"), (0, 1, None), (0, 0, None)],
)
def test_risk_tier(staged, failed, late, tier):
    statuses = ["failed"] * failed + ["paid_late"] * late + ["paid"]
    s = staged(payments=[dict(payment_id=str(i), payment_status=p) for i, p in enumerate(statuses)])
    got = analyst.churn_risk(s.payments, s.members, s.agents, AS_OF).collect()
    assert [r.churn_risk_tier for r in got] == ([tier] if tier else [])


def test_risk_window_and_unknown_member(staged):
    since = AS_OF - timedelta(days=90)
    s = staged(payments=[
        dict(payment_id="1", payment_status="failed", due_date=since),
        dict(payment_id="2", payment_status="failed", due_date=since - timedelta(days=1)),
        dict(payment_id="3", payment_status="failed", member_id="gone"),
        dict(payment_id="4", member_id="gone"), dict(payment_id="5", member_id="gone"),
    ])
    got = rows(
        analyst.churn_risk(s.payments, s.members, s.agents, AS_OF), "member_id", "agent_id", "payments_last_90d",
        "failures_last_90d", "most_recent_due_date", "failure_rate_pct",
    )
    assert got == [
        ("M1", "A1", 1, 1, since, D("100.00")), ("gone", None, 3, 1, date(2024, 6, 1), D("33.30")),
    ]


def test_carrier_revenue(staged):
    s = staged(payments=[
        dict(payment_id="1"), dict(payment_id="2", member_id="M2"), dict(payment_id="3", carrier="Zurich"),
        dict(payment_id="4", due_date=date(2023, 1, 1), payment_status="failed", amount_paid=D(0)),
    ])
    got = [tuple(r) for r in analyst.carrier_revenue(marts.priced_payments(s)).collect()]
    assert got == [
        ("VSP", 2024, 2, D("60.00"), D("60.00"), D("10.80"), D("100.00")),
        ("Zurich", 2024, 1, D("30.00"), D("30.00"), D("5.40"), D("100.00")),
        ("VSP", 2023, 1, D("30.00"), D("0.00"), D("0.00"), D("0.00")),
    ]
