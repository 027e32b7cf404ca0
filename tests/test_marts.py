from datetime import date
from decimal import Decimal

from conftest import one, rows

from coverloom.plans import marts

D = Decimal


def test_dim_agents_totals_and_empty_agent(staged):
    s = staged(
        agents=[dict(agent_id="A1"), dict(agent_id="A2")],
        members=[dict(member_id="M1"), dict(member_id="M2")],
        policies=[
            dict(policy_id="P1", status="Active"), dict(policy_id="P2", status="Cancelled"),
            dict(policy_id="P3", status="cancelled"),
        ],
        cancellations=[dict(cancellation_id="C1"), dict(cancellation_id="C2", cancellation_reason="plan_upgrade")],
    )
    got = {r.agent_id: r for r in marts.dim_agents(s).collect()}
    a1, a2 = got["A1"], got["A2"]
    assert (a1.total_members, a1.total_policies, a1.active_policies, a1.cancelled_policies) == (2, 3, 1, 2)
    assert (a1.total_monthly_premium, a1.total_annual_commission) == (D("90.00"), D("194.40"))
    assert (a1.total_cancellations, a1.involuntary_cancellations) == (2, 1)
    assert a1.cancellation_rate_pct == D("66.67")
    assert (a2.total_policies, a2.total_monthly_premium, a2.total_cancellations) == (0, 0, 0)
    assert a2.cancellation_rate_pct is None


def test_payment_without_policy_member_or_agent_stays(staged):
    s = staged(
        members=[dict(member_id="M1"), dict(member_id="M2", agent_id="gone")],
        payments=[
            dict(payment_id="ok"),
            dict(payment_id="no policy", policy_id="gone"),
            dict(payment_id="no policy, failed", policy_id="gone", payment_status="failed"),
            dict(payment_id="no member", member_id="gone"),
            dict(payment_id="no agent", member_id="M2"),
        ],
    )
    got = {r.payment_id: r for r in marts.fct_payments(s).collect()}
    assert len(got) == 5
    assert got["ok"].commission_earned == D("5.40") and got["ok"].agent_tier == "gold"
    assert got["no policy"].commission_earned is None
    assert got["no policy, failed"].commission_earned == 0
    assert got["no member"].agent_id is None and got["no member"].commission_earned == D("5.40")
    assert got["no agent"].agent_id == "gone" and got["no agent"].agent_name is None


def test_collection_status_and_commission_of_unknown_status(staged):
    s = staged(payments=[
        dict(payment_id="1", payment_status="Paid"), dict(payment_id="2", payment_status="Paid_Late"),
        dict(payment_id="3", payment_status="Failed"), dict(payment_id="4", payment_status=None),
    ])
    assert rows(marts.fct_payments(s), "payment_id", "collection_status", "commission_earned") == [
        ("1", "collected_on_time", D("5.40")), ("2", "collected_late", D("5.40")),
        ("3", "uncollected", D("0.00")), ("4", "collected_on_time", D("0.00")),
    ]


def test_commission_is_rounded_per_payment(staged):
    s = staged(
        policies=[dict(commission_rate=D("0.1850"))],
        payments=[dict(payment_id="1", amount_paid=D("0.27")), dict(payment_id="2", amount_paid=D("0.27"))],
    )
    # 0.04995 rounds to 0.05 each; the sum 0.0999 would round to 0.10 too, 3 of them would not.
    assert [r.commission_earned for r in marts.fct_payments(s).collect()] == [D("0.05"), D("0.05")]


def test_agent_of_payment_and_of_churn_may_differ(staged):
    s = staged(
        agents=[dict(agent_id="A1"), dict(agent_id="A2", agent_name="Bea")],
        policies=[dict(agent_id="A3")],
        cancellations=[dict(agent_id="A2")],
    )
    assert one(marts.fct_payments(s)).agent_id == "A1"
    churn = one(marts.fct_member_churn(s))
    assert (churn.agent_id, churn.agent_name) == ("A2", "Bea")


def test_churn_last_payment(staged):
    s = staged(
        policies=[dict(policy_id="P1"), dict(policy_id="P2"), dict(policy_id="P3")],
        payments=[
            dict(payment_id="1", paid_date=date(2024, 4, 30)),
            dict(payment_id="2", paid_date=date(2024, 5, 31)),
            dict(payment_id="3", paid_date=date(2024, 6, 9), payment_status="failed"),
            dict(payment_id="4", policy_id="P2", payment_status="failed", paid_date=None),
            dict(payment_id="5", policy_id="P3", paid_date=date(2024, 8, 1)),
            dict(payment_id="6", policy_id="P1", payment_status=None, paid_date=date(2024, 6, 9)),
        ],
        cancellations=[
            dict(cancellation_id="C1"), dict(cancellation_id="C2", policy_id="P2"),
            dict(cancellation_id="C3", policy_id="P3"), dict(cancellation_id="C4", policy_id="gone"),
        ],
    )
    churn = marts.fct_member_churn(s)
    assert rows(churn, "cancellation_id", "last_paid_date", "months_since_last_payment", "annualized_revenue_lost") == [
        ("C1", date(2024, 5, 31), 1, D("360.00")),
        ("C2", None, None, D("360.00")),
        ("C3", date(2024, 8, 1), -2, D("360.00")),
        ("C4", None, None, None),
    ]


def two_carriers(staged):
    """Agent A1 bills under two carriers in June; churn in June and, without billing, in July."""
    return staged(
        members=[dict(member_id="M1"), dict(member_id="M2")],
        payments=[
            dict(payment_id="1", carrier="VSP"),
            dict(payment_id="2", carrier="VSP", payment_status="Failed", amount_paid=D(0)),
            dict(payment_id="3", carrier="Zurich"),
            dict(payment_id="4", carrier="Zurich", member_id="M2", payment_status="paid_late"),
        ],
        cancellations=[
            dict(cancellation_id="C1"),
            dict(cancellation_id="C2", cancellation_date=date(2024, 7, 1), cancellation_reason="plan_upgrade"),
        ],
    )


def test_summary_repeats_churn_per_carrier_and_loses_unbilled_months(staged):
    summary = marts.agent_commission_summary(two_carriers(staged))
    assert rows(
        summary, "carrier", "period", "total_payments_due", "paid_on_time", "paid_late", "payments_failed",
        "active_members_billed", "members_churned", "involuntary_churns", "revenue_lost_to_churn",
        "collection_rate_pct", "failure_rate_pct",
    ) == [
        ("VSP", "2024-06", 2, 1, 0, 1, 1, 1, 1, D("360.00"), D("50.00"), D("50.00")),
        ("Zurich", "2024-06", 2, 1, 1, 0, 2, 1, 1, D("360.00"), D("100.00"), D("0.00")),
    ]


def test_monthly_summary_counts_churn_once(staged):
    summary = marts.agent_commission_summary_monthly(two_carriers(staged))
    assert rows(
        summary, "period", "year", "month", "total_payments_due", "active_members_billed", "total_amount_due",
        "members_churned", "involuntary_churns", "collection_rate_pct", "failure_rate_pct",
    ) == [
        ("2024-06", 2024, 6, 4, 2, D("120.00"), 1, 1, D("75.00"), D("25.00")),
        ("2024-07", 2024, 7, 0, 0, D("0.00"), 1, 0, None, None),
    ]


def test_payments_without_agent_form_one_group(staged):
    s = staged(payments=[dict(payment_id="1", member_id="x"), dict(payment_id="2", member_id="y")])
    row = one(marts.agent_commission_summary(s))
    assert (row.agent_id, row.total_payments_due, row.active_members_billed, row.members_churned) == (None, 2, 2, 0)


def test_summary_with_nothing_due_has_no_collection_rate(staged):
    s = staged(payments=[dict(amount_due=D(0), amount_paid=D(0))])
    assert one(marts.agent_commission_summary(s)).collection_rate_pct is None


def test_summary_from_stored_fact_is_the_same(staged):
    s = two_carriers(staged)
    churned = marts.churned_by_agent(marts.fct_member_churn(s))
    fact = marts.fct_payments(s)
    by_carrier = marts.commission_summary(marts.billed_by_agent_from_fact(fact, "carrier"), churned, s.agents)
    by_month = marts.commission_summary_monthly(marts.billed_by_agent_from_fact(fact), churned, s.agents)
    assert rows(by_carrier) == rows(marts.agent_commission_summary(s))
    assert rows(by_month) == rows(marts.agent_commission_summary_monthly(s))
