from datetime import date
from decimal import Decimal

from conftest import AS_OF, one, rows

from coverloom.operators.terms import billing_schedule, cancellation_terms, policy_terms


def test_schedule_includes_both_ends(staged):
    s = staged(policies=[dict()])  # 2023-02-01 to 2024-02-01
    got = rows(billing_schedule(s.policies, AS_OF), "instalment", "due_date")
    assert len(got) == 13
    assert (1, date(2023, 2, 1)) in got and (13, date(2024, 2, 1)) in got


def test_schedule_stops_at_the_limit(staged):
    assert billing_schedule(staged().policies, date(2023, 4, 30)).count() == 3
    assert billing_schedule(staged().policies, date(2023, 2, 1)).count() == 1


def test_schedule_skips_pending_and_not_yet_effective(staged):
    s = staged(policies=[
        dict(policy_id="pending", status="Pending"),
        dict(policy_id="later", effective_date=date(2025, 1, 1), expiry_date=date(2026, 1, 1)),
        dict(policy_id="cancelled", status="Cancelled"),
        dict(policy_id="unknown", status=None),
    ])
    got = {r.policy_id for r in billing_schedule(s.policies, AS_OF).collect()}
    assert got == {"cancelled", "unknown"}


def test_policy_terms(spark):
    signed = spark.createDataFrame(
        [(date(2023, 1, 31), "Dental Basic", 12, Decimal("29.99")), (date(2023, 12, 1), "Vision Basic", 6, Decimal("20.03"))],
        "signed_on date, plan_type string, term_months long, monthly_premium decimal(12,2)",
    )
    got = rows(
        policy_terms(signed), "effective_date", "expiry_date", "annual_premium", "commission_rate", "monthly_commission"
    )
    assert got == [
        (date(2023, 2, 1), date(2024, 2, 1), Decimal("359.88"), Decimal("0.1800"), Decimal("5.40")),
        (date(2024, 1, 1), date(2024, 7, 1), Decimal("240.36"), Decimal("0.1600"), Decimal("3.20")),
    ]


def test_cancellation_terms(spark):
    def terms(day, reason="Non_Payment"):
        frame = spark.createDataFrame(
            [(date(2023, 1, 1), day, Decimal("30.00"), reason)],
            "effective_date date, cancellation_date date, monthly_premium decimal(12,2), cancellation_reason string",
        )
        row = one(cancellation_terms(frame))
        return row.months_active, row.lifetime_value, row.was_payment_failure

    assert terms(date(2023, 1, 31)) == (1, Decimal("30.00"), True)
    assert terms(date(2023, 1, 5)) == (1, Decimal("30.00"), True)  # a started month counts
    assert terms(date(2023, 4, 30), "deceased") == (3, Decimal("90.00"), False)  # 119 days
    assert terms(date(2023, 5, 1)) == (4, Decimal("120.00"), True)
