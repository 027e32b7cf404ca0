from datetime import date
from decimal import Decimal

import pytest

from conftest import AS_OF, one, rows


def test_agents_are_cleaned(staged):
    agent = one(staged(agents=[dict(agent_name="\t Ann \n", agency_name=" Best, Co ", tier="PLATINUM")]).agents)
    assert (agent.agent_name, agent.agency_name, agent.state) == ("Ann", "Best, Co", "IN")
    assert (agent.email, agent.tier, agent.tier_rank) == ("ann@example.com", "platinum", 4)
    assert agent.months_tenure == 53  # 2020-01-31 to 2024-06-15


@pytest.mark.parametrize(("tier", "rank"), [("gold", 3), ("Silver", 2), ("bronze", 1), ("other", 1), (None, 1)])
def test_tier_rank(staged, tier, rank):
    assert one(staged(agents=[dict(tier=tier)]).agents).tier_rank == rank


def test_member_name_is_null_if_a_part_is(staged):
    s = staged(members=[dict(member_id="M1"), dict(member_id="M2", last_name=None)])
    assert rows(s.members, "member_id", "full_name") == [("M1", "Mia Member"), ("M2", None)]


@pytest.mark.parametrize(
    ("dob", "bucket"),
    [
        (date(1994, 12, 31), "30_to_44"),  # 30 by calendar years, though still 29
        (date(1995, 1, 1), "under_30"),
        (date(1979, 5, 5), "45_to_59"),
        (date(1964, 5, 5), "60_plus"),
        (None, "60_plus"),
    ],
)
def test_age_bucket(staged, dob, bucket):
    assert one(staged(members=[dict(dob=dob)]).members).age_bucket == bucket


@pytest.mark.parametrize(
    ("plan", "category"),
    [
        ("Dental+Vision Bundle", "bundle"), ("Dental Basic", "dental"), ("Vision Premium", "vision"),
        ("dental basic", "vision"), (None, "vision"),
    ],
)
def test_plan_category(staged, plan, category):
    assert one(staged(members=[dict(plan_type=plan)]).members).plan_category == category


def test_zip_code_keeps_zeros(staged):
    assert one(staged().members).zip_code == "00501"


@pytest.mark.parametrize(
    ("status", "start", "end", "eligible"),
    [
        ("Active", AS_OF, date(2025, 1, 1), True),
        ("ACTIVE", date(2023, 1, 1), AS_OF, True),
        ("active", date(2024, 6, 16), date(2025, 1, 1), False),
        ("active", date(2023, 1, 1), date(2024, 6, 14), False),
        ("expired", date(2023, 1, 1), date(2025, 1, 1), False),
        (None, date(2023, 1, 1), date(2025, 1, 1), False),
        ("active", None, date(2025, 1, 1), False),
    ],
)
def test_eligibility_includes_both_ends(staged, status, start, end, eligible):
    policy = one(staged(policies=[dict(status=status, effective_date=start, expiry_date=end)]).policies)
    assert policy.is_currently_eligible is eligible


def test_policy_amounts(staged):
    policy = one(staged().policies)
    assert policy.annual_commission == Decimal("64.80")
    assert policy.policy_duration_days == 365


def test_payment_flags(staged):
    s = staged(payments=[
        dict(payment_id="a", payment_status="FAILED", paid_date=None, amount_paid=Decimal(0)),
        dict(payment_id="b", payment_status="Paid_Late", paid_date=date(2024, 7, 1)),
        dict(payment_id="c", payment_status=None),
    ])
    got = rows(s.payments, "payment_id", "payment_status", "is_failed", "is_late", "days_to_pay", "payment_gap")
    assert got == [
        ("a", "failed", True, False, None, Decimal("30.00")),
        ("b", "paid_late", False, True, 30, Decimal("0.00")),
        ("c", None, False, False, 1, Decimal("0.00")),
    ]
    assert rows(s.payments, "due_year", "due_month", "due_period")[0] == (2024, 6, "2024-06")


@pytest.mark.parametrize(
    ("reason", "kind"),
    [("Non_Payment", "involuntary"), ("deceased", "involuntary"), ("plan_upgrade", "voluntary"), (None, "voluntary")],
)
def test_churn_type(staged, reason, kind):
    assert one(staged(cancellations=[dict(cancellation_reason=reason)]).cancellations).churn_type == kind


@pytest.mark.parametrize(("months", "early"), [(3, True), (4, False), (None, False)])
def test_early_cancel(staged, months, early):
    assert one(staged(cancellations=[dict(months_active=months)]).cancellations).is_early_cancel is early


def test_staging_keeps_every_row(staged):
    s = staged(payments=[dict(payment_id=None, due_date=None, payment_status=None)] * 3)
    assert s.payments.count() == 3


def test_views_answer_sql(spark, staged):
    staged().register_views()
    assert spark.sql("select count(*) n from stg_payments p join stg_members m using (member_id)").collect()[0].n == 1
