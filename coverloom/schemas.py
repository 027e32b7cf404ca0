"""Raw table schemas and the fixed business values every layer shares."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(12, 2)
RATE = DecimalType(5, 4)
PERCENT = DecimalType(18, 2)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


_S, _D, _B, _L = StringType(), DateType(), BooleanType(), LongType()

# The raw tables' column names, in their order.
AGENTS = _table(
    agent_id=_S, agent_name=_S, agency_name=_S, state=_S, email=_S, phone=_S,
    hire_date=_D, is_active=_B, tier=_S,
)

# zip_code is text: as a number 00501 would lose its zeros.
MEMBERS = _table(
    member_id=_S, first_name=_S, last_name=_S, email=_S, phone=_S, dob=_D, state=_S,
    zip_code=_S, enrollment_date=_D, agent_id=_S, carrier=_S, plan_type=_S,
)

POLICIES = _table(
    policy_id=_S, member_id=_S, agent_id=_S, carrier=_S, plan_type=_S, effective_date=_D,
    expiry_date=_D, monthly_premium=MONEY, annual_premium=MONEY, commission_rate=RATE,
    monthly_commission=MONEY, status=_S, term_months=_L,
)

PAYMENTS = _table(
    payment_id=_S, policy_id=_S, member_id=_S, due_date=_D, paid_date=_D, amount_due=MONEY,
    amount_paid=MONEY, payment_status=_S, payment_method=_S, carrier=_S, plan_type=_S,
)

CANCELLATIONS = _table(
    cancellation_id=_S, policy_id=_S, member_id=_S, agent_id=_S, cancellation_date=_D,
    cancellation_reason=_S, months_active=_L, lifetime_value=MONEY, carrier=_S, plan_type=_S,
    was_payment_failure=_B,
)

RAW_SCHEMAS = {
    "agents": AGENTS,
    "members": MEMBERS,
    "policies": POLICIES,
    "payments": PAYMENTS,
    "cancellations": CANCELLATIONS,
}

# The labels and rates the business rules are written in.
TIERS = ("bronze", "silver", "gold", "platinum")
TIER_RANK = {"bronze": 1, "silver": 2, "gold": 3, "platinum": 4}
PLAN_TYPES = ("Dental Basic", "Dental Premium", "Vision Basic", "Vision Premium", "Dental+Vision Bundle")
POLICY_STATUSES = ("active", "cancelled", "expired", "pending")
PAYMENT_STATUSES = ("paid", "paid_late", "failed")
COLLECTION_STATUSES = ("collected_on_time", "collected_late", "uncollected")
CANCELLATION_REASONS = (
    "non_payment", "member_request", "employer_change", "moved_out_of_area", "plan_upgrade", "deceased",
)
INVOLUNTARY_REASONS = ("non_payment", "deceased")
CHURN_TYPES = ("voluntary", "involuntary")
AGE_BUCKETS = ((30, "under_30"), (45, "30_to_44"), (60, "45_to_59"))
OLDEST_BUCKET = "60_plus"
EARLY_CANCEL_MONTHS = 3
LIST_PREMIUMS = {
    "Dental Basic": Decimal("29.99"),
    "Dental Premium": Decimal("54.99"),
    "Vision Basic": Decimal("19.99"),
    "Vision Premium": Decimal("34.99"),
    "Dental+Vision Bundle": Decimal("74.99"),
}
COMMISSION_RATES = {
    "Dental Basic": Decimal("0.18"),
    "Dental Premium": Decimal("0.22"),
    "Vision Basic": Decimal("0.16"),
    "Vision Premium": Decimal("0.20"),
    "Dental+Vision Bundle": Decimal("0.25"),
}
