"""Contract arithmetic: policy terms, cancellation terms and the billing schedule."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.functions import day_gap, lookup, money
from coverloom.schemas import COMMISSION_RATES, MONEY, RATE


def policy_terms(signed: DataFrame) -> DataFrame:
    """Adds dates and amounts to rows with signed_on, plan_type, term_months, monthly_premium.

    Cover starts on the first of the month after signing.
    """
    starts = F.trunc(F.add_months("signed_on", 1), "MM")
    rate = lookup(F.col("plan_type"), COMMISSION_RATES).cast(RATE)
    return (
        signed.withColumn("effective_date", starts)
        .withColumn("commission_rate", rate)
        .withColumns({
            "expiry_date": F.add_months("effective_date", F.col("term_months").cast("int")),
            "annual_premium": money(F.col("monthly_premium") * 12),
            "monthly_commission": money(F.col("monthly_premium") * F.col("commission_rate")),
        })
    )


def cancellation_terms(cancelled: DataFrame) -> DataFrame:
    """Adds months_active, lifetime_value, was_payment_failure to rows with effective_date,
    cancellation_date, monthly_premium, cancellation_reason. A started month counts as one."""
    days = day_gap(F.col("cancellation_date"), F.col("effective_date"))
    months = F.greatest(F.lit(1).cast("bigint"), F.floor(days / 30))
    return cancelled.withColumn("months_active", months).withColumns({
        "lifetime_value": money(F.col("monthly_premium") * F.col("months_active")),
        "was_payment_failure": F.lower("cancellation_reason") == "non_payment",
    })


def billing_schedule(policies: DataFrame, until: date) -> DataFrame:
    """One row per policy and month from the effective date to the expiry date or ``until``,
    both ends included. Pending policies are not billed; a policy that starts after its
    schedule ends gets no rows."""
    ends = F.least("expiry_date", F.lit(until))
    live = F.coalesce(F.col("policy_status") != "pending", F.lit(True))
    return (
        policies.filter(live & (F.col("effective_date") <= ends))
        .select(
            "policy_id", "member_id", "carrier", "plan_type",
            F.col("monthly_premium").cast(MONEY).alias("amount_due"),
            F.posexplode(F.sequence("effective_date", ends, F.expr("interval 1 month"))).alias("_month", "due_date"),
        )
        .select(
            "policy_id", "member_id", (F.col("_month") + 1).cast("bigint").alias("instalment"), "due_date",
            "amount_due", "carrier", "plan_type",
        )
    )
