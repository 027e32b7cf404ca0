"""The star schema: two facts, one dimension and the monthly commission summary.

Builders take staged frames and return lazy frames. They assume that ids are unique in
agents, members and policies, which the data checks verify.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.functions import month_gap, money, percent
from coverloom.operators.enrich import (
    agent_labels,
    with_collection_status,
    with_commission,
    with_member_context,
)
from coverloom.operators.staging import Staged

# The columns of both facts.
PAYMENT_COLUMNS = (
    "payment_id", "policy_id", "member_id", "agent_id", "agent_name", "agency_name", "agent_tier", "due_date",
    "paid_date", "due_year", "due_month", "due_period", "amount_due", "amount_paid", "payment_gap",
    "payment_status", "payment_method", "is_failed", "is_late", "days_to_pay", "carrier", "plan_type",
    "plan_category", "state", "age_bucket", "commission_earned", "collection_status",
)

CHURN_COLUMNS = (
    "cancellation_id", "policy_id", "member_id", "agent_id", "agent_name", "agency_name", "agent_tier",
    "member_name", "state", "age_bucket", "plan_category", "cancellation_date", "cancel_period", "cancel_year",
    "cancel_month", "cancellation_reason", "churn_type", "is_early_cancel", "months_active", "lifetime_value",
    "was_payment_failure", "carrier", "plan_type", "monthly_premium", "policy_start_date", "last_paid_date",
    "months_since_last_payment", "annualized_revenue_lost",
)


def count_rows() -> Column:
    return F.count(F.lit(1))


def or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def dim_agents(s: Staged) -> DataFrame:
    """One row per agent with lifetime totals. Each child table is aggregated to agent grain
    (map-side first) before it meets the agents, so the joins are 1:1 and small."""
    policies = s.policies.groupBy("agent_id").agg(
        count_rows().alias("total_policies"),
        F.count_if(F.col("policy_status") == "active").alias("active_policies"),
        F.count_if(F.col("policy_status") == "cancelled").alias("cancelled_policies"),
        F.sum("monthly_premium").alias("total_monthly_premium"),
        F.sum("monthly_commission").alias("total_monthly_commission"),
        F.sum("annual_commission").alias("total_annual_commission"),
    )
    members = s.members.groupBy("agent_id").agg(F.count_distinct("member_id").alias("total_members"))
    cancellations = s.cancellations.groupBy("agent_id").agg(
        count_rows().alias("total_cancellations"),
        F.count_if(F.col("churn_type") == "involuntary").alias("involuntary_cancellations"),
    )
    totals = (
        "total_members", "total_policies", "active_policies", "cancelled_policies", "total_monthly_premium",
        "total_monthly_commission", "total_annual_commission", "total_cancellations", "involuntary_cancellations",
    )
    return (
        s.agents.join(policies, "agent_id", "left")
        .join(members, "agent_id", "left")
        .join(cancellations, "agent_id", "left")
        .select(
            "agent_id", "agent_name", "agency_name", "state", "email", "hire_date", "is_active", "tier",
            "tier_rank", "months_tenure",
            *[or_zero(name) for name in totals],
            percent(F.col("cancelled_policies"), F.col("total_policies")).alias("cancellation_rate_pct"),
        )
    )


def placed_payments(s: Staged) -> DataFrame:
    """What the payment fact knows from payments and policies."""
    return with_commission(with_collection_status(s.payments), s.policies)


def fct_payments(s: Staged, placed: DataFrame | None = None) -> DataFrame:
    """One row per payment. The agent is the member's, not the policy's. ``placed``: the result
    of ``placed_payments``, if it has been written already."""
    placed = placed_payments(s) if placed is None else placed
    return with_member_context(placed, s.members, s.agents).select(*PAYMENT_COLUMNS)


def paid_by_policy(payments: DataFrame) -> DataFrame:
    """Last good payment per policy and month: what a store keeps for the churn fact."""
    return (
        payments.filter((F.col("payment_status") != "failed") & F.col("paid_date").isNotNull())
        .groupBy("policy_id", "due_period")
        .agg(F.max("paid_date").alias("last_paid_date"))
    )


def fct_member_churn(s: Staged, last_paid: DataFrame | None = None) -> DataFrame:
    """One row per cancellation. The agent is the cancellation's, not the member's.

    Payments are reduced to one date per policy (map-side first) before they meet the
    cancellations, and that join reuses the partitioning by policy. ``last_paid`` has those
    dates (policy_id, last_paid_date) if they are known already.
    """
    policies = s.policies.select("policy_id", "monthly_premium", F.col("effective_date").alias("policy_start_date"))
    if last_paid is None:
        last_paid = (
            s.payments.filter((F.col("payment_status") != "failed") & F.col("paid_date").isNotNull())
            .groupBy("policy_id")
            .agg(F.max("paid_date").alias("last_paid_date"))
        )
    members = s.members.select(
        "member_id", F.col("full_name").alias("member_name"), "state", "age_bucket", "plan_category"
    )
    return (
        s.cancellations.join(policies, "policy_id", "left")
        .join(last_paid, "policy_id", "left")
        .join(members, "member_id", "left")
        .join(agent_labels(s.agents), "agent_id", "left")
        .withColumns({
            "months_since_last_payment": month_gap(F.col("cancellation_date"), F.col("last_paid_date")),
            "annualized_revenue_lost": money(F.col("monthly_premium") * 12),
        })
        .select(*CHURN_COLUMNS)
    )


def priced_payments(s: Staged) -> DataFrame:
    """Payments with commission: what carrier and company totals read of the payment fact."""
    return with_commission(s.payments, s.policies)


def priced_cancellations(s: Staged) -> DataFrame:
    """Cancellations with the revenue they cost: what totals read of the churn fact."""
    premiums = s.policies.select("policy_id", "monthly_premium")
    return (
        s.cancellations.join(premiums, "policy_id", "left")
        .withColumn("annualized_revenue_lost", money(F.col("monthly_premium") * 12))
        .drop("monthly_premium")
    )


# ---- monthly commission summary ------------------------------------------------------

_MONTH = ("due_period", "due_year", "due_month")
_COUNTS = ("total_payments_due", "paid_on_time", "paid_late", "payments_failed")
_AMOUNTS = ("total_amount_due", "total_amount_collected", "total_uncollected", "total_commission_earned")
_CHURN = ("members_churned", "involuntary_churns", "revenue_lost_to_churn")


def _per_member(payments: DataFrame, *keys: str) -> DataFrame:
    """Priced payments, each with its agent, summed per member, agent, month and ``keys``.

    Grouping by the member first turns the distinct count of members per agent into a plain
    count. After the member join the rows already lie by member, so nothing is moved for it.
    """
    status = F.col("payment_status")
    return payments.groupBy("member_id", "agent_id", *_MONTH, *keys).agg(
        F.count("payment_id").alias("total_payments_due"),
        F.count_if(status == "paid").alias("paid_on_time"),
        F.count_if(status == "paid_late").alias("paid_late"),
        F.count_if(status == "failed").alias("payments_failed"),
        F.sum("amount_due").alias("total_amount_due"),
        F.sum("amount_paid").alias("total_amount_collected"),
        F.sum("payment_gap").alias("total_uncollected"),
        F.sum("commission_earned").alias("total_commission_earned"),
    )


def _sums(names: tuple[str, ...], kind: str) -> list[Column]:
    return [F.sum(name).cast(kind).alias(name) for name in names]


def _per_agent(member_months: DataFrame, *keys: str) -> DataFrame:
    """Member months, each with its agent, summed per agent, month and ``keys``."""
    return member_months.groupBy("agent_id", *_MONTH, *keys).agg(
        *_sums(_COUNTS, "bigint"), *_sums(_AMOUNTS, "decimal(22,2)"),
        F.count("member_id").alias("active_members_billed"),
    )


def billed_by_agent(s: Staged, *keys: str) -> DataFrame:
    owners = s.members.select("member_id", "agent_id")
    return _per_agent(_per_member(priced_payments(s).join(owners, "member_id", "left"), *keys), *keys)


def billed_by_agent_from_fact(payments: DataFrame, *keys: str) -> DataFrame:
    """The same from a stored payment fact, which knows the agent already: no join."""
    return _per_agent(_per_member(payments, *keys), *keys)


def churned_by_agent(cancellations: DataFrame) -> DataFrame:
    return cancellations.groupBy("agent_id", "cancel_period").agg(
        count_rows().alias("members_churned"),
        F.count_if(F.col("churn_type") == "involuntary").alias("involuntary_churns"),
        F.sum("annualized_revenue_lost").cast("decimal(22,2)").alias("revenue_lost_to_churn"),
    )


def _summary_columns(*keys: str) -> list[Column | str]:
    return [
        "agent_id", "agent_name", "agency_name", "agent_tier",
        F.col("due_period").alias("period"), F.col("due_year").alias("year"), F.col("due_month").alias("month"),
        *keys, *_COUNTS, "active_members_billed", *_AMOUNTS,
        *[or_zero(name) for name in _CHURN],
        percent(F.col("total_amount_collected"), F.col("total_amount_due")).alias("collection_rate_pct"),
        percent(F.col("payments_failed"), F.col("total_payments_due")).alias("failure_rate_pct"),
    ]


def commission_summary(billed: DataFrame, churned: DataFrame, agents: DataFrame) -> DataFrame:
    """One row per agent, month and carrier. An agent's churn of a month repeats on each
    carrier's row and is lost when the month has no billing, so it must not be added up;
    ``commission_summary_monthly`` has churn that can be."""
    return (
        billed.join(churned.withColumnRenamed("cancel_period", "due_period"), ["agent_id", "due_period"], "left")
        .join(agent_labels(agents), "agent_id", "left")
        .select(*_summary_columns("carrier"))
    )


def commission_summary_monthly(billed: DataFrame, churned: DataFrame, agents: DataFrame) -> DataFrame:
    """One row per agent and month, every cancellation counted exactly once.

    Billing and churn are stacked and summed, not joined: months with only one of the two
    stay, and rows without an agent fall together instead of failing to match.
    """
    period = F.col("cancel_period")
    stacked = billed.unionByName(
        churned.select(
            "agent_id",
            period.alias("due_period"),
            F.substring(period, 1, 4).cast("bigint").alias("due_year"),
            F.substring(period, 6, 2).cast("bigint").alias("due_month"),
            *_CHURN,
        ),
        allowMissingColumns=True,
    )
    counts = (*_COUNTS, "active_members_billed")
    return (
        stacked.groupBy("agent_id", *_MONTH)
        .agg(
            *_sums((*counts, "members_churned", "involuntary_churns"), "bigint"),
            *_sums((*_AMOUNTS, "revenue_lost_to_churn"), "decimal(22,2)"),
        )
        .withColumns({name: F.coalesce(name, F.lit(0)) for name in (*counts, *_AMOUNTS)})
        .join(agent_labels(agents), "agent_id", "left")
        .select(*_summary_columns())
    )


def in_report_order(summary: DataFrame) -> DataFrame:
    """Newest month first, best earners on top. For showing; a stored table has no order."""
    return summary.orderBy(F.desc("period"), F.desc_nulls_last("total_commission_earned"), "agent_id")


def agent_commission_summary(s: Staged) -> DataFrame:
    return commission_summary(
        billed_by_agent(s, "carrier"), churned_by_agent(priced_cancellations(s)), s.agents
    )


def agent_commission_summary_monthly(s: Staged) -> DataFrame:
    return commission_summary_monthly(billed_by_agent(s), churned_by_agent(priced_cancellations(s)), s.agents)
