"""The six analyst questions.

Each takes the narrowest frames that hold its columns, staged or stored, and ends with the
presentation order; a key column breaks ties so the order is repeatable.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.functions import choose, day_gap, mean, percent
from coverloom.operators.enrich import with_member_context
from coverloom.plans.marts import count_rows

TOP_AGENTS = 20
ACTIVE_DAYS = 60
RISK_DAYS = 90


def monthly_revenue(payments: DataFrame) -> DataFrame:
    """Q1. Billed, collected and failed per month."""
    return (
        payments.groupBy("due_period", "due_year", "due_month")
        .agg(
            F.sum("amount_due").alias("total_billed"),
            F.sum("amount_paid").alias("total_collected"),
            F.sum("payment_gap").alias("total_uncollected"),
            F.count_if("is_failed").alias("failed_payments"),
            count_rows().alias("_n"),
        )
        .select(
            "due_period", "due_year", "due_month", "total_billed", "total_collected", "total_uncollected",
            "failed_payments",
            percent(F.col("total_collected"), F.col("total_billed")).alias("collection_rate_pct"),
            percent(F.col("failed_payments"), F.col("_n")).alias("failure_rate_pct"),
        )
        .orderBy("due_period")
    )


def top_agents(summary: DataFrame, as_of: date, n: int = TOP_AGENTS) -> DataFrame:
    """Q2. Agents with the most commission in the calendar year of ``as_of``.

    The rates are unweighted means over the summary's rows, avg_active_members is their sum
    of members and total_churns repeats per carrier: that is how the report defines them.
    """
    return (
        summary.filter(F.col("year") == as_of.year)
        .groupBy("agent_id", "agent_name", "agency_name", "agent_tier")
        .agg(
            F.sum("total_commission_earned").cast("decimal(22,2)").alias("ytd_commission"),
            F.sum("active_members_billed").alias("avg_active_members"),
            mean(F.sum("collection_rate_pct"), F.count("collection_rate_pct")).alias("avg_collection_rate"),
            mean(F.sum("failure_rate_pct"), F.count("failure_rate_pct")).alias("avg_failure_rate"),
            F.sum("members_churned").alias("total_churns"),
        )
        .orderBy(F.desc_nulls_last("ytd_commission"), "agent_id")
        .limit(n)
    )


def churn_by_reason(cancellations: DataFrame) -> DataFrame:
    """Q3. Why members leave, per plan."""
    return (
        cancellations.groupBy("plan_type", "cancellation_reason", "churn_type")
        .agg(
            count_rows().alias("total_cancellations"),
            mean(F.sum("months_active"), F.count("months_active"), 1).alias("avg_months_active"),
            F.sum("lifetime_value").alias("total_ltv_lost"),
            F.sum("annualized_revenue_lost").alias("annualized_revenue_lost"),
            F.count_if("is_early_cancel").alias("early_cancels"),
        )
        .withColumn("early_cancel_rate_pct", percent(F.col("early_cancels"), F.col("total_cancellations")))
        .orderBy(F.desc("total_cancellations"), "plan_type", "cancellation_reason")
    )


def eligibility_gap(payments: DataFrame, cancellations: DataFrame, as_of: date) -> DataFrame:
    """Q4. Members who cancelled and have no good payment due in the last 60 days.

    Members who still pay are taken out first; only the others' reasons are listed, in order of
    cancellation. They are joined per day first, so the last step of a member with very many
    cancellations only strings the days together.
    """
    since = as_of - timedelta(days=ACTIVE_DAYS)
    active = (
        payments.filter((F.col("payment_status") != "failed") & (F.col("due_date") >= F.lit(since)))
        .select("member_id")
        .distinct()
    )
    gone = cancellations.select("member_id", "cancellation_date", "cancellation_id", "cancellation_reason").join(
        active, "member_id", "left_anti"
    )
    per_day = gone.groupBy("member_id", "cancellation_date").agg(
        F.expr("listagg(cancellation_reason, ', ') within group (order by cancellation_id)").alias("_reasons")
    )
    per_member = per_day.groupBy("member_id").agg(
        F.max("cancellation_date").alias("last_cancel_date"),
        F.expr("listagg(_reasons, ', ') within group (order by cancellation_date)").alias("cancellation_reasons"),
    )
    return (
        per_member.select(
            "member_id", "last_cancel_date", "cancellation_reasons",
            day_gap(F.lit(as_of), F.col("last_cancel_date")).alias("days_since_cancel"),
            F.lit("eligibility_gap").alias("eligibility_status"),
        )
        .orderBy(F.desc("last_cancel_date"), "member_id")
    )


def churn_risk(payments: DataFrame, members: DataFrame, agents: DataFrame, as_of: date) -> DataFrame:
    """Q5. Members with failed or repeatedly late payments due in the last 90 days.

    Payments are summed per member and filtered first; only members at risk meet the
    member and agent tables.
    """
    behaviour = _payment_behaviour(payments, as_of, "member_id", "plan_type")
    return _risk(with_member_context(behaviour, members, agents))


def churn_risk_from_fact(payments: DataFrame, as_of: date) -> DataFrame:
    """The same from the payment fact, which knows agent and state already: no join."""
    return _risk(_payment_behaviour(payments, as_of, "member_id", "plan_type", "agent_id", "agent_name", "state"))


def _payment_behaviour(payments: DataFrame, as_of: date, *keys: str) -> DataFrame:
    since = as_of - timedelta(days=RISK_DAYS)
    return (
        payments.filter(F.col("due_date") >= F.lit(since))
        .groupBy(*keys)
        .agg(
            F.count("payment_id").alias("payments_last_90d"),
            F.count_if("is_failed").alias("failures_last_90d"),
            F.count_if("is_late").alias("late_last_90d"),
            F.max("due_date").alias("most_recent_due_date"),
        )
        .filter((F.col("failures_last_90d") > 0) | (F.col("late_last_90d") >= 2))
    )


def _risk(behaviour: DataFrame) -> DataFrame:
    failures, late = F.col("failures_last_90d"), F.col("late_last_90d")
    tier = choose([(failures >= 2, "high_risk"), ((failures == 1) | (late >= 2), "medium_risk")], "low_risk")
    return (
        behaviour.select(
            "member_id", "agent_id", "agent_name", "plan_type", "state", "payments_last_90d", "failures_last_90d",
            "late_last_90d", "most_recent_due_date",
            percent(failures, F.col("payments_last_90d"), 1).alias("failure_rate_pct"),
            tier.alias("churn_risk_tier"),
        )
        .orderBy(F.desc("failures_last_90d"), F.desc("late_last_90d"), "member_id", "plan_type")
    )


def carrier_revenue(payments: DataFrame) -> DataFrame:
    """Q6. Members, revenue and commission per carrier and year, from priced payments."""
    return (
        payments.groupBy("carrier", "due_year")
        .agg(
            F.count_distinct("member_id").alias("members"),
            F.sum("amount_due").alias("total_billed"),
            F.sum("amount_paid").alias("total_collected"),
            F.sum("commission_earned").alias("total_commissions"),
        )
        .withColumn("collection_rate_pct", percent(F.col("total_collected"), F.col("total_billed")))
        .orderBy(F.desc("due_year"), F.desc("total_collected"), "carrier")
    )
