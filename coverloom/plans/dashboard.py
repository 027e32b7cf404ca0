"""The datasets behind the three dashboard pages."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from coverloom.functions import choose, lookup, mean, percent
from coverloom.operators.slicing import in_dates
from coverloom.plans.marts import count_rows
from coverloom.schemas import CANCELLATION_REASONS

TREND_MONTHS = 24
# Scorecard colours.
RED_ABOVE_FAILURE_PCT = 5
GREEN_ABOVE_COLLECTION_PCT = 95


def month_start(day: date, months_back: int = 0) -> date:
    index = day.year * 12 + day.month - 1 - months_back
    return date(index // 12, index % 12 + 1, 1)


def month_end(day: date) -> date:
    return month_start(day, -1) - timedelta(days=1)


# ---- page 1: executive KPIs ----------------------------------------------------------


def exec_kpis(payments: DataFrame, policies: DataFrame, as_of: date) -> DataFrame:
    """D1. One row of cards. Reads this year's payments only; ``payments`` carry commission.
    Month and year are whole ones: what falls due after ``as_of`` counts, as in Q2."""
    year = in_dates(payments, "due_date", date(as_of.year, 1, 1), date(as_of.year, 12, 31))
    this_month = F.col("due_date").between(F.lit(month_start(as_of)), F.lit(month_end(as_of)))
    active = policies.filter(F.col("policy_status") == "active").agg(F.count_distinct("member_id")).scalar()
    return (
        year.agg(
            F.sum(F.when(this_month, F.col("amount_due"))).alias("month_billed"),
            F.sum(F.when(this_month, F.col("amount_paid"))).alias("month_collected"),
            F.sum("commission_earned").alias("ytd_commission"),
        )
        .select(
            active.alias("total_active_members"),
            "month_billed", "month_collected",
            percent(F.col("month_collected"), F.col("month_billed")).alias("collection_rate_pct"),
            "ytd_commission",
        )
    )


def collection_trend(payments: DataFrame, as_of: date, months: int = TREND_MONTHS) -> DataFrame:
    """D2. Collection rate of the last 24 calendar months, the month of ``as_of`` included."""
    window = in_dates(payments, "due_date", month_start(as_of, months - 1), month_end(as_of))
    return (
        window.groupBy("due_period")
        .agg(percent(F.sum("amount_paid"), F.sum("amount_due")).alias("collection_rate_pct"))
        .orderBy("due_period")
    )


def carrier_month(payments: DataFrame) -> DataFrame:
    """D3. Collected per month and carrier."""
    return (
        payments.groupBy("due_period", "carrier")
        .agg(F.sum("amount_paid").alias("amount_collected"))
        .orderBy("due_period", "carrier")
    )


def plan_mix(payments: DataFrame) -> DataFrame:
    """D4. Collected per plan and its share. The window runs over one row per plan."""
    total = F.sum("amount_collected").over(Window.partitionBy())
    return (
        payments.groupBy("plan_type")
        .agg(F.sum("amount_paid").alias("amount_collected"))
        .withColumn("share_pct", percent(F.col("amount_collected"), total))
        .orderBy(F.desc("amount_collected"), "plan_type")
    )


# ---- page 2: agent performance -------------------------------------------------------


def tier_scatter(summary: DataFrame, agents: DataFrame) -> DataFrame:
    """D5. Mean collection rate and members billed per tier. The summary is reduced to agent
    grain before it meets the agents for the rank."""
    per_agent = summary.groupBy("agent_id", "agent_tier").agg(
        F.sum("collection_rate_pct").alias("_rates"),
        F.count("collection_rate_pct").alias("_rated"),
        F.sum("active_members_billed").alias("_members"),
    )
    return (
        per_agent.join(agents.select("agent_id", "tier_rank"), "agent_id", "left")
        .groupBy("agent_tier", "tier_rank")
        .agg(
            mean(F.sum("_rates"), F.sum("_rated")).alias("avg_collection_rate_pct"),
            F.sum("_members").alias("active_members_billed"),
        )
        .orderBy("tier_rank", "agent_tier")
    )


def agent_scorecard(
    monthly: DataFrame, dim: DataFrame, policies: DataFrame, as_of: date, high_churn_pct: float | None = None
) -> DataFrame:
    """D6. One row per agent: rates and churn over all months of ``monthly``, the commission of
    the calendar year of ``as_of``. Cut ``monthly`` by a period slicer to show another span.

    ``monthly`` is the agent by month summary, where churn counts once. An agent is flagged
    for churn when their cancellation rate is above ``high_churn_pct``, or above the rate of
    the whole book if that is not given. Agents without billing keep NULL rates and no flags.
    """
    this_year = F.col("year") == as_of.year
    totals = (
        monthly.groupBy("agent_id")
        .agg(
            F.sum(F.when(this_year, F.col("total_commission_earned"))).alias("ytd_commission"),
            F.sum("total_amount_due").alias("_due"),
            F.sum("total_amount_collected").alias("_collected"),
            F.sum("total_payments_due").alias("_payments"),
            F.sum("payments_failed").alias("_failed"),
            F.sum("members_churned").alias("total_churns"),
        )
    )
    active = (
        policies.filter(F.col("policy_status") == "active")
        .groupBy("agent_id")
        .agg(F.count_distinct("member_id").alias("active_members"))
    )
    limit = F.lit(high_churn_pct) if high_churn_pct is not None else _book_churn_pct(policies)
    collection, failure = percent(F.col("_collected"), F.col("_due")), percent(F.col("_failed"), F.col("_payments"))
    return (
        dim.join(totals, "agent_id", "left")
        .join(active, "agent_id", "left")
        .select(
            "agent_id", "agent_name", "agency_name", "tier", "is_active",
            _zero("active_members", "bigint"),
            _zero("ytd_commission", "decimal(22,2)"),
            collection.alias("collection_rate_pct"),
            failure.alias("failure_rate_pct"),
            _zero("total_churns", "bigint"),
            choose(
                [(failure > RED_ABOVE_FAILURE_PCT, "red"), (collection > GREEN_ABOVE_COLLECTION_PCT, "green")], None
            ).alias("flag"),
            F.coalesce(F.col("cancellation_rate_pct") > limit, F.lit(False)).alias("is_high_churn"),
        )
    )


def _zero(name: str, kind: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast(kind).alias(name)


def _book_churn_pct(policies: DataFrame) -> Column:
    cancelled = F.count_if(F.col("policy_status") == "cancelled")
    return policies.agg(percent(cancelled, count_rows())).scalar()


def agent_kpis(scorecard: DataFrame) -> DataFrame:
    """D7. Cards over the scorecard; averages run over the agents billed in the scorecard's span."""
    billed = F.col("collection_rate_pct").isNotNull()
    good = F.col("collection_rate_pct") > GREEN_ABOVE_COLLECTION_PCT
    return scorecard.agg(
        F.count_if("is_active").alias("active_agents"),
        mean(F.sum(F.when(billed, F.col("ytd_commission"))), F.count_if(billed)).alias("avg_commission_per_agent"),
        percent(F.count_if(good), F.count_if(billed)).alias("agents_above_95_pct"),
    )


# ---- page 3: member churn ------------------------------------------------------------


def churn_waterfall(cancellations: DataFrame) -> DataFrame:
    """D8. Cancellations per reason in the fixed business order; unknown reasons come last."""
    rank = lookup(
        F.col("cancellation_reason"),
        {reason: i for i, reason in enumerate(CANCELLATION_REASONS, 1)},
        len(CANCELLATION_REASONS) + 1,
    )
    return (
        cancellations.groupBy("cancellation_reason", "churn_type")
        .agg(count_rows().alias("total_cancellations"))
        .select(rank.cast("bigint").alias("reason_rank"), "cancellation_reason", "churn_type", "total_cancellations")
        .orderBy("reason_rank", "cancellation_reason")
    )


def churn_rate_by_plan(cancellations: DataFrame, policies: DataFrame) -> DataFrame:
    """D9. Cancellations over policies, per plan. Both are stacked and counted in one shuffle,
    so a NULL plan or a plan found on one side only keeps its row."""
    stacked = cancellations.select("plan_type", F.lit(1).alias("_c"), F.lit(0).alias("_p")).unionByName(
        policies.select("plan_type", F.lit(0).alias("_c"), F.lit(1).alias("_p"))
    )
    return (
        stacked.groupBy("plan_type")
        .agg(F.sum("_c").alias("churned"), F.sum("_p").alias("total_policies"))
        .withColumn("churn_rate_pct", percent(F.col("churned"), F.col("total_policies")))
        .orderBy(F.desc("churned"), "plan_type")
    )


def churn_monthly(cancellations: DataFrame) -> DataFrame:
    """D10. Cancellations per month and kind of churn, with the early-cancel share."""
    return (
        cancellations.groupBy("cancel_period", "churn_type")
        .agg(
            count_rows().alias("total_cancellations"),
            F.count_if("is_early_cancel").alias("early_cancels"),
        )
        .withColumn("early_cancel_pct", percent(F.col("early_cancels"), F.col("total_cancellations")))
        .orderBy("cancel_period", "churn_type")
    )


def churn_by_state(cancellations: DataFrame, members: DataFrame) -> DataFrame:
    """D11. Cancellations per state of the member, and per 100 members of that state.

    Cancellations are counted per member first; the full join keeps members without one
    and cancellations without a known member.
    """
    per_member = cancellations.groupBy("member_id").agg(count_rows().alias("_n"))
    known = members.select("member_id", "state", F.lit(1).alias("_known"))
    return (
        known.join(per_member, "member_id", "full")
        .groupBy("state")
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("churned"),
            F.count("_known").alias("total_members"),
        )
        .withColumn("churn_rate_pct", percent(F.col("churned"), F.col("total_members")))
        .orderBy(F.desc("churned"), "state")
    )


def risk_by_state(risk: DataFrame) -> DataFrame:
    """D11. Members at risk of churn per state and tier, from the answer to Q5."""
    return (
        risk.groupBy("state", "churn_risk_tier")
        .agg(F.count_distinct("member_id").alias("members_at_risk"))
        .orderBy("state", "churn_risk_tier")
    )


def early_cancel_watchlist(churn: DataFrame) -> DataFrame:
    """D12. Members who left within the first months, from the churn fact."""
    return churn.filter("is_early_cancel").select(
        "cancellation_id", "member_name", "plan_type", "agent_name", "months_active",
        F.col("cancellation_reason").alias("reason"),
        F.col("lifetime_value").alias("ltv_lost"),
    )


def freshness(frame: DataFrame, column: str, as_of: date | datetime, max_age_hours: int = 24) -> DataFrame:
    """D13. Age of the newest row that is not in the future; stale beyond 24 hours to the
    second, or when there is no row at all. ``column`` may be a date or a load timestamp.

    ``as_of`` is a moment. A date alone stands for its midnight against a date column, and
    for the end of its day against a timestamp column: loads of that day have happened.
    """
    exact = isinstance(as_of, datetime)
    by_day = isinstance(frame.schema[column].dataType, DateType)
    moment = as_of if exact else datetime.combine(as_of + timedelta(days=0 if by_day else 1), time())
    now, seen = F.lit(moment).cast("timestamp"), F.col(column)
    limit = F.lit(moment.date()) if by_day else now
    seconds = F.timestamp_diff("SECOND", F.col("latest").cast("timestamp"), now)
    return (
        frame.filter(seen <= limit if by_day or exact else seen < limit)
        .agg(F.max(column).alias("latest"))
        .select(
            F.lit(as_of).alias("as_of"),
            "latest",
            F.floor(seconds / 3600).cast("bigint").alias("age_hours"),
            F.coalesce(seconds > max_age_hours * 3600, F.lit(True)).alias("is_stale"),
        )
    )
