"""Cleaned, typed and labelled versions of the raw tables: one row in, one row out."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.functions import choose, day_gap, lookup, month_gap, period_of, strip_space, year_gap
from coverloom.schemas import (
    AGE_BUCKETS,
    EARLY_CANCEL_MONTHS,
    INVOLUNTARY_REASONS,
    MONEY,
    OLDEST_BUCKET,
    RATE,
    RAW_SCHEMAS,
    TIER_RANK,
)
from coverloom.sources.raw import RawTables


def stage_agents(raw: DataFrame, as_of: date) -> DataFrame:
    hired, tier = F.col("hire_date").cast("date"), F.lower("tier")
    return raw.select(
        "agent_id",
        strip_space(F.col("agent_name")).alias("agent_name"),
        strip_space(F.col("agency_name")).alias("agency_name"),
        F.upper("state").alias("state"),
        F.lower("email").alias("email"),
        "phone",
        hired.alias("hire_date"),
        F.col("is_active").cast("boolean").alias("is_active"),
        tier.alias("tier"),
        month_gap(F.lit(as_of), hired).alias("months_tenure"),
        lookup(tier, TIER_RANK, 1).cast("bigint").alias("tier_rank"),
    )


def stage_members(raw: DataFrame, as_of: date) -> DataFrame:
    first, last = strip_space(F.col("first_name")), strip_space(F.col("last_name"))
    born, joined = F.col("dob").cast("date"), F.col("enrollment_date").cast("date")
    age, plan = year_gap(F.lit(as_of), born), F.col("plan_type")
    category = choose([(plan.contains("Bundle"), "bundle"), (plan.startswith("Dental"), "dental")], "vision")
    return raw.select(
        "member_id",
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(first, F.lit(" "), last).alias("full_name"),
        F.lower("email").alias("email"),
        "phone",
        born.alias("dob"),
        F.upper("state").alias("state"),
        "zip_code",
        joined.alias("enrollment_date"),
        "agent_id", "carrier", "plan_type",
        age.alias("age_years"),
        choose([(age < limit, label) for limit, label in AGE_BUCKETS], OLDEST_BUCKET).alias("age_bucket"),
        F.year(joined).cast("bigint").alias("enrollment_year"),
        F.month(joined).cast("bigint").alias("enrollment_month"),
        category.alias("plan_category"),
    )


def stage_policies(raw: DataFrame, as_of: date) -> DataFrame:
    starts, ends = F.col("effective_date").cast("date"), F.col("expiry_date").cast("date")
    status = F.lower("status")
    eligible = (status == "active") & F.lit(as_of).between(starts, ends)
    return raw.select(
        "policy_id", "member_id", "agent_id", "carrier", "plan_type",
        starts.alias("effective_date"),
        ends.alias("expiry_date"),
        F.col("monthly_premium").cast(MONEY).alias("monthly_premium"),
        F.col("annual_premium").cast(MONEY).alias("annual_premium"),
        F.col("commission_rate").cast(RATE).alias("commission_rate"),
        F.col("monthly_commission").cast(MONEY).alias("monthly_commission"),
        status.alias("policy_status"),
        F.col("term_months").cast("bigint").alias("term_months"),
        (F.col("monthly_commission").cast(MONEY) * 12).cast(MONEY).alias("annual_commission"),
        F.coalesce(eligible, F.lit(False)).alias("is_currently_eligible"),
        day_gap(ends, starts).alias("policy_duration_days"),
    )


def stage_payments(raw: DataFrame, *extra: str) -> DataFrame:
    """``extra`` names columns of the feed to pass through, such as a load time."""
    due, paid, status = F.col("due_date").cast("date"), F.col("paid_date").cast("date"), F.lower("payment_status")
    billed, received = F.col("amount_due").cast(MONEY), F.col("amount_paid").cast(MONEY)
    return raw.select(
        "payment_id", "policy_id", "member_id",
        due.alias("due_date"),
        paid.alias("paid_date"),
        billed.alias("amount_due"),
        received.alias("amount_paid"),
        status.alias("payment_status"),
        F.lower("payment_method").alias("payment_method"),
        "carrier", "plan_type",
        F.coalesce(status == "failed", F.lit(False)).alias("is_failed"),
        F.coalesce(status == "paid_late", F.lit(False)).alias("is_late"),
        day_gap(paid, due).alias("days_to_pay"),
        (billed - received).cast(MONEY).alias("payment_gap"),
        F.year(due).cast("bigint").alias("due_year"),
        F.month(due).cast("bigint").alias("due_month"),
        period_of(due).alias("due_period"),
        *extra,
    )


def stage_cancellations(raw: DataFrame) -> DataFrame:
    day, reason = F.col("cancellation_date").cast("date"), F.lower("cancellation_reason")
    months = F.col("months_active").cast("bigint")
    return raw.select(
        "cancellation_id", "policy_id", "member_id", "agent_id",
        day.alias("cancellation_date"),
        reason.alias("cancellation_reason"),
        months.alias("months_active"),
        F.col("lifetime_value").cast(MONEY).alias("lifetime_value"),
        "carrier", "plan_type",
        F.col("was_payment_failure").cast("boolean").alias("was_payment_failure"),
        choose([(reason.isin(*INVOLUNTARY_REASONS), "involuntary")], "voluntary").alias("churn_type"),
        F.coalesce(months <= EARLY_CANCEL_MONTHS, F.lit(False)).alias("is_early_cancel"),
        F.year(day).cast("bigint").alias("cancel_year"),
        F.month(day).cast("bigint").alias("cancel_month"),
        period_of(day).alias("cancel_period"),
    )


class Staged:
    """The five staged tables, each built on first use."""

    def __init__(self, raw: RawTables, as_of: date):
        self.raw = raw
        self.as_of = as_of
        self._given: dict[str, DataFrame] = {}  # tables that do not come from raw

    @cached_property
    def agents(self) -> DataFrame:
        return stage_agents(self.raw.agents, self.as_of)

    @cached_property
    def members(self) -> DataFrame:
        return stage_members(self.raw.members, self.as_of)

    @cached_property
    def policies(self) -> DataFrame:
        return stage_policies(self.raw.policies, self.as_of)

    @cached_property
    def payments(self) -> DataFrame:
        return stage_payments(self.raw.payments)

    @cached_property
    def cancellations(self) -> DataFrame:
        return stage_cancellations(self.raw.cancellations)

    def with_payments(self, payments: DataFrame) -> Staged:
        """The same tables over other staged payments: stored ones, or single months."""
        return self._with(payments=payments)

    def with_cancellations(self, cancellations: DataFrame) -> Staged:
        return self._with(cancellations=cancellations)

    def of_members(self, members: DataFrame) -> Staged:
        """The same tables for marts of payments: the payments and rows of ``members`` (member_id), and
        of the policies at least those that these payments name."""
        near = Staged(self.raw.of_members(members), self.as_of)
        vars(near).update(self._given)
        return self._with(
            payments=near.payments.join(members, "member_id", "left_semi"),
            policies=near.policies,
            members=self.members.join(members, "member_id", "left_semi"),
        )

    def _with(self, **tables: DataFrame) -> Staged:
        other = Staged(self.raw, self.as_of)
        vars(other).update({**vars(self), **tables, "_given": {**self._given, **tables}})
        return other

    def register_views(self, prefix: str = "stg_") -> None:
        """Staging views, usable from ``spark.sql``."""
        for table in RAW_SCHEMAS:
            getattr(self, table).createOrReplaceTempView(prefix + table)
