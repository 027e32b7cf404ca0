"""N:1 left joins that give payments and cancellations their context.

Agents are joined to the members first: the agent join then happens at member size, and
the payment table is shuffled twice (policy, member) where a chain over three dimensions
would shuffle it three times. No broadcast hints: Catalyst broadcasts a dimension that its
size estimate or AQE's runtime size allows, and shuffles otherwise, with AQE splitting hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.functions import choose, money
from coverloom.schemas import MONEY


def with_commission(payments: DataFrame, policies: DataFrame) -> DataFrame:
    """Adds commission_earned, rounded per payment. Nothing is earned on a failed payment or
    on one of unknown status; a payment whose policy is missing earns NULL."""
    rates = policies.select("policy_id", "commission_rate")
    earned = money(F.col("amount_paid") * F.col("commission_rate"))
    return (
        payments.join(rates, "policy_id", "left")
        .withColumn(
            "commission_earned", choose([(F.col("payment_status") != "failed", earned)], F.lit(0).cast(MONEY))
        )
        .drop("commission_rate")
    )


def with_collection_status(payments: DataFrame) -> DataFrame:
    return payments.withColumn(
        "collection_status",
        choose(
            [(F.col("payment_status") == "failed", "uncollected"), (F.col("is_late"), "collected_late")],
            "collected_on_time",
        ),
    )


def agent_labels(agents: DataFrame) -> DataFrame:
    return agents.select("agent_id", "agent_name", "agency_name", F.col("tier").alias("agent_tier"))


def member_context(members: DataFrame, agents: DataFrame) -> DataFrame:
    """Each member with their agent's labels."""
    return members.select("member_id", "agent_id", "state", "age_bucket", "plan_category").join(
        agent_labels(agents), "agent_id", "left"
    )


def with_member_context(frame: DataFrame, members: DataFrame, agents: DataFrame) -> DataFrame:
    return frame.join(member_context(members, agents), "member_id", "left")
