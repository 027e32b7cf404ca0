"""Dimension versions: facts with the values that held on their day.

A version is a row of a dimension with the day from which it holds; it ends where the next one
of the same key begins. ``as_of_join`` gives every fact the version of its key that held on the
fact's day. Versions and facts are stacked and sorted by key and day, and a window takes the last
version on or before each fact: one shuffle, and no row of either side is multiplied by the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverloom.functions import choose
from coverloom.operators.staging import Staged
from coverloom.plans.marts import PAYMENT_COLUMNS, placed_payments
from coverloom.session import written_for, written_once

VALID_FROM = "valid_from"
# Facts of one key are dealt into this many groups, each with all versions of the key.
SALTS = 16


def one_per_day(versions: DataFrame, key: str) -> DataFrame:
    """One version per key and day: of several, the greatest row."""
    others = [c for c in versions.columns if c not in (key, VALID_FROM)]
    best = versions.groupBy(key, VALID_FROM).agg(F.max(F.struct(*others)).alias("_row"))
    return best.select(key, VALID_FROM, *[F.col(f"_row.{c}").alias(c) for c in others])


def as_of_join(facts: DataFrame, versions: DataFrame, key: str, day: str, salts: int = SALTS) -> DataFrame:
    """``facts`` with the other columns of ``versions``, those of the last version of the same
    ``key`` whose ``valid_from`` is not after ``day``; nulls if there is none, or if the key or
    the day is null. Versions have a key and a first day each.

    Versions of a key are few and facts may be many: a key that holds a third of all facts is
    dealt into ``salts`` groups, and its versions go to each of them.
    """
    given = one_per_day(versions.filter(F.col(key).isNotNull() & F.col(VALID_FROM).isNotNull()), key)
    values = [c for c in given.columns if c not in (key, VALID_FROM)]
    clash = set(values) & set(facts.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    salt = F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
    left = facts.select(F.struct(*facts.columns).alias("_fact"), F.col(key).alias("_key"), F.col(day).alias("_day"), salt.alias("_salt"), F.lit(1).alias("_side"))
    right = given.select(
        F.struct(*values).alias("_version"), F.col(key).alias("_key"), F.col(VALID_FROM).alias("_day"),
        F.explode(F.array(*[F.lit(k) for k in range(salts)])).alias("_salt"), F.lit(0).alias("_side"),
    )
    order = Window.partitionBy("_key", "_salt").orderBy(F.col("_day").asc_nulls_first(), "_side").rowsBetween(Window.unboundedPreceding, 0)
    stacked = left.unionByName(right, allowMissingColumns=True)
    held = stacked.withColumn("_held", F.last("_version", ignorenulls=True).over(order)).filter("_side = 1")
    return held.select("_fact.*", *[F.col(f"_held.{c}").alias(c) for c in values])


def fct_payments_as_of(s: Staged, member_versions: DataFrame, agent_versions: DataFrame) -> DataFrame:
    """The payment fact with the agent a member had on the due date and the labels that agent
    had then. ``member_versions``: member_id, valid_from, agent_id; ``agent_versions``: agent_id,
    valid_from, agent_name, agency_name, agent_tier."""
    # Payments move three times. Each time but the last they are written, so that what one step
    # has shuffled is gone before the next deals them again.
    with written_for(placed_payments(s), "priced-payments") as priced:
        placed = priced.join(s.members.select("member_id", "state", "age_bucket", "plan_category"), "member_id", "left")
        placed = written_once(placed, "placed-payments")
    owners = labelled_versions(member_versions, agent_versions)
    return as_of_join(placed, owners, "member_id", "due_date").select(*PAYMENT_COLUMNS)


def labelled_versions(member_versions: DataFrame, agent_versions: DataFrame) -> DataFrame:
    """Member versions cut where their agent's labels change, each with the labels of its days:
    payments then meet one side, and are not dealt by agent as well."""
    known = F.col("member_id").isNotNull() & F.col(VALID_FROM).isNotNull()
    owned = one_per_day(member_versions.select("member_id", VALID_FROM, "agent_id").filter(known), "member_id")
    following = F.lead(VALID_FROM).over(Window.partitionBy("member_id").orderBy(VALID_FROM))
    spans = owned.withColumn("_until", following)
    labels = agent_versions.select("agent_id", VALID_FROM, "agent_name", "agency_name", "agent_tier")
    turns = labels.select("agent_id", F.col(VALID_FROM).alias("_turn")).distinct()
    inside = (F.col("_turn") > F.col(VALID_FROM)) & (F.col("_until").isNull() | (F.col("_turn") < F.col("_until")))
    cuts = spans.join(turns, "agent_id").filter(inside).select("member_id", F.col("_turn").alias(VALID_FROM), "agent_id")
    return as_of_join(owned.unionByName(cuts), labels, "agent_id", VALID_FROM)


def versions_of(frame: DataFrame, changes: dict[str, tuple], first_day) -> DataFrame:
    """Two versions of every row: as it is now, from the day its change held on, and before that
    from ``first_day`` on with ``changes``: column -> (value before, rows it applies to, day of
    change). Rows that no change applies to have one version."""
    applies = choose([(F.coalesce(rows, F.lit(False)), F.lit(day)) for _, rows, day in changes.values()], None)
    now = frame.withColumn(VALID_FROM, F.coalesce(applies, F.lit(first_day)))
    before = frame.withColumn("_from", applies).filter("_from is not null")
    for column, (value, rows, _) in changes.items():
        before = before.withColumn(column, F.when(rows, F.lit(value)).otherwise(F.col(column)))
    return now.unionByName(before.withColumn(VALID_FROM, F.lit(first_day)).drop("_from"))
