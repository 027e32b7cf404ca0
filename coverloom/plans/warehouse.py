"""Builds the stored marts, in full or for single months.

What is written last marks what is done: the months' row counts after everything else, and the
churn fact and the last payments after the summaries that follow from them. A refresh that
dies is finished by the next one, which finds the same work again.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Iterator
from contextlib import ExitStack, contextmanager
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from coverloom.operators.gate import publish
from coverloom.operators.staging import Staged
from coverloom.operators.upsert import BATCHES, REJECTS, VERSION, current_payments, first_rows, row_hash, upsert_payments
from coverloom.plans import marts
from coverloom.session import shared_folder, written_for
from coverloom.sources.store import Store, in_periods, outside_periods

# Load time of payments that came with the raw tables, unless it is given: older than that of
# any feed.
FIRST_LOAD = datetime(1970, 1, 1)
# Rows of ``payment_batches`` that each month's marts were made from.
REFRESHED = "refreshed_months"
_COUNTS = StructType().add("n", "long").add("due_period", "string")
# What ``touched_by_dimensions`` reads of payments.
REACHED_BY = ("policy_id", "member_id", "due_period")
_PAID = ("last_paid_date", "months_since_last_payment")


class StoredFacts:
    """Summaries out of stored facts: no fact is computed twice in one build."""

    def __init__(self, store: Store, s: Staged, churn: DataFrame | None = None):
        self.payments = stored_fact(store, s)
        self.churn = stored_churn(store, s) if churn is None else churn
        self.agents = s.agents

    def by_carrier(self) -> DataFrame:
        billed = marts.billed_by_agent_from_fact(self.payments, "carrier")
        return marts.commission_summary(billed, marts.churned_by_agent(self.churn), self.agents)

    def by_month(self) -> DataFrame:
        billed = marts.billed_by_agent_from_fact(self.payments)
        return marts.commission_summary_monthly(billed, marts.churned_by_agent(self.churn), self.agents)


def build(store: Store, s: Staged, gated: bool = False) -> None:
    """Full rebuild of every mart. Facts first; the summaries read what was stored. ``gated``:
    a mart is only replaced if its checks pass, and the build ends at the first that fails."""
    put = partial(publish, store) if gated else store.replace
    put("dim_agents", marts.dim_agents(s))
    with _fact(s) as fact:
        put("fct_payments", fact)
    store.replace("paid_by_policy", marts.paid_by_policy(stored_fact(store, s)))
    put("fct_member_churn", marts.fct_member_churn(s, last_paid(stored_paid(store, s))))
    facts = StoredFacts(store, s)
    put("agent_commission_summary", facts.by_carrier())
    store.replace("agent_commission_summary_monthly", facts.by_month())


@contextmanager
def _fact(s: Staged) -> Iterator[DataFrame]:
    """The payment fact, worked out in steps that are written: every step moves whole payments,
    and what one has written or shuffled is gone when the one after the next begins."""
    current, placed, fact = ExitStack(), ExitStack(), ExitStack()
    with fact, placed, current:  # closing one twice does no harm
        payments = current.enter_context(written_for(s.payments, "current"))
        rows = placed.enter_context(written_for(marts.placed_payments(s.with_payments(payments)), "placed"))
        current.close()
        rows = fact.enter_context(written_for(marts.fct_payments(s, rows), "fact"))
        placed.close()
        yield rows


def start(store: Store, s: Staged, loaded_at: datetime = FIRST_LOAD, gated: bool = False) -> None:
    """Merges the raw payments into the stored ones and builds all marts. ``loaded_at`` is when
    the raw tables were taken: payments that a feed has brought since then stay as they are."""
    upsert_payments(store, s.payments.withColumn(VERSION, F.lit(loaded_at)))
    _build_from_store(store, s, gated)


def reset(store: Store, s: Staged, loaded_at: datetime = FIRST_LOAD) -> None:
    """Forgets all merged payments and goes back to what ``s`` holds."""
    store.replace(BATCHES, first_rows(s.payments.withColumn(VERSION, F.lit(loaded_at))))
    if store.exists(REJECTS):
        store.replace(REJECTS, store.read(REJECTS).limit(0))
    _build_from_store(store, s)


def refresh(store: Store, s: Staged, periods: Iterable[str | None] = ()) -> None:
    """Brings every mart up to date with the stored payments and with ``s``: the agent
    dimension; the payment fact for the months that got rows since the last refresh, and for
    ``periods``; the churn fact for cancellations that are new, changed, gone, or of a policy
    with another last payment; both summaries for the months of all of these."""
    counts = month_rows(store)
    periods = _open(store, counts) | set(periods)
    if not store.exists("fct_payments"):
        _build_from_store(store, s)
        return
    store.replace("dim_agents", marts.dim_agents(s))
    if periods:
        with _fact(s.with_payments(stored_payments(store, s, periods))) as fact:
            store.replace_periods("fct_payments", fact, periods)
    paid = _kept(store, marts.paid_by_policy(stored_fact(store, s, periods)), "paid")
    changed = _changed_churn(store, s, periods, paid)
    churned = {row[0] for row in changed.select("cancel_period").distinct().collect()}
    new_churn = _kept(store, _churn_of_months(store, s, changed, churned, periods, paid), "churn")
    months = periods | churned
    if months:
        stored = stored_churn(store, s)
        facts = StoredFacts(store, s, stored.filter(outside_periods("cancel_period", churned)).unionByName(new_churn) if churned else stored)
        # The month filter passes through the aggregations to the stored partitions.
        wanted = in_periods("period", months)
        store.replace_periods("agent_commission_summary", facts.by_carrier().filter(wanted), months)
        store.replace_periods("agent_commission_summary_monthly", facts.by_month().filter(wanted), months)
    if churned:
        store.replace_periods("fct_member_churn", new_churn, churned)
    if periods:
        store.replace_periods("paid_by_policy", paid, periods)
    _record(store, {p: counts[p] for p in periods if p in counts})


def stored_payments(
    store: Store, s: Staged, periods: Iterable[str | None] | None = None, columns: Collection[str] | None = None
) -> DataFrame:
    """The current payments, of all months or of those named, without their load time. With
    ``columns`` no others are moved to find out which row of a payment is the newest."""
    return loaded_payments(store, s, periods, columns).select(*(columns or s.payments.columns))


def loaded_payments(
    store: Store, s: Staged, periods: Iterable[str | None] | None = None, columns: Collection[str] | None = None
) -> DataFrame:
    """The current payments with ``loaded_at``."""
    schema = StructType([*s.payments.schema.fields, StructField(VERSION, TimestampType())])
    if not store.exists(BATCHES):
        return s.payments.sparkSession.createDataFrame([], schema)
    marked = StructType([*s.payments.schema.fields, store.read(BATCHES).schema[VERSION]]).add("digest", "long").add("superseded", "boolean")
    rows = store.read(BATCHES, periods, marked)
    if columns is not None:
        rows = rows.select(*dict.fromkeys(("payment_id", "due_period", *columns, VERSION, "digest", "superseded")))
    return current_payments(rows)


def stored_fact(store: Store, s: Staged, periods: Iterable[str | None] | None = None) -> DataFrame:
    return store.read("fct_payments", periods, marts.fct_payments(s).schema)


def stored_churn(store: Store, s: Staged) -> DataFrame:
    return store.read("fct_member_churn", schema=marts.fct_member_churn(s).schema)


def stored_paid(store: Store, s: Staged) -> DataFrame:
    return store.read("paid_by_policy", schema=marts.paid_by_policy(s.payments).schema)


def last_paid(paid: DataFrame) -> DataFrame:
    return paid.groupBy("policy_id").agg(F.max("last_paid_date").alias("last_paid_date"))


# ---- months whose marts did not follow yet -------------------------------------------


def month_rows(store: Store) -> dict[str | None, int]:
    """Rows per month of ``payment_batches``, which only grow: read off file footers."""
    if not store.exists(BATCHES):
        return {}
    rows = store.read(BATCHES, schema=StructType().add("due_period", "string"))
    return {row[0]: row[1] for row in rows.groupBy("due_period").count().collect()}


def _open(store: Store, counts: dict[str | None, int]) -> set[str | None]:
    done = {r.due_period: r.n for r in store.read(REFRESHED, schema=_COUNTS).collect()} if store.exists(REFRESHED) else {}
    return {month for month, n in counts.items() if done.get(month) != n}


def pending(store: Store) -> set[str | None]:
    return _open(store, month_rows(store))


def _record(store: Store, counts: dict[str | None, int]) -> None:
    if counts:
        frame = store.spark.createDataFrame([(n, month) for month, n in counts.items()], _COUNTS)
        store.replace_periods(REFRESHED, frame, counts)


def _build_from_store(store: Store, s: Staged, gated: bool = False) -> None:
    counts = month_rows(store)
    build(store, s.with_payments(stored_payments(store, s)), gated)
    _record(store, counts)


# ---- the churn fact, for what changed ------------------------------------------------


def _kept(store: Store, frame: DataFrame, purpose: str) -> DataFrame:
    """Written where all executors can read it: computed once, and readable while the table it
    comes from is replaced."""
    folder = shared_folder(store.spark, purpose)
    frame.write.parquet(folder)
    return store.spark.read.schema(frame.schema).parquet(folder)


def _key() -> Column:
    return F.coalesce("cancellation_id", F.lit("")).alias("key")


def _without_payments(s: Staged) -> DataFrame:
    """The churn fact but for the last payment: as much work as there are cancellations."""
    nothing = s.payments.sparkSession.createDataFrame([], "policy_id string, last_paid_date date")
    return marts.fct_member_churn(s, nothing)


def _changed_churn(store: Store, s: Staged, periods: set[str | None], paid: DataFrame) -> DataFrame:
    """key and cancel_period, before and now, of cancellations that are new, changed or gone or
    whose policy's last payments in ``periods`` are not those stored."""
    now, before = _without_payments(s), stored_churn(store, s)
    row = row_hash([c for c in now.columns if c not in _PAID])
    sides = [f.select(_key(), "cancel_period", "policy_id", row.alias("row"), F.lit(n).alias("side")) for n, f in ((1, now), (-1, before))]
    both = _kept(store, sides[0].unionByName(sides[1]), "churn-sides")
    unequal = both.groupBy("key", "row").agg(F.sum("side").alias("n")).filter("n <> 0").select("key")
    old = stored_paid(store, s).filter(in_periods("due_period", periods))
    moved = paid.withColumn("side", F.lit(1)).unionByName(old.withColumn("side", F.lit(-1)))
    policies = moved.groupBy("policy_id", "due_period", "last_paid_date").agg(F.sum("side").alias("n")).filter("n <> 0").select("policy_id").distinct()
    reached = both.join(policies, "policy_id", "left_semi").select("key")
    changed = unequal.unionByName(reached).distinct()
    return _kept(store, both.join(changed, "key", "left_semi").select("key", "cancel_period").distinct(), "churn-changed")


def _churn_of_months(store: Store, s: Staged, changed: DataFrame, churned: set[str | None], periods: set[str | None], paid: DataFrame) -> DataFrame:
    """All rows of the months named: stored ones that did not change, and the changed ones
    worked out anew. Payments are read for the policies of the latter only."""
    keys = changed.select("key").distinct()
    mine = s.cancellations.withColumn("key", _key()).join(keys, "key", "left_semi").drop("key")
    policies = mine.select("policy_id").distinct()
    others = stored_paid(store, s).filter(outside_periods("due_period", periods))
    dates = last_paid(others.unionByName(paid).join(policies, "policy_id", "left_semi"))
    anew = marts.fct_member_churn(s.with_cancellations(mine), dates)
    same = stored_churn(store, s).filter(in_periods("cancel_period", churned)).withColumn("key", _key()).join(keys, "key", "left_anti").drop("key")
    return same.unionByName(anew)


def touched_by_dimensions(
    s: Staged, members: DataFrame | None = None, policies: DataFrame | None = None, agents: DataFrame | None = None
) -> list[str | None]:
    """Months whose payments a changed member (``member_id``), policy (``policy_id``) or agent
    (``agent_id``) reaches. Members, policies and agents are read as they are now, so those
    months need a refresh; ``refresh`` finds the months of churn by itself."""
    hits = []
    if agents is not None:
        theirs = s.members.join(agents.select("agent_id").distinct(), "agent_id", "left_semi").select("member_id")
        members = theirs if members is None else members.select("member_id").unionByName(theirs)
    if members is not None:
        hits.append(s.payments.join(members.select("member_id").distinct(), "member_id", "left_semi"))
    if policies is not None:
        hits.append(s.payments.join(policies.select("policy_id").distinct(), "policy_id", "left_semi"))
    found = [hit.select("due_period") for hit in hits]
    if not found:
        return []
    stacked = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return [row[0] for row in stacked.distinct().collect()]
