"""Declared data checks, run as one aggregation per table.

``report`` counts failures per check; ``failing_values`` lists what failed. NULL passes
every check but ``not_null``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.functions import lookup
from coverloom.schemas import (
    CANCELLATION_REASONS,
    CHURN_TYPES,
    COLLECTION_STATUSES,
    PAYMENT_STATUSES,
    PLAN_TYPES,
    POLICY_STATUSES,
    TIERS,
)
from coverloom.session import written_once

UNIQUE, NOT_NULL, ACCEPTED, RELATED, RANGE, SINGULAR = (
    "unique", "not_null", "accepted_values", "relationships", "accepted_range", "no_negative_commission",
)


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    column: str
    values: tuple[str, ...] = ()
    parent: str = ""
    low: int | None = None
    high: int | None = None

    def fails(self) -> Column:
        """True on a failing row, for the checks that look at one row at a time."""
        column = F.col(self.column)
        if self.kind == NOT_NULL:
            return column.isNull()
        if self.kind == ACCEPTED:
            return ~column.isin(*self.values)
        low = column < self.low if self.low is not None else F.lit(False)
        high = column > self.high if self.high is not None else F.lit(False)
        return low | high


# What is declared for each table.
CHECKS = (
    Check("agents", UNIQUE, "agent_id"),
    Check("agents", NOT_NULL, "agent_id"),
    Check("agents", NOT_NULL, "agent_name"),
    Check("agents", ACCEPTED, "tier", values=TIERS),
    Check("members", UNIQUE, "member_id"),
    Check("members", NOT_NULL, "member_id"),
    Check("members", NOT_NULL, "agent_id"),
    Check("members", RELATED, "agent_id", parent="agents"),
    Check("members", ACCEPTED, "plan_type", values=PLAN_TYPES),
    Check("policies", UNIQUE, "policy_id"),
    Check("policies", NOT_NULL, "policy_id"),
    Check("policies", NOT_NULL, "member_id"),
    Check("policies", RELATED, "member_id", parent="members"),
    Check("policies", ACCEPTED, "status", values=POLICY_STATUSES),
    Check("policies", NOT_NULL, "monthly_premium"),
    Check("payments", UNIQUE, "payment_id"),
    Check("payments", NOT_NULL, "payment_id"),
    Check("payments", NOT_NULL, "policy_id"),
    Check("payments", RELATED, "policy_id", parent="policies"),
    Check("payments", ACCEPTED, "payment_status", values=PAYMENT_STATUSES),
    Check("cancellations", UNIQUE, "cancellation_id"),
    Check("cancellations", NOT_NULL, "cancellation_id"),
    Check("cancellations", NOT_NULL, "policy_id"),
    Check("cancellations", RELATED, "policy_id", parent="policies"),
    Check("cancellations", ACCEPTED, "cancellation_reason", values=CANCELLATION_REASONS),
    Check("dim_agents", UNIQUE, "agent_id"),
    Check("dim_agents", NOT_NULL, "agent_id"),
    Check("dim_agents", ACCEPTED, "tier", values=TIERS),
    Check("dim_agents", RANGE, "cancellation_rate_pct", low=0, high=100),
    Check("fct_payments", UNIQUE, "payment_id"),
    Check("fct_payments", NOT_NULL, "payment_id"),
    Check("fct_payments", ACCEPTED, "payment_status", values=PAYMENT_STATUSES),
    Check("fct_payments", ACCEPTED, "collection_status", values=COLLECTION_STATUSES),
    Check("fct_payments", RANGE, "commission_earned", low=0),
    Check("fct_payments", SINGULAR, "commission_earned", low=0),
    Check("fct_member_churn", UNIQUE, "cancellation_id"),
    Check("fct_member_churn", NOT_NULL, "cancellation_id"),
    Check("fct_member_churn", ACCEPTED, "churn_type", values=CHURN_TYPES),
    Check("fct_member_churn", RANGE, "months_active", low=0),
    Check("agent_commission_summary", RANGE, "collection_rate_pct", low=0, high=100),
    Check("agent_commission_summary", RANGE, "failure_rate_pct", low=0, high=100),
)

Tables = dict[str, Callable[[], DataFrame]]


def _selected(kinds: Iterable[str] | None) -> list[Check]:
    return [c for c in CHECKS if kinds is None or c.kind in set(kinds)]


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---- counts --------------------------------------------------------------------------


def _steps(checks: dict[int, Check]) -> list[dict[int, Check]]:
    """The checks that share a pass: all of a table but ``relationships``, which are one each."""
    tables = [{i: c for i, c in checks.items() if c.table == table and c.kind != RELATED} for table in dict.fromkeys(c.table for c in checks.values())]
    return [own for own in tables if own] + [{i: c} for i, c in checks.items() if c.kind == RELATED]


def _settled(frame: DataFrame, apart: bool) -> DataFrame:
    return written_once(frame, "checked") if apart else frame


def report(tables: Tables, kinds: Iterable[str] | None = None, apart: bool = False) -> DataFrame:
    """One row per check: rows looked at, failures, passed.

    A failure is a failing row, and for ``unique`` a value that occurs more than once. All
    checks of a table but ``relationships`` share one pass over it. ``apart``: each pass is
    ended, and its shuffles are gone, before the next begins.
    """
    rows = []
    for step in _steps(dict(enumerate(_selected(kinds)))):
        own = list(step.values())
        first = own[0]
        counted = _count_orphans(tables[first.table](), tables[first.parent](), first) if first.kind == RELATED else _count_table(tables[first.table](), own)
        rows.append(_settled(counted, apart))
    return _stack(rows).withColumn("passed", F.col("failures") == 0)


def _count_table(frame: DataFrame, checks: list[Check]) -> DataFrame:
    unique = next((c for c in checks if c.kind == UNIQUE), None)
    by_row = [c for c in checks if c.kind != UNIQUE]
    flags = {f"_f{i}": c for i, c in enumerate(by_row)}
    counted = [F.count_if(c.fails()).alias(name) for name, c in flags.items()]
    if unique:
        # Row checks ride along on the shuffle that the uniqueness count needs anyway.
        frame = frame.groupBy(unique.column).agg(F.count(F.lit(1)).alias("_n"), *counted)
        repeated = F.col(unique.column).isNotNull() & (F.col("_n") > 1)
        totals = frame.agg(
            F.sum("_n").alias("_n"), F.count_if(repeated).alias("_u"), *[F.sum(name).alias(name) for name in flags]
        )
        flags["_u"] = unique
    else:
        totals = frame.agg(F.count(F.lit(1)).alias("_n"), *counted)
    results = [
        F.struct(
            F.lit(c.kind).alias("test"), F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"),
            F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("rows_checked"),
            F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias("failures"),
        )
        for name, c in flags.items()
    ]
    return totals.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def unique_together(frame: DataFrame, table: str, *columns: str) -> DataFrame:
    """The report's row for a key of several columns: keys that occur more than once. As in a
    single column, a key with a null in it is not compared."""
    known = reduce(and_, [F.col(c).isNotNull() for c in columns])
    keys = frame.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return keys.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows_checked"), F.count_if(known & (F.col("_n") > 1)).alias("failures"),
    ).select(
        F.lit(UNIQUE).alias("test"), F.lit(table).alias("table_name"), F.lit(", ".join(columns)).alias("column_name"), "rows_checked", "failures",
        (F.col("failures") == 0).alias("passed"),
    )


def _count_orphans(child: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    """Child and parent keys are stacked and counted, which takes one shuffle and no join; a
    key held by a third of the child rows is one row per task. Both name the key alike."""
    key = F.col(check.column).alias("_key")
    stacked = child.select(key, F.lit(1).alias("_n"), F.lit(False).alias("_known")).unionByName(
        parent.select(key, F.lit(0).alias("_n"), F.lit(True).alias("_known"))
    )
    keys = stacked.groupBy("_key").agg(F.sum("_n").alias("_n"), F.max("_known").alias("_known"))
    orphan = F.col("_key").isNotNull() & ~F.col("_known")
    return keys.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_checked"),
        F.coalesce(F.sum(F.when(orphan, F.col("_n"))), F.lit(0)).alias("failures"),
    ).select(
        F.lit(check.kind).alias("test"), F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"), "rows_checked", "failures",
    )


# ---- failing values ------------------------------------------------------------------


def failing_values(tables: Tables, kinds: Iterable[str] | None = None, apart: bool = False) -> DataFrame:
    """What failed: (test, table, column, value, n_records), one row per failing value.

    Each table is scanned once and yields (check, value) records: failing values, keys that
    have to be unique, foreign keys and the parent keys they need. One count per record,
    combined map-side, then answers all checks of all tables. ``apart``: the passes that
    ``report`` makes, each ended, and its shuffles gone, before the next begins.
    """
    checks = dict(enumerate(_selected(kinds)))
    return _stack([_settled(_failing(tables, step), apart) for step in (_steps(checks) if apart else [checks])])


def _failing(tables: Tables, checks: dict[int, Check]) -> DataFrame:
    needed = {c.table for c in checks.values()} | {c.parent for c in checks.values() if c.parent}
    frames = [_records(tables[table](), table, checks) for table in tables if table in needed]
    counted = _stack(frames).groupBy("check", "value").agg(
        F.sum("n").alias("n_records"), F.max("known").alias("known")
    )

    def numbers(kind: str) -> list[int]:
        return [i for i, c in checks.items() if c.kind == kind]

    number, n = F.col("check"), F.col("n_records")
    fails = (
        F.when(number.isin(*numbers(UNIQUE)), n > 1)
        .when(number.isin(*numbers(RELATED)), (n > 0) & ~F.col("known"))
        .otherwise(True)
    )
    return counted.filter(fails).select(
        lookup(number, {i: c.kind for i, c in checks.items()}).alias("test"),
        lookup(number, {i: c.table for i, c in checks.items()}).alias("table_name"),
        lookup(number, {i: c.column for i, c in checks.items()}).alias("column_name"),
        "value", "n_records",
    )


def _records(frame: DataFrame, table: str, checks: dict[int, Check]) -> DataFrame:
    found = []
    for i, c in checks.items():
        column = F.col(c.column)
        if c.table == table:
            counts = column.isNotNull() if c.kind in (UNIQUE, RELATED) else c.fails()
            found.append(F.when(counts, _record(i, column, n=1, known=False)))
        if c.parent == table:
            found.append(F.when(column.isNotNull(), _record(i, column, n=0, known=True)))
    # Dropping the empty slots after explode() stays in generated code; array_compact() does not.
    return frame.select(F.explode(F.array(*found)).alias("r")).filter(F.col("r").isNotNull()).select("r.*")


def _record(number: int, value: Column, n: int, known: bool) -> Column:
    return F.struct(
        F.lit(number).alias("check"), value.cast("string").alias("value"), F.lit(n).alias("n"),
        F.lit(known).alias("known"),
    )


def negative_commissions(payments: DataFrame) -> DataFrame:
    """Payments whose commission is below zero; there should be none."""
    return payments.filter(F.col("commission_earned") < 0).select("payment_id", "amount_paid", "commission_earned")
