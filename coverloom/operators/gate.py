"""Data checks as a gate on publishing: they are counted while a mart is written.

The checks that look at one row at a time become observed metrics of the write itself, so they
cost no pass of their own. The rows go to a folder beside the mart; only if no check fails do
they take the mart's place.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from coverloom.operators.quality import ACCEPTED, CHECKS, NOT_NULL, RANGE, SINGULAR, Check
from coverloom.session import discard, shared_folder
from coverloom.sources.store import PARTITIONS, Store

ROW_KINDS = (NOT_NULL, ACCEPTED, RANGE, SINGULAR)
_REPORT = "test string, table_name string, column_name string, rows_checked bigint, failures bigint, passed boolean"


class Rejected(Exception):
    """A mart that was not published; ``failures`` are its failed checks and their counts."""

    def __init__(self, table: str, failures: dict[Check, int]):
        super().__init__(f"{table}: " + ", ".join(f"{c.kind} {c.column}: {n}" for c, n in failures.items()))
        self.failures = failures


def row_checks(table: str, checks: Iterable[Check] = CHECKS) -> list[Check]:
    return [c for c in checks if c.table == table and c.kind in ROW_KINDS]


def observed_write(frame: DataFrame, folder: str, checks: list[Check], partition: str | None = None) -> tuple[int, dict[Check, int]]:
    """Writes the frame; the rows written and the failures of every check, counted on the way."""
    seen, names = Observation(), {f"f{k}": c for k, c in enumerate(checks)}
    if partition:
        frame = frame.hint("rebalance", partition)
    watched = frame.observe(seen, F.count(F.lit(1)).alias("n"), *[F.count_if(c.fails()).alias(name) for name, c in names.items()])
    (watched.write.partitionBy(partition) if partition else watched.write).parquet(folder)
    counts = seen.get
    return counts["n"], {c: counts[name] for name, c in names.items()}


def publish(store: Store, table: str, frame: DataFrame, checks: Iterable[Check] | None = None) -> int:
    """Replaces a stored mart, if the new rows pass; the rows published. Otherwise ``Rejected``
    is raised, and the former mart stays readable as it was."""
    wanted = row_checks(table) if checks is None else list(checks)
    candidate = shared_folder(store.spark, f"{table}-candidate")
    n, counts = observed_write(frame, candidate, wanted, PARTITIONS.get(table))
    failures = {c: k for c, k in counts.items() if k}
    if failures:
        raise Rejected(table, failures)
    store.replace(table, store.spark.read.schema(frame.schema).parquet(candidate).select(*frame.columns))
    return n


def observed_report(tables: dict[str, DataFrame], checks: Iterable[Check] = CHECKS) -> DataFrame:
    """The row checks of every table, each counted by one write of it. What was written for the
    counts goes before the next table is."""
    spark, rows, checks = next(iter(tables.values())).sparkSession, [], list(checks)
    for table, frame in tables.items():
        own = row_checks(table, checks)
        if own:
            folder = shared_folder(spark, f"{table}-observed")
            n, counts = observed_write(frame, folder, own)
            discard(spark, folder)
            rows += [(c.kind, table, c.column, n, k, k == 0) for c, k in counts.items()]
    return spark.createDataFrame(rows, _REPORT)
