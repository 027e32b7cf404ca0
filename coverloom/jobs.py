"""Jobs for spark-submit.

    seed   CSV files into typed raw tables
    build  raw tables into marts; with --gated a mart is only replaced if its checks pass
    check  the data checks over raw tables and marts; the exit code tells whether all passed
    report the answers to all questions and dashboard datasets, as Parquet
    load   a feed of new payments into the stored payments and the marts they touch
    refresh brings the marts up to date: new cancellations, and with --agents, --members or
           --policies (Parquet with the changed ids) the months those reach
    reset  forgets all merged payments and goes back to the raw tables

    spark-submit coverloom/jobs.py build --raw /data/raw --marts /data/marts --as-of 2024-12-31
"""

from __future__ import annotations

import argparse
import inspect
import sys
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverloom.operators import quality
from coverloom.operators.gate import Rejected
from coverloom.operators.staging import Staged
from coverloom.plans import warehouse
from coverloom.plans.reports import reports
from coverloom.schemas import RAW_SCHEMAS
from coverloom.session import clean_up, folders_made, open_session
from coverloom.sources import read_raw
from coverloom.sources.store import Store
from coverloom.streaming.payments import merge_feed, payment_feed

MARTS = ("dim_agents", "fct_payments", "fct_member_churn", "agent_commission_summary")


def seed(spark: SparkSession, csv: str, raw: str, line_breaks: bool = False) -> None:
    tables = read_raw(spark, csv, "csv", line_breaks=line_breaks)
    for table in RAW_SCHEMAS:
        tables[table].write.mode("overwrite").parquet(f"{raw}/{table}.parquet")


def build(
    spark: SparkSession, raw: str, marts: str, as_of: date, loaded_at: datetime = warehouse.FIRST_LOAD, gated: bool = False
) -> None:
    warehouse.start(Store(spark, marts), Staged(read_raw(spark, raw), as_of), loaded_at, gated)


def reset(spark: SparkSession, raw: str, marts: str, as_of: date, loaded_at: datetime = warehouse.FIRST_LOAD) -> None:
    warehouse.reset(Store(spark, marts), Staged(read_raw(spark, raw), as_of), loaded_at)


def refresh(
    spark: SparkSession, raw: str, marts: str, as_of: date, agents: str | None = None, members: str | None = None,
    policies: str | None = None,
) -> None:
    store, s = Store(spark, marts), Staged(read_raw(spark, raw), as_of)
    changed = {k: spark.read.parquet(v) for k, v in (("agents", agents), ("members", members), ("policies", policies)) if v}
    stored = s.with_payments(warehouse.stored_payments(store, s, columns=warehouse.REACHED_BY))
    warehouse.refresh(store, s, warehouse.touched_by_dimensions(stored, **changed))


def check(spark: SparkSession, raw: str, marts: str) -> DataFrame:
    """The failed checks. Reads the stored marts: nothing is computed twice to be checked."""
    store, tables = Store(spark, marts), read_raw(spark, raw)
    found = quality.report({
        **{table: (lambda table=table: tables[table]) for table in RAW_SCHEMAS},
        **{mart: (lambda mart=mart: store.read(mart)) for mart in MARTS},
    })
    return found.filter(~F.col("passed")).drop("passed")


def report(spark: SparkSession, raw: str, marts: str, out: str, as_of: date) -> None:
    for name, frame in reports(Store(spark, marts), Staged(read_raw(spark, raw), as_of)).items():
        frame.write.mode("overwrite").parquet(f"{out}/{name}")


def load(spark: SparkSession, feed: str, raw: str, marts: str, checkpoint: str, as_of: date, format: str = "parquet") -> None:
    """Takes the files that arrived since the last run, and stops."""
    query = merge_feed(
        payment_feed(spark, feed, format), Store(spark, marts), checkpoint,
        dimensions=lambda: Staged(read_raw(spark, raw), as_of),
    )
    query.awaitTermination()


JOBS = {"seed": seed, "build": build, "check": check, "report": report, "load": load, "refresh": refresh, "reset": reset}
KINDS = {"as_of": date.fromisoformat, "loaded_at": datetime.fromisoformat}


def main(arguments: list[str], spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="coverloom")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        command = jobs.add_parser(name)
        for option, given in list(inspect.signature(job).parameters.items())[1:]:
            flag, needed = f"--{option.replace('_', '-')}", given.default is inspect.Parameter.empty
            if given.default is False:
                command.add_argument(flag, action="store_true")
            else:
                command.add_argument(flag, required=needed, default=None if needed else given.default, type=KINDS.get(option, str))
    given = vars(parser.parse_args(arguments))
    job = given.pop("job")
    session, before = spark or open_session(job), folders_made()
    try:
        result = JOBS[job](session, **given)
        failed = result.collect() if result is not None else []  # one row per failed check at the most
    except Rejected as rejected:
        print(rejected)
        return 1
    finally:
        clean_up(session, before)
    for row in failed:
        print(*[f"{k}={v}" for k, v in row.asDict().items()])
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
