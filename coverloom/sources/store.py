"""Where tables are kept between jobs: plain Parquet folders, facts partitioned by month.

Every table is what ``spark.read.parquet("<base>/<table>")`` gives, for any reader. Months are
replaced by Spark's dynamic partition overwrite: the new files are written aside and take the
place of the old ones when the job commits, so a job that dies before leaves the old rows. A
month that has no rows any more is replaced by an empty file. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coverloom.session import shared_folder

# Table -> column it is partitioned by; other tables are one unit.
PARTITIONS = {
    "payment_batches": "due_period",
    "refreshed_months": "due_period",
    "fct_payments": "due_period",
    "paid_by_policy": "due_period",
    "fct_member_churn": "cancel_period",
    "agent_commission_summary": "period",
    "agent_commission_summary_monthly": "period",
}
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class Store:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    # ---- reading -------------------------------------------------------------------------

    def exists(self, table: str) -> bool:
        """Whether the table was written, with or without rows in the end."""
        try:
            self.spark.read.parquet(self.path(table))
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False
        return True

    def read(
        self, table: str, periods: Iterable[str | None] | None = None, schema: StructType | None = None
    ) -> DataFrame:
        """The table, or only the partitions named: the files of the others are not opened. A
        table without rows needs its ``schema``."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        frame = reader.parquet(self.path(table))
        if schema is not None:
            frame = frame.select(*schema.fieldNames())
        return frame if periods is None else frame.filter(in_periods(PARTITIONS[table], periods))

    def between(self, table: str, start: date | None = None, end: date | None = None) -> DataFrame:
        """The months from that of ``start`` to that of ``end``, for queries that go on to filter
        by day: a filter on the day alone would open the files of every month."""
        frame, month = self.read(table), F.col(PARTITIONS[table])
        if start is not None:
            frame = frame.filter(month >= f"{start:%Y-%m}")
        if end is not None:
            frame = frame.filter(month <= f"{end:%Y-%m}")
        return frame

    def periods(self, table: str) -> set[str | None]:
        """Partitions that have rows."""
        return {row[0] for row in self.read(table, schema=_period_schema(table)).distinct().collect()} if self.exists(table) else set()

    # ---- writing -------------------------------------------------------------------------

    def replace(self, table: str, frame: DataFrame) -> None:
        """Full rebuild."""
        if table in PARTITIONS:
            self.replace_periods(table, frame, self.periods(table))
            return
        # Spark empties the folder of an unpartitioned table first: what is to be written is
        # worked out before that.
        ready = shared_folder(self.spark, f"{table}-ready")
        frame.write.parquet(ready)
        self.spark.read.schema(frame.schema).parquet(ready).write.mode("overwrite").parquet(self.path(table))

    def replace_periods(self, table: str, frame: DataFrame, periods: Iterable[str | None]) -> None:
        """Gives the partitions named new rows and leaves every other one alone, but for those
        ``frame`` has rows of. ``frame`` must not read from the same table."""
        column, seen = PARTITIONS[table], Observation()
        # AQE sizes the output: a heavy month is cut into several files, light ones are merged.
        # The months written are seen on top of that, where no empty stage is optimised away.
        watched = frame.hint("rebalance", column).observe(seen, F.collect_set(F.coalesce(F.col(column), F.lit(_NULL_FOLDER))).alias("periods"))
        watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(self.path(table))
        emptied = {_NULL_FOLDER if p is None else p for p in periods} - set(seen.get["periods"])
        nothing = self.spark.createDataFrame([], StructType([f for f in frame.schema.fields if f.name != column]))
        for period in emptied & {_NULL_FOLDER if p is None else p for p in self.periods(table)}:
            nothing.coalesce(1).write.mode("overwrite").parquet(f"{self.path(table)}/{column}={period}")

    def append(self, table: str, frame: DataFrame) -> None:
        column, writer = PARTITIONS.get(table), frame.write
        if column:
            writer = frame.hint("rebalance", column).write.partitionBy(column)
        writer.mode("append").parquet(self.path(table))

    def register_views(self, *tables: str) -> None:
        for table in tables:
            self.read(table).createOrReplaceTempView(table)


def _period_schema(table: str) -> StructType:
    return StructType().add(PARTITIONS[table], "string")


def in_periods(column: str, periods: Iterable[str | None]) -> Column:
    periods = list(periods)
    named = F.col(column).isin(*[p for p in periods if p is not None])
    return named | F.col(column).isNull() if None in periods else named


def outside_periods(column: str, periods: Iterable[str | None]) -> Column:
    return ~F.coalesce(in_periods(column, periods), F.lit(False))
