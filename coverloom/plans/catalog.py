"""Marts as catalog tables whose big join needs no shuffle.

Payments and policies are written once as tables bucketed and sorted by policy, so every later
join of the two reads matching buckets side by side. A bucket cannot be cut, so policies with
more than ``hot_rows`` payments are set aside in a table of their own without buckets: their
join is shuffled, and AQE cuts it where it is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverloom.operators.enrich import with_collection_status, with_commission, with_member_context
from coverloom.operators.staging import Staged
from coverloom.plans.marts import PAYMENT_COLUMNS, count_rows
from coverloom.session import written_for, written_once

HOT_ROWS = 1_000_000


class CatalogMarts:
    """Tables ``<prefix>payments``, ``payments_hot``, ``policies`` and ``fct_payments``; the
    prefix may name a database: "marts."."""

    def __init__(self, spark: SparkSession, prefix: str, buckets: int, hot_rows: int = HOT_ROWS):
        self.spark, self.prefix, self.buckets, self.hot_rows = spark, prefix, buckets, hot_rows

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.prefix + name)

    def store_tables(self, s: Staged) -> None:
        """Payments and policies, dealt by policy, and statistics for the optimizer."""
        # Used three times below: worked out once, where all executors can read it.
        payments = written_once(s.payments, "catalog-payments")
        hot = payments.groupBy("policy_id").agg(count_rows().alias("n")).filter(F.col("n") > self.hot_rows).select("policy_id")
        self._plain(hot, "hot_policies")
        # Broadcast if the list is small enough, which its statistics tell.
        hot = self.table("hot_policies")
        self._bucketed(payments.join(hot, "policy_id", "left_anti"), "payments")
        self._plain(payments.join(hot, "policy_id", "left_semi"), "payments_hot")
        self._bucketed(s.policies, "policies")

    def _bucketed(self, frame: DataFrame, name: str) -> None:
        # Dealt as the buckets are, so that a bucket is one file.
        dealt = frame.repartition(self.buckets, "policy_id")
        dealt.write.mode("overwrite").format("parquet").bucketBy(self.buckets, "policy_id").sortBy("policy_id").saveAsTable(self.prefix + name)
        self._analyse(name, "policy_id")

    def _plain(self, frame: DataFrame, name: str) -> None:
        frame.write.mode("overwrite").format("parquet").saveAsTable(self.prefix + name)
        self._analyse(name, "policy_id")

    def _analyse(self, name: str, *columns: str) -> None:
        self.spark.sql(f"ANALYZE TABLE {self.prefix}{name} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")

    def priced_payments(self) -> DataFrame:
        """Payments with commission: ordinary policies bucket by bucket, hot ones shuffled."""
        ordinary, hot = (with_commission(self.table(name), self.table("policies")) for name in ("payments", "payments_hot"))
        return ordinary.unionByName(hot)

    def build_fact(self, s: Staged) -> None:
        fact = with_member_context(with_collection_status(self.priced_payments()), s.members, s.agents).select(*PAYMENT_COLUMNS)
        # Dealt by month: otherwise every task writes a file for every month. The joins end before that.
        with written_for(fact, "catalog-fact") as ready:
            dealt = ready.hint("rebalance", "due_period")
            dealt.write.mode("overwrite").format("parquet").partitionBy("due_period").saveAsTable(self.prefix + "fct_payments")
        self._analyse("fct_payments", "due_date", "carrier", "member_id")

    def drop(self) -> None:
        for name in ("fct_payments", "payments", "payments_hot", "policies", "hot_policies"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.prefix}{name}")
