"""The five raw tables derived from order-processing tables.

supplier -> agents, customer -> members, orders -> policies, lineitem -> payments,
cancelled orders -> cancellations. Labels come out in mixed case and names with stray
blanks on purpose: staging has to clean them.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverloom.functions import choose, lookup
from coverloom.operators.terms import cancellation_terms, policy_terms
from coverloom.schemas import LIST_PREMIUMS, MONEY, RAW_SCHEMAS
from coverloom.session import written_once, written_small
from coverloom.sources.raw import RawTables

AS_OF = date(2001, 9, 30)

# The source columns in use; stating them saves a look into every file for its schema.
SCHEMAS = {
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
}

# Fixed values of the derivation.
STATES = {0: "wa", 1: "in", 2: "oh", 3: "tx", 4: "ny", 5: "ca", 6: "fl", 7: "or", 8: "va", 9: "nm"}
CARRIERS = {0: "MetLife", 1: "VSP", 2: "Zurich"}
METHODS = {0: "credit_card", 1: "ACH", 2: "check"}
PLAN_BY_SEGMENT = {
    "AUTOMOBILE": "Dental Basic",
    "BUILDING": "Dental Premium",
    "FURNITURE": "Vision Basic",
    "HOUSEHOLD": "Vision Premium",
}
OTHER_PLAN = "Dental+Vision Bundle"
TERM_BY_PRIORITY = {"1": 6, "2": 12, "3": 12, "4": 24, "5": 36}
STATUS_BY_FLAG = {"F": "Cancelled", "O": "Expired", "P": "Active"}


def _padded(prefix: str, width: int, key: Column) -> Column:
    # Not lpad(), which also cuts: a key wider than the pad keeps all its digits.
    text = key.cast("string")
    return F.concat(F.lit(prefix), F.repeat(F.lit("0"), width - F.length(text)), text)


def _state(nation: Column) -> Column:
    return lookup(nation % 10, STATES)


def _shaped(frame: DataFrame, table: str) -> DataFrame:
    return frame.select(*[F.col(f.name).cast(f.dataType) for f in RAW_SCHEMAS[table].fields])


class OrderTables(RawTables):
    """The raw tables over one folder of order-processing tables. Every source file is opened
    once, and frames that several tables share are built once. Those in ``keep``, of "policies"
    and "payments", are worked out once too, when first asked for, and written where all
    executors can read them: for plans that use them several times."""

    def __init__(self, spark: SparkSession, sf_dir: str, keep: Collection[str] = ()):
        self._spark = spark
        self._dir = sf_dir
        self._keep = keep
        self._opened: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._spark.read.schema(SCHEMAS[name]).parquet(f"{self._dir}/{name}.parquet")
        return self._opened[name]

    def _kept(self, table: str, frame: DataFrame) -> DataFrame:
        return written_once(frame, f"raw-{table}") if table in self._keep else frame

    def of_members(self, members: DataFrame) -> OrderTables:
        """The orders with a key that one of the members has signed, be it another's row, because
        policies are found by that key. Each step is written before the next, larger table meets it:
        Catalyst sees its real size then, and few members reach orders and lineitem by broadcast."""
        customers = written_small(self._member_keys.join(members, "member_id", "left_semi").select("c_custkey"), "own-customers")
        orders = self._table("orders")
        signed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")
        same_keys = orders.join(written_small(signed, "own-order-keys"), "o_orderkey", "left_semi")
        own = OrderTables(self._spark, self._dir)
        own._opened = {**self._opened, "orders": written_small(same_keys, "own-orders")}
        own._with_terms = written_small(own._with_terms, "own-policies")
        return own

    @cached_property
    def agents(self) -> DataFrame:
        key, nation = F.col("s_suppkey"), F.col("s_nationkey")
        tier = choose(
            [(key % 10 <= 3, "Bronze"), (key % 10 <= 6, "Silver"), (key % 10 <= 8, "Gold")], "Platinum"
        )
        return _shaped(
            self._table("supplier").select(
                _padded("AGT", 6, key).alias("agent_id"),
                F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("agent_name"),
                F.concat(F.lit(" Agency "), nation.cast("string")).alias("agency_name"),
                _state(nation).alias("state"),
                F.concat(F.lit("Agent"), key.cast("string"), F.lit("@Example.com")).alias("email"),
                F.lit(None).alias("phone"),
                F.date_add(F.lit(date(1990, 1, 5)), (key * 37 % 1900).cast("int")).alias("hire_date"),
                (key % 8 != 0).alias("is_active"),
                tier.alias("tier"),
            ),
            "agents",
        )

    @cached_property
    def _member_keys(self) -> DataFrame:
        """c_custkey with the member columns policies need."""
        suppliers = self._table("supplier").agg(F.count(F.lit(1))).scalar()
        key = F.col("c_custkey")
        return self._table("customer").select(
            "*",
            _padded("MEM", 9, key).alias("member_id"),
            _padded("AGT", 6, key % (suppliers - 1)).alias("agent_id"),
            lookup(F.col("c_nationkey") % 3, CARRIERS).alias("carrier"),
            lookup(F.col("c_mktsegment"), PLAN_BY_SEGMENT, OTHER_PLAN).alias("plan_type"),
        )

    @cached_property
    def members(self) -> DataFrame:
        key = F.col("c_custkey")
        return _shaped(
            self._member_keys.select(
                "member_id",
                F.lit(" Customer").alias("first_name"),
                F.concat(F.substr("c_name", F.lit(10)), F.lit(" ")).alias("last_name"),
                F.concat(F.lower("c_name"), F.lit("@Example.com")).alias("email"),
                F.lit(None).alias("phone"),
                F.date_add(F.lit(date(1935, 1, 1)), (key * 7919 % 24000).cast("int")).alias("dob"),
                _state(F.col("c_nationkey")).alias("state"),
                _padded("", 5, key * 13 % 100000).alias("zip_code"),
                F.date_add(F.lit(date(1994, 6, 15)), (key % 180).cast("int")).alias("enrollment_date"),
                "agent_id", "carrier", "plan_type",
            ),
            "members",
        )

    @cached_property
    def signed_policies(self) -> DataFrame:
        """Orders as signed contracts, before their terms are worked out."""
        members = self._member_keys.select("c_custkey", "member_id", "agent_id", "carrier", "plan_type")
        key = F.col("o_orderkey")
        base_cents = lookup(F.col("plan_type"), {p: int(v * 100) for p, v in LIST_PREMIUMS.items()}).cast("bigint")
        cents = F.floor(base_cents * (key % 101 + 950) / 1000)
        status = choose(
            [(key % 33 == 0, "Pending"), *[(F.col("o_orderstatus") == k, v) for k, v in STATUS_BY_FLAG.items()]], None
        )
        return (
            self._table("orders")
            .join(members, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                "o_orderkey",
                _padded("POL", 9, key).alias("policy_id"),
                "member_id", "agent_id", "carrier", "plan_type",
                F.to_date("o_orderdate").alias("signed_on"),
                lookup(F.substring("o_orderpriority", 1, 1), TERM_BY_PRIORITY).cast("bigint").alias("term_months"),
                (cents.cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast(MONEY).alias("monthly_premium"),
                status.alias("status"),
            )
        )

    @cached_property
    def _with_terms(self) -> DataFrame:
        return self._kept("policies", policy_terms(self.signed_policies))

    @cached_property
    def policies(self) -> DataFrame:
        return _shaped(self._with_terms, "policies")

    @cached_property
    def payments(self) -> DataFrame:
        policies = self._with_terms.filter(F.col("status") != "Pending")
        failed = (F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.085)
        late = (F.col("l_returnflag") == "A") & (F.col("l_discount") > 0.075)
        status = choose([(failed, "Failed"), (late, "Paid_Late")], "Paid")
        quantity = F.col("l_quantity").cast("int")
        paid = choose(
            [
                (F.col("payment_status") == "Paid", F.date_add("due_date", quantity % 4)),
                (F.col("payment_status") == "Paid_Late", F.date_add("due_date", quantity % 27 + 4)),
            ],
            None,
        )
        number = F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate").cast("string")
        )
        payments = _shaped(
            self._table("lineitem")
            .join(policies, F.col("l_orderkey") == F.col("o_orderkey"))
            .withColumn("due_date", F.add_months("effective_date", F.col("l_linenumber") - 1))
            .withColumn("payment_status", status)
            .select(
                F.concat(F.lit("PAY"), number).alias("payment_id"),
                "policy_id", "member_id", "due_date",
                paid.alias("paid_date"),
                F.col("monthly_premium").alias("amount_due"),
                F.when(F.col("payment_status") == "Failed", F.lit(0).cast(MONEY))
                .otherwise(F.col("monthly_premium")).alias("amount_paid"),
                "payment_status",
                lookup(F.col("l_suppkey") % 3, METHODS).alias("payment_method"),
                "carrier", "plan_type",
            ),
            "payments",
        )
        return self._kept("payments", payments)

    @cached_property
    def cancelled_policies(self) -> DataFrame:
        key, slot = F.col("o_orderkey"), F.col("o_orderkey") % 20
        reason = choose(
            [
                (slot <= 6, "NON_PAYMENT"), (slot <= 11, "member_request"), (slot <= 14, "employer_change"),
                (slot <= 16, "moved_out_of_area"), (slot <= 18, "plan_upgrade"),
            ],
            "deceased",
        )
        return (
            self._with_terms.filter(F.col("status") == "Cancelled")
            .withColumns({
                "cancellation_id": _padded("CAN", 9, key),
                "cancellation_date": F.date_add("effective_date", (key * 31 % 300).cast("int") + 30),
                "cancellation_reason": reason,
            })
        )

    @cached_property
    def cancellations(self) -> DataFrame:
        return _shaped(cancellation_terms(self.cancelled_policies), "cancellations")
