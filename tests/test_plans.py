"""The physical plans are what makes the jobs hold at size, so they are tested too."""

import re
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, rows

from coverloom.operators.slicing import calendar_year, payments_of_agent
from coverloom.operators.staging import Staged
from coverloom.plans import analyst, dashboard, marts, warehouse
from coverloom.schemas import RAW_SCHEMAS
from coverloom.session import RUNTIME_SETTINGS, shared_folder, sizing
from coverloom.sources import read_raw
from coverloom.sources.store import Store, in_periods

PACKAGE = Path(__file__).resolve().parents[1] / "coverloom"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_no_hint_and_no_local_checkpoint_in_the_package():
    code = "".join(p.read_text() for p in PACKAGE.rglob("*.py") if "llm" not in p.parts)
    assert not re.search(r"\bbroadcast\(\w|localCheckpoint\(|crossJoin\(|\.toPandas\(|\.rdd\b", code)


@pytest.fixture(scope="module")
def stored(spark, raw, tmp_path_factory):
    """Raw tables in Parquet, as a job would find them."""
    base = str(tmp_path_factory.mktemp("raw"))
    tables = raw()
    for table in RAW_SCHEMAS:
        tables[table].write.parquet(f"{base}/{table}.parquet")
    return Staged(read_raw(spark, base), AS_OF)


def scans(text: str, table: str) -> list[str]:
    return [line for line in text.splitlines() if "FileScan" in line and f"/{table}.parquet" in line]


def columns(line: str) -> set[str]:
    return set(re.findall(r"(\w+):", line.split("ReadSchema: struct<")[1]))


def test_scans_read_only_the_columns_they_need(stored):
    (line,) = scans(plan(analyst.monthly_revenue(stored.payments)), "payments")
    assert columns(line) == {"due_date", "amount_due", "amount_paid", "payment_status"}
    (line,) = scans(plan(dashboard.plan_mix(stored.payments)), "payments")
    assert columns(line) == {"plan_type", "amount_paid"}
    (line,) = scans(plan(marts.dim_agents(stored)), "cancellations")
    assert columns(line) == {"agent_id", "cancellation_reason"}


@pytest.mark.parametrize("build", [
    lambda s: analyst.eligibility_gap(s.payments, s.cancellations, AS_OF),
    lambda s: analyst.churn_risk(s.payments, s.members, s.agents, AS_OF),
    lambda s: dashboard.collection_trend(s.payments, AS_OF),
    lambda s: dashboard.exec_kpis(marts.priced_payments(s), s.policies, AS_OF),
    lambda s: dashboard.freshness(s.payments, "due_date", AS_OF),
])
def test_date_windows_reach_the_scan(stored, build):
    (line,) = scans(plan(build(stored)), "payments")
    assert re.search(r"PushedFilters: \[.*(GreaterThanOrEqual|LessThanOrEqual)\(due_date", line)


def test_no_join_where_none_is_needed(stored):
    for frame in (
        analyst.monthly_revenue(stored.payments), dashboard.carrier_month(stored.payments),
        dashboard.churn_rate_by_plan(stored.cancellations, stored.policies),
    ):
        assert "Join" not in plan(frame)


def test_year_reaches_the_scan(stored):
    text = plan(analyst.top_agents(marts.agent_commission_summary(calendar_year(stored, AS_OF)), AS_OF))
    (line,) = scans(text, "payments")
    assert "GreaterThanOrEqual(due_date,2024-01-01)" in line and "LessThanOrEqual(due_date,2024-12-31)" in line


def test_book_of_one_agent_is_cut_down_before_the_fact_joins(stored):
    lines = plan(marts.fct_payments(payments_of_agent(stored, "ann@example.com"))).splitlines()
    scan = next(i for i, line in enumerate(lines) if "/payments.parquet" in line)
    nearest = next(line for line in reversed(lines[:scan]) if "Join" in line)
    assert "LeftSemi" in nearest


def test_top_agents_sorts_only_the_top(stored):
    assert "TakeOrderedAndProject" in plan(analyst.top_agents(marts.agent_commission_summary(stored), AS_OF))


def test_year_filter_runs_before_the_summary_joins(stored):
    text = plan(analyst.top_agents(marts.agent_commission_summary(stored), AS_OF))
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "/payments.parquet" in line)
    above = "\n".join(lines[max(0, scan - 3):scan])
    assert f"year(" in above and "= 2024" in above


def hot_tables(spark, n=60000):
    """Payments of which a third belongs to one policy and member, who has one agent."""
    hot = F.col("id") % 3 == 0
    key = F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    payments = spark.range(n).select(
        # Ids that do not compress, or the hot partition would look small.
        F.sha2(F.col("id").cast("string"), 256).alias("payment_id"), key.alias("policy_id"), key.alias("member_id"),
        F.lit(date(2024, 6, 1)).alias("due_date"), F.lit(date(2024, 6, 2)).alias("paid_date"),
        F.lit(Decimal("10.00")).cast("decimal(12,2)").alias("amount_due"),
        F.lit(Decimal("10.00")).cast("decimal(12,2)").alias("amount_paid"),
        F.lit("paid").alias("payment_status"), F.lit("ach").alias("payment_method"), F.lit("VSP").alias("carrier"),
        F.lit("Dental Basic").alias("plan_type"),
    )
    keys = payments.select("member_id").distinct()
    members = keys.select(
        "member_id", F.lit("a").alias("first_name"), F.lit("b").alias("last_name"), F.lit(None).alias("email"),
        F.lit(None).alias("phone"), F.lit(date(1990, 1, 1)).alias("dob"), F.lit("oh").alias("state"),
        F.lit("1").alias("zip_code"), F.lit(date(2023, 1, 1)).alias("enrollment_date"), F.lit("A1").alias("agent_id"),
        F.lit("VSP").alias("carrier"), F.lit("Dental Basic").alias("plan_type"),
    )
    policies = keys.select(
        F.col("member_id").alias("policy_id"), "member_id", F.lit("A1").alias("agent_id"), F.lit("VSP").alias("carrier"),
        F.lit("Dental Basic").alias("plan_type"), F.lit(date(2023, 1, 1)).alias("effective_date"),
        F.lit(date(2025, 1, 1)).alias("expiry_date"), F.lit(Decimal("10.00")).alias("monthly_premium"),
        F.lit(Decimal("120.00")).alias("annual_premium"), F.lit(Decimal("0.1000")).alias("commission_rate"),
        F.lit(Decimal("1.00")).alias("monthly_commission"), F.lit("active").alias("status"),
        F.lit(12).cast("long").alias("term_months"),
    )
    return payments, members, policies


@pytest.fixture
def small_cluster(spark):
    """Thresholds scaled down so that 60,000 rows look like a large table."""
    scaled = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "1k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in scaled}
    for key, value in scaled.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_key_is_split_and_totals_are_whole(spark, raw, small_cluster, tmp_path):
    given = raw()
    tables = {table: given[table] for table in RAW_SCHEMAS}
    tables["payments"], tables["members"], tables["policies"] = hot_tables(spark)
    for table, frame in tables.items():
        typed = [F.col(f.name).cast(f.dataType) for f in RAW_SCHEMAS[table].fields]
        frame.select(*typed).write.parquet(f"{tmp_path}/{table}.parquet")
    s = Staged(read_raw(spark, str(tmp_path)), AS_OF)
    fact = marts.fct_payments(s)
    (row,) = fact.groupBy().agg(F.count("payment_id").alias("n"), F.sum("commission_earned").alias("c")).collect()
    assert (row.n, row.c) == (60000, Decimal("60000.00"))
    summary = marts.agent_commission_summary(s)
    assert rows(summary, "agent_id", "total_payments_due", "active_members_billed", "total_commission_earned") == [
        ("A1", 60000, 40001, Decimal("60000.00"))
    ]
    last = fact.groupBy("collection_status").agg(
        F.max("payment_id"), F.sum("commission_earned"), F.max("agent_name")
    )
    last.collect()
    assert "skew=true" in plan(last)


def exchanges(spark, build) -> int:
    """Hash exchanges of a plan whose joins all shuffle."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(build()).count("Exchange hashpartitioning")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_summary_groups_by_member_without_moving_the_rows_again(spark, stored):
    assert exchanges(spark, lambda: marts.agent_commission_summary(stored)) <= 11


def test_gap_takes_active_members_out_first(spark, stored):
    build = lambda: analyst.eligibility_gap(stored.payments, stored.cancellations, AS_OF)
    assert exchanges(spark, build) <= 2


def test_risk_from_the_fact_needs_no_join(spark, stored):
    text = plan(analyst.churn_risk_from_fact(marts.fct_payments(stored), AS_OF))
    own = plan(marts.fct_payments(stored))
    assert text.count("Join") == own.count("Join")


def test_sizes_follow_the_input():
    small, large = sizing(10**9, 8), sizing(100 * 10**12, 8000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * 2**20)
    assert int(large["spark.sql.shuffle.partitions"]) == 100_000
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 10**9
    assert int(sizing(10**13, 800)["spark.sql.shuffle.partitions"]) == 12418


def test_refresh_reads_the_touched_months_only(spark, stored, tmp_path):
    store = Store(spark, str(tmp_path))
    warehouse.build(store, stored)
    facts = warehouse.StoredFacts(store, stored)
    for frame in (facts.by_carrier(), facts.by_month()):
        text = plan(frame.filter(in_periods("period", ["2024-06"])))
        (line,) = [x for x in text.splitlines() if "FileScan" in x and "commission_earned" in x]
        assert "2024-06" in line.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_shared_folder_is_the_one_the_session_names(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(base) and first != second


def test_settings_are_set(spark):
    for key, value in RUNTIME_SETTINGS.items():
        assert spark.conf.get(key) == value
