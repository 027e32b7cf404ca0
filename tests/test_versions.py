"""As-of joins, checks at the gate, catalog tables."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from conftest import TESTDATA, rows

from coverloom import session
from coverloom.operators import gate, versions
from coverloom.operators.quality import report
from coverloom.plans import marts, warehouse
from coverloom.plans.catalog import CatalogMarts
from coverloom.sources.store import Store

FACTS, VERSIONS = "id int, key string, day date", "key string, valid_from date, label string"


@pytest.mark.parametrize("seed", range(3))
def test_as_of_join_against_a_plain_model(spark, seed):
    pick = random.Random(seed)
    day = lambda: date(2024, 1, 1) + timedelta(days=pick.randrange(60))
    given = [(pick.choice("abc"), day(), f"v{k}") for k in range(25)] + [(None, day(), "x"), ("a", None, "y"), ("d", day(), None)]
    facts = [(k, pick.choice(["a", "b", "c", "d", "e", None]), pick.choice([day(), day(), None])) for k in range(200)]
    facts += [facts[0]] * 2 + [(1000 + k, "a", day()) for k in range(300)]

    def held(key, on):
        able = [(d, v or "") for k, d, v in given if k is not None and k == key and d is not None and on is not None and d <= on]
        return (max(able)[1] or None) if able else None

    frame = spark.createDataFrame(facts, FACTS)
    found = versions.as_of_join(frame, spark.createDataFrame(given, VERSIONS), "key", "day", salts=3)
    assert rows(found) == sorted(((*f, held(f[1], f[2])) for f in facts), key=repr)
    assert versions.as_of_join(frame.limit(0), spark.createDataFrame([], VERSIONS), "key", "day").count() == 0
    with pytest.raises(ValueError, match="label"):
        versions.as_of_join(frame.withColumn("label", F.lit(1)), spark.createDataFrame(given, VERSIONS), "key", "day")


def test_a_hot_key_is_dealt_out(spark):
    """A key with nearly all facts: no group of the window holds more than a fair part of them."""
    facts = spark.range(20_000).select(F.col("id").cast("int").alias("id"), F.lit("hot").alias("key"), F.lit(date(2024, 1, 5)).alias("day"))
    salt = F.pmod(F.xxhash64("id", "key", "day"), F.lit(versions.SALTS))
    assert facts.groupBy(salt).count().agg(F.max("count")).first()[0] < 20_000 / versions.SALTS * 1.3
    found = versions.as_of_join(facts, spark.createDataFrame([("hot", date(2024, 1, 1), "v")], VERSIONS), "key", "day")
    assert found.filter("label = 'v'").count() == 20_000


def test_payments_keep_the_agent_of_their_due_date(staged, spark):
    s = staged(members=[dict(agent_id="A2")], agents=[dict(agent_id="A1"), dict(agent_id="A2", tier="Platinum")], payments=[
        dict(payment_id="1", due_date=date(2024, 1, 1)), dict(payment_id="2", due_date=date(2024, 5, 1)), dict(payment_id="3", due_date=date(2020, 1, 1)),
    ])
    members = spark.createDataFrame([("M1", date(2023, 1, 1), "A1"), ("M1", date(2024, 5, 1), "A2")], "member_id string, valid_from date, agent_id string")
    agents = s.agents.select("agent_id", F.lit(date(1990, 1, 1)).alias("valid_from"), "agent_name", "agency_name", F.col("tier").alias("agent_tier"))
    found = versions.fct_payments_as_of(s, members, agents)
    assert found.columns == list(marts.PAYMENT_COLUMNS)
    assert rows(found, "payment_id", "agent_id", "agent_tier") == [("1", "A1", "gold"), ("2", "A2", "platinum"), ("3", None, None)]


# ---- the gate ------------------------------------------------------------------------


def test_a_defect_leaves_the_former_mart(spark, staged, tmp_path):
    store, good = Store(spark, str(tmp_path / "marts")), staged(payments=[dict(payment_id="1")])
    assert gate.publish(store, "fct_payments", marts.fct_payments(good)) == 1
    bad = staged(payments=[dict(payment_id="2"), dict(payment_id=None), dict(payment_id="3", amount_paid=Decimal(-9), payment_status="Odd")])
    with pytest.raises(gate.Rejected) as found:
        gate.publish(store, "fct_payments", marts.fct_payments(bad))
    assert sorted((c.kind, c.column, n) for c, n in found.value.failures.items()) == [
        ("accepted_range", "commission_earned", 1), ("accepted_values", "payment_status", 1),
        ("no_negative_commission", "commission_earned", 1), ("not_null", "payment_id", 1),
    ]
    assert rows(spark.read.parquet(store.path("fct_payments")), "payment_id") == [("1",)]
    assert gate.publish(store, "fct_payments", marts.fct_payments(staged(payments=[dict(payment_id="4")]))) == 1
    assert rows(store.read("fct_payments"), "payment_id") == [("4",)]
    assert gate.publish(store, "fct_payments", marts.fct_payments(staged(payments=[]))) == 0
    assert gate.publish(store, "dim_agents", marts.dim_agents(good)) == 1


def test_observed_counts_equal_the_report(spark):
    tables = registered._tables_of(registered._dirty(spark, TESTDATA))
    observed = gate.observed_report({name: table() for name, table in tables.items()})
    assert rows(observed) == rows(report(tables, gate.ROW_KINDS).select(*observed.columns))
    assert observed.filter("not passed").count() > 5


def test_what_was_written_for_the_counts_is_gone(spark):
    before = session.folders_made()
    counted = registered.queries()["dq_observed"](spark, TESTDATA)
    left = session._made[before:]
    assert counted.count() == 29 and not [f for f in left if "-observed-" in f or "placed-payments" in f]


# ---- planted defects -----------------------------------------------------------------


def test_every_kind_of_check_fails_and_agents_differ(spark):
    found = registered.queries()["dirty_dq_report"](spark, TESTDATA)
    assert found.filter("failures > 0").select("test").distinct().count() == found.select("test").distinct().count() == 6
    s = registered._dirty(spark, TESTDATA)
    owners = s.members.select("member_id", F.col("agent_id").alias("owner"))
    differ = s.cancellations.join(owners, "member_id").filter(~F.col("agent_id").eqNullSafe(F.col("owner")))
    assert differ.count() > 20
    # Taking the member's agent for the cancellation's, or the other way round, shows.
    churn = marts.fct_member_churn(s)
    swapped = marts.fct_member_churn(s.with_cancellations(s.cancellations.drop("agent_id").join(s.members.select("member_id", "agent_id"), "member_id", "left")))
    assert rows(churn, "cancellation_id", "agent_id", "agent_name") != rows(swapped, "cancellation_id", "agent_id", "agent_name")


# ---- catalog tables ------------------------------------------------------------------


def test_ordinary_policies_are_joined_without_a_shuffle(spark):
    s = registered._staged(spark, TESTDATA)
    stored = CatalogMarts(spark, "bucketed_", buckets=4, hot_rows=6)
    stored.store_tables(s)
    stored.build_fact(s)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sides = str(stored.priced_payments()._jdf.queryExecution().executedPlan().toString()).split("bucketed_payments_hot")
        ordinary = [p for p in sides if "bucketed_payments" in p][0]
        plan = stored.priced_payments()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    first = plan[: plan.index("bucketed_payments_hot")]
    assert "Bucketed: true" in ordinary and first.count("Exchange") <= 1  # the hot side's own
    hot = stored.table("payments_hot").count()
    assert 0 < hot < s.payments.count() and hot + stored.table("payments").count() == s.payments.count()
    assert rows(stored.table("fct_payments"), *marts.PAYMENT_COLUMNS) == rows(marts.fct_payments(s))
    assert "rows" in str(spark.sql("DESCRIBE EXTENDED bucketed_payments").filter("col_name = 'Statistics'").first())
    stored.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_a_gated_build_stops_at_the_first_defect(spark, staged, tmp_path):
    store, good = Store(spark, str(tmp_path / "marts")), staged(agents=[dict(tier="gold")])
    warehouse.build(store, good, gated=True)
    before = {t: rows(store.read(t)) for t in ("dim_agents", "fct_payments", "fct_member_churn", "agent_commission_summary")}
    bad = staged(agents=[dict(tier="gold", agent_name="B")], payments=[dict(payment_status="lost")])
    with pytest.raises(gate.Rejected, match="fct_payments: accepted_values payment_status: 1"):
        warehouse.build(store, bad, gated=True)
    after = {t: rows(store.read(t)) for t in before}
    assert after["dim_agents"] != before["dim_agents"] and {t: r for t, r in after.items() if t != "dim_agents"} == {t: r for t, r in before.items() if t != "dim_agents"}


def test_a_month_of_the_catalog_fact_is_one_file(spark):
    s, width = registered._staged(spark, TESTDATA), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    stored = CatalogMarts(spark, "few_files_", buckets=4, hot_rows=6)
    stored.store_tables(s)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as over tables that are not small
    try:
        stored.build_fact(s)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", width)
    fact = stored.table("fct_payments")
    assert len(fact.inputFiles()) == fact.select("due_period").distinct().count()
    stored.drop()
