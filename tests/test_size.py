"""What keeps memory, disk and shuffles in proportion to the input."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from conftest import TESTDATA, rows

from coverloom.operators import slicing, versions
from coverloom.operators.staging import Staged
from coverloom.plans import marts
from coverloom.plans.catalog import CatalogMarts
from coverloom.session import MB, REDUCER_BYTES, fit_reducers, folders_made, input_bytes, tune
from coverloom.sources import order_tables

BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
INITIAL, ADVISORY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@pytest.fixture
def settings(spark):
    names = (INITIAL, ADVISORY, BROADCAST, "spark.sql.shuffle.partitions")
    before = {k: spark.conf.get(k, None) for k in names}
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_reducers_grow_with_the_input(spark, settings):
    first = {}
    for size in (MB, 1000 * MB, 6000 * MB):
        fit_reducers(spark, size)
        first[size] = int(spark.conf.get(INITIAL))
        assert int(spark.conf.get(ADVISORY)) == REDUCER_BYTES
    assert first[MB] == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert first[1000 * MB] == 625 and first[6000 * MB] == 3750


def test_registered_queries_fit_their_reducers(spark, settings, monkeypatch):
    seen = []
    monkeypatch.setattr(registered, "fit_reducers", lambda session, size: seen.append(size) or session)
    registered.queries()["q1_monthly_revenue"](spark, TESTDATA)
    assert seen == [input_bytes(spark, *[f"{TESTDATA}/{t}.parquet" for t in ("supplier", "customer", "orders", "lineitem")])] and seen[0] > 0


def test_a_step_leaves_no_shuffle_files(spark):
    tune(spark)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    frame = spark.range(1000).groupBy(F.col("id") % 7).count()
    assert frame.count() == 7 and len(frame.collect()) == 7 and len(frame.collect()) == 7  # and can be used again


def test_a_load_in_steps_keeps_its_store_only(spark):
    made = folders_made()
    store = registered._loaded_in_steps.__wrapped__(spark, TESTDATA)
    assert folders_made() == made + 1 and store.read("payment_rejects").count() > 0


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_checks_work_the_raw_tables_out_once(spark):
    kept, plain = registered._tables(spark, TESTDATA), registered._tables_of(registered._staged(spark, TESTDATA))
    made = folders_made()
    for table in ("policies", "payments", "fct_payments", "cancellations"):
        frame = kept[table]()
        plan = _plan(frame)
        assert "raw-p" in plan and "lineitem" not in plan and "orders" not in plan, table
        assert frame.schema.names == plain[table]().schema.names and frame.exceptAll(plain[table]()).isEmpty() and frame.count() == plain[table]().count()
    assert folders_made() == made + 2


def test_dirty_payments_that_come_twice_are_read_once(spark):
    dirty = registered._dirty(spark, TESTDATA).raw.payments
    assert _plan(dirty).count("lineitem.parquet") == 1
    clean, hit = registered._staged(spark, TESTDATA).raw.payments, "policy_id like '%88'"
    assert dirty.filter(hit).count() == 2 * clean.filter(hit).count() > 0
    assert dirty.count() == clean.count() + clean.filter(hit).count()


def test_payments_are_dealt_once_for_both_kinds_of_versions(staged, spark, monkeypatch):
    s = staged(
        members=[dict(member_id="M1"), dict(member_id="M2")],
        payments=[dict(payment_id=f"{m}{k}", member_id=m, due_date=date(2024, k, 15)) for m in ("M1", "M2", "M3") for k in range(1, 7)],
    )
    owners = spark.createDataFrame(
        [("M1", date(2024, 2, 1), "A1"), ("M1", date(2024, 4, 1), "A2"), ("M2", date(2024, 1, 1), None), ("M2", date(2024, 3, 1), "A9"), ("M2", date(2024, 5, 1), "A1")],
        "member_id string, valid_from date, agent_id string",
    )
    agents = spark.createDataFrame(
        [("A1", date(2024, 3, 1), "n", "g", "gold"), ("A1", date(2024, 4, 1), "n", "g", "never"), ("A1", date(2024, 6, 1), "n", "g", "platinum"), ("A2", date(2024, 5, 1), "m", "g", None), ("A2", date(2024, 6, 1), "m", "h", "silver")],
        "agent_id string, valid_from date, agent_name string, agency_name string, agent_tier string",
    )
    dealt, join = [], versions.as_of_join
    monkeypatch.setattr(versions, "as_of_join", lambda facts, *others: dealt.append("payment_id" in facts.columns) or join(facts, *others))
    found = versions.fct_payments_as_of(s, owners, agents)
    assert dealt == [False, True]
    # What deals them to the policies and to the members has ended.
    assert "placed-payments" in (moved := found._jdf.queryExecution().executedPlan().toString()) and "(policy_id" not in moved
    plain = versions.as_of_join(versions.as_of_join(s.payments, owners, "member_id", "due_date"), agents, "agent_id", "due_date")
    shown = ("payment_id", "agent_id", "agent_name", "agency_name", "agent_tier")
    assert rows(found, *shown) == rows(plain, *shown) and found.count() == 18
    assert ("M14", "A2", None, None, None) in rows(found, *shown) and ("M25", "A1", "n", "g", "never") in rows(found, *shown)


def test_catalog_payments_are_worked_out_once(spark, staged, monkeypatch):
    made, store = [], CatalogMarts(spark, "size_", buckets=2, hot_rows=2)
    s = staged(payments=[dict(payment_id=str(k), policy_id="hot" if k < 3 else f"P{k}") for k in range(9)])
    monkeypatch.setattr(store, "_bucketed", lambda frame, name: made.append((name, frame)))
    monkeypatch.setattr(store, "_plain", lambda frame, name: made.append((name, frame)))
    monkeypatch.setattr(store, "table", lambda name: dict(made)[name])
    store.store_tables(s)
    for name, n in (("payments", 6), ("payments_hot", 3)):
        frame = dict(made)[name]
        assert "catalog-payments" in frame._jdf.queryExecution().executedPlan().toString() and frame.count() == n
        assert frame.columns == s.payments.columns or set(frame.columns) == set(s.payments.columns)


@pytest.fixture
def many_agents(spark, tmp_path):
    """51 suppliers with one twice, customers 1 to 500 dealt to 50 agents, orders and lines. Some keys are
    missing, some come twice: customers, and orders that another agent's customer has signed as well."""
    twice = lambda frame, rows: frame.unionByName(frame.filter(rows))
    suppliers = spark.range(1, 51).selectExpr("id as s_suppkey", "concat('Supplier', id) as s_name", "cast(id % 25 as int) as s_nationkey")
    customers = spark.range(1, 501).selectExpr(
        "if(id = 500, null, id) as c_custkey", "concat('Customer#', id) as c_name", "cast(id % 25 as int) as c_nationkey",
        "element_at(array('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'), cast(id % 4 + 1 as int)) as c_mktsegment",
    )
    orders = spark.range(1, 6001).selectExpr(
        "if(id % 997 = 0, null, id) as o_orderkey", "if(id % 991 = 0, null, id % 499 + 1) as o_custkey",
        "element_at(array('F', 'O', 'P'), cast(id % 3 + 1 as int)) as o_orderstatus",
        "cast(date_add(date '1996-01-01', cast(id % 1500 as int)) as timestamp_ntz) as o_orderdate",
        "concat(id % 5 + 1, '-X') as o_orderpriority",
    )
    anothers = orders.filter("o_orderkey % 7 = 0").withColumn("o_custkey", F.col("o_custkey") % 499 + 2)
    lines = spark.range(24000).selectExpr(
        "if(id % 983 = 0, null, id div 4 + 1) as l_orderkey", "id * 7919 % 100003 as l_partkey", "id * 31 % 50 + 1 as l_suppkey",
        "cast(id % 4 + 1 as int) as l_linenumber", "cast(id % 50 as double) as l_quantity", "(id % 11) / 100D as l_discount",
        "element_at(array('R', 'A', 'N'), cast(id % 3 + 1 as int)) as l_returnflag",
        "cast(date_add(date '1996-02-01', cast(id % 1700 as int)) as timestamp_ntz) as l_shipdate",
    )
    tables = {
        "supplier": twice(suppliers, "s_suppkey = 7"), "customer": twice(customers, "c_custkey in (57, 107)"),
        "orders": orders.unionByName(anothers), "lineitem": twice(lines, "l_orderkey % 13 = 0"),
    }
    for name, frame in tables.items():
        frame.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_book_of_one_agent_moves_no_other_orders(spark, settings, monkeypatch, many_agents):
    spark.conf.set(BROADCAST, "100k")
    steps, write = [], order_tables.written_small
    monkeypatch.setattr(order_tables, "written_small", lambda frame, purpose: steps.append(_plan(frame)) or write(frame, purpose))
    book = registered.queries()["agent_book"](spark, many_agents)
    assert len(steps) == 4
    for text in (*steps, _plan(book)):
        assert not re.search(r"Exchange hashpartitioning\((l_orderkey|o_orderkey|o_custkey|c_custkey|policy_id)", text)
    whole = registered._staged(spark, many_agents)
    expected = registered._shown(lambda *_: slicing.agent_book(marts.fct_payments(whole), whole.agents, "Agent7@Example.com"))(spark, many_agents)
    assert 0 < expected.count() < marts.fct_payments(whole).count() / 10
    # Orders of this agent's members that another agent's customer has signed too.
    assert expected.groupBy("payment_id").count().filter("count > 1").count() > 0
    assert book.exceptAll(expected).isEmpty() and expected.exceptAll(book).isEmpty()


def test_book_is_cut_from_the_payments_given(spark, many_agents):
    s = Staged(order_tables.OrderTables(spark, many_agents), date(2001, 9, 30))
    given = s.payments.filter("payment_status = 'failed'")
    own, all_own = (slicing.payments_of_agent(x, "agent7@example.com") for x in (s.with_payments(given), s))
    assert rows(own.payments) == rows(all_own.payments.filter("payment_status = 'failed'")) != []
    assert own.payments.join(own.members, "member_id", "left_anti").isEmpty() and own.payments.join(own.policies, "policy_id", "left_anti").isEmpty()
    assert rows(own.cancellations, "cancellation_id") == rows(s.cancellations, "cancellation_id")
    assert slicing.payments_of_agent(s, "nobody@example.com").payments.isEmpty()
