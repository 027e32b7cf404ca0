from pyspark.sql import functions as F

from conftest import AS_OF, TESTDATA, rows

from coverloom.operators.staging import Staged
from coverloom.schemas import RAW_SCHEMAS
from coverloom.sources.order_tables import OrderTables, _padded


def test_padding_never_cuts(spark):
    keys = spark.createDataFrame([(7,), (123456,), (1234567890,)], "k long")
    assert rows(keys.select(_padded("AGT", 6, F.col("k")).alias("id"))) == [("AGT000007",), ("AGT123456",), ("AGT1234567890",)]


def test_tables_have_the_raw_schemas(spark):
    tables = OrderTables(spark, TESTDATA)
    for table, schema in RAW_SCHEMAS.items():
        found = tables[table].schema
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in schema], table


def test_ids_are_unique_and_keys_resolve(spark):
    t = OrderTables(spark, TESTDATA)
    for table, key in {"agents": "agent_id", "members": "member_id", "policies": "policy_id", "payments": "payment_id"}.items():
        assert t[table].count() == t[table].select(key).distinct().count()
    assert t.payments.join(t.policies, "policy_id", "left_anti").count() == 0
    assert t.members.join(t.agents, "agent_id", "left_anti").count() == 0
    # The last agent has no members, and labels come in mixed case.
    assert t.agents.join(t.members, "agent_id", "left_anti").count() == 1
    assert {r[0] for r in t.payments.select("payment_status").distinct().collect()} == {"Paid", "Paid_Late", "Failed"}


def test_agents_bill_under_several_carriers(spark):
    s = Staged(OrderTables(spark, TESTDATA), AS_OF)
    carriers = s.members.groupBy("agent_id").agg(F.count_distinct("carrier").alias("n"))
    assert carriers.filter("n > 1").count() > 0
