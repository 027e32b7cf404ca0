from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows

from coverloom.schemas import RAW_SCHEMAS
from coverloom.sources import GivenTables, read_raw
from coverloom.sources.raw import BAD_RECORD, read_csv, read_csv_split
from coverloom.sources.store import Store

AGENTS_CSV = '''agent_id,agent_name,agency_name,state,email,phone,hire_date,is_active,tier
A1,Ann Lee,"Lee, Sons and ""Co""",TN,ann@x.org,(555)010-0101x1,2020-02-29,True,bronze
A2,Bob Ray,Ray Inc,OH,bob@x.org,555.010.0102,2019-12-31,False,gold
'''
MEMBERS_CSV = '''member_id,first_name,last_name,email,phone,dob,state,zip_code,enrollment_date,agent_id,carrier,plan_type
M1,Mia,Member,m@x.org,1,1990-01-01,OH,00501,2023-01-15,A1,VSP,Dental Basic
'''


def test_csv_quoting_types_and_nulls(spark, tmp_path):
    path = tmp_path / "agents.csv"
    path.write_text(AGENTS_CSV)
    frame = read_csv(spark, str(path), "agents")
    assert frame.schema == RAW_SCHEMAS["agents"]
    assert rows(frame, "agency_name", "is_active") == [('Lee, Sons and "Co"', True), ("Ray Inc", False)]


def test_csv_line_break_inside_quotes(spark, tmp_path):
    path = tmp_path / "agents.csv"
    path.write_text(AGENTS_CSV.replace("Ray Inc", '"Ray\nInc"'))
    frame = read_csv(spark, str(path), "agents", line_breaks=True)
    assert rows(frame, "agency_name")[1] == ("Ray\nInc",)


def test_csv_keeps_leading_zeros(spark, tmp_path):
    path = tmp_path / "members.csv"
    path.write_text(MEMBERS_CSV)
    assert rows(read_csv(spark, str(path), "members"), "zip_code") == [("00501",)]


def test_csv_row_that_does_not_fit_stops_the_job(spark, tmp_path):
    path = tmp_path / "agents.csv"
    path.write_text(AGENTS_CSV + "A3,x,y,TN,e,p,not a date,True,gold\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_csv(spark, str(path), "agents").collect()


BAD_LINES = {
    "A3": "A3,x,y,TN,e,p,not a date,True,gold",
    "A4": "A4,x,y,TN,e,p,2021-01-01,maybe,gold",
    "A5": "A5,x,y,TN,e,p,2021-01-01,yes,gold",
    "A6": "A6,x,y,TN",
    "A7": "A7,x,y,TN,e,p,2021-01-01,True,gold,more",
}


def test_csv_split_sets_bad_rows_aside(spark, tmp_path):
    path = tmp_path / "agents.csv"
    path.write_text(AGENTS_CSV + "A8,x,y,TN,e,p,,false,\n" + "\n".join(BAD_LINES.values()) + "\n")
    good, bad = read_csv_split(spark, str(path), "agents")
    assert good.schema == RAW_SCHEMAS["agents"]
    assert rows(good, "agent_id") == [("A1",), ("A2",), ("A8",)]
    assert rows(bad, "agent_id") == [(a,) for a in BAD_LINES]
    assert bad.filter("agent_id = 'A3'").collect()[0].hire_date == "not a date"
    assert bad.filter("agent_id = 'A6'").collect()[0][BAD_RECORD] == BAD_LINES["A6"]


def test_csv_and_parquet_round_trip(spark, raw, tmp_path):
    tables = raw(payments=[{}, dict(payment_id="2", paid_date=None, amount_paid=Decimal("0.00"))])
    for table in RAW_SCHEMAS:
        tables[table].write.parquet(f"{tmp_path}/{table}.parquet")
        tables[table].write.option("header", True).csv(f"{tmp_path}/{table}.csv")
    for fmt in ("parquet", "csv"):
        again = read_raw(spark, str(tmp_path), fmt)
        for table in RAW_SCHEMAS:
            assert rows(again[table]) == rows(tables[table]), (fmt, table)


def test_raw_tables_by_name(spark, raw):
    tables = raw()
    tables.register_views()
    assert spark.table("raw_members").count() == 1
    with pytest.raises(KeyError):
        tables["other"]
    with pytest.raises(ValueError):
        GivenTables(agents=tables.agents)


def test_read_raw_from_catalog(spark, raw):
    tables = raw()
    spark.sql("create database if not exists raw_zone")
    for table in RAW_SCHEMAS:
        tables[table].write.mode("overwrite").saveAsTable(f"raw_zone.{table}")
    again = read_raw(spark, "raw_zone", "table")
    for table in RAW_SCHEMAS:
        assert rows(again[table]) == rows(tables[table])


def months(store, table="paid_by_policy"):
    return rows(store.read(table), "policy_id", "due_period")


def test_store_partitions_and_replaces_single_months(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    frame = spark.createDataFrame([("1", "2024-05"), ("2", "2024-06"), ("3", None)], "policy_id string, due_period string")
    assert not store.exists("paid_by_policy") and store.periods("paid_by_policy") == set()
    store.replace("paid_by_policy", frame)
    assert store.exists("paid_by_policy") and store.periods("paid_by_policy") == {"2024-05", "2024-06", None}
    assert rows(store.read("paid_by_policy", ["2024-05", None]), "policy_id") == [("1",), ("3",)]

    update = spark.createDataFrame([("4", "2024-06")], frame.schema)
    store.replace_periods("paid_by_policy", update, ["2024-06", None])
    assert months(store) == [("1", "2024-05"), ("4", "2024-06")]
    # What any reader of the folder sees, and months without rows are gone.
    assert rows(spark.read.parquet(str(tmp_path / "paid_by_policy"))) == [("1", "2024-05"), ("4", "2024-06")]
    store.replace("paid_by_policy", frame.limit(0))
    assert months(store) == [] and store.periods("paid_by_policy") == set()


@pytest.mark.parametrize("table", ["paid_by_policy", "dim_agents"])
def test_a_write_that_dies_leaves_the_old_rows(spark, tmp_path, table):
    """The tasks of the second month fail after those of the first have written."""
    store = Store(spark, str(tmp_path))
    frame = spark.createDataFrame([("1", "2024-05"), ("2", "2024-06")], "policy_id string, due_period string")
    dies = frame.withColumn("policy_id", F.when(F.col("due_period") == "2024-06", F.raise_error(F.lit("gone"))).otherwise("9"))
    with pytest.raises(Exception, match="gone"):
        store.replace(table, dies)
    assert not store.exists(table)
    store.replace(table, frame)
    with pytest.raises(Exception, match="gone"):
        store.replace(table, dies)
    if table == "paid_by_policy":
        with pytest.raises(Exception, match="gone"):
            store.replace_periods(table, dies, ["2024-06"])
    assert rows(spark.read.parquet(store.path(table)), "policy_id") == [("1",), ("2",)]


def test_appended_rows_stay(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    frame = spark.createDataFrame([("1", "2024-05")], "policy_id string, due_period string")
    store.append("paid_by_policy", frame)
    store.append("paid_by_policy", frame)
    assert months(store) == [("1", "2024-05")] * 2


def test_reading_a_month_prunes_partitions(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    frame = spark.createDataFrame([("1", "2024-05"), ("2", "2024-06")], "policy_id string, due_period string")
    store.replace("paid_by_policy", frame)
    one_month = store.read("paid_by_policy", ["2024-05"])
    plan = one_month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "2024-05" in plan.split("PartitionFilters: ")[1]
    assert rows(one_month) == [("1", "2024-05")]


def test_rejects_of_a_dirty_file(spark, tmp_path):
    """Every row of a CSV file is either typed or set aside with its line."""
    lines = ["P1,M1,A1,VSP,Dental Basic,2024-01-01,2025-01-01,30.00,360.00,0.18,5.40,Active,12", "P2,M1,A1,VSP,Dental Basic,yesterday,2025-01-01,30.00,360.00,0.18,5.40,Active,12",
             "P3,M1,A1,VSP,Dental Basic,2024-01-01,2025-01-01,thirty,360.00,0.18,5.40,Active,12", "P4,M1"]
    (tmp_path / "policies.csv").write_text("\n".join([",".join(RAW_SCHEMAS["policies"].fieldNames()), *lines]) + "\n")
    good, bad = read_csv_split(spark, str(tmp_path / "policies.csv"), "policies")
    assert rows(good, "policy_id") == [("P1",)] and bad.count() == 3
