"""Bitmaps and the slicer cube: equal to the fact, and the fact is not read."""

from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from conftest import TESTDATA, rows

from coverloom.operators.enrich import with_member_context
from coverloom.operators.slicing import Slicers
from coverloom.plans import analyst, rollups


@pytest.fixture(scope="module")
def fact(spark):
    s = registered._staged(spark, TESTDATA)
    return with_member_context(s.payments, s.members, s.agents).cache()


def test_bitmaps_answer_without_the_fact(spark):
    plan = registered.queries()["active_members_rollup"](spark, TESTDATA)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "orders" not in plan and "bitmaps" in plan


def test_bitmaps_count_distinct_members_exactly(spark, tmp_path):
    members = spark.range(70_000).select(F.concat(F.lit("m"), "id").alias("member_id"), (F.col("id") % 3).cast("string").alias("agent_id"))
    rollups.member_numbers(members.unionByName(members.limit(5))).write.parquet(str(tmp_path / "n"))
    numbers = spark.read.parquet(str(tmp_path / "n"))
    assert numbers.count() == numbers.select("number").distinct().count() == 70_000
    payments = spark.range(200_000).select(
        F.concat(F.lit("m"), (F.col("id") * 7919) % 90_000).alias("member_id"), F.format_string("2024-%02d", F.col("id") % 12 + 1).alias("due_period"), F.lit("VSP").alias("carrier")
    )
    bitmaps = rollups.billed_members(payments, numbers)
    expected = payments.join(members, "member_id").groupBy("agent_id").agg(F.count_distinct("member_id").alias("n"))
    assert rows(rollups.count_members(bitmaps, "agent_id"), "agent_id", "active_members") == rows(expected)
    assert bitmaps.agg(F.max(F.length("members"))).first()[0] == 4096


def test_rows_are_as_wide_as_their_members(spark):
    """Agents of four members each beside one of 38,000: a whole bitmap for each would be 4,096 bytes."""
    agent = F.expr("if(id < 38000, 'big', concat('a', cast(id div 4 as string)))")
    numbers = spark.range(40_000).select(F.concat(F.lit("m"), "id").alias("member_id"), agent.alias("agent_id"), F.col("id").alias("number"))
    billed = numbers.filter("number % 3 < 2").select("member_id", F.lit("2024-01").alias("due_period"), F.lit("VSP").alias("carrier"))
    bitmaps = rollups.billed_members(billed.unionByName(billed), numbers).cache()
    assert bitmaps.filter("agent_id <> 'big'").agg(F.max(F.length("members"))).first()[0] <= 20
    whole = numbers.join(billed, "member_id")
    assert rows(rollups.count_members(bitmaps, "agent_id"), "agent_id", "active_members") == rows(whole.groupBy("agent_id").count())
    assert rollups.count_members(bitmaps, "carrier").first().active_members == billed.count()
    # The wide rows are what Spark's own function builds.
    spark_made = whole.filter("agent_id = 'big'").groupBy(F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("members"))
    wide = bitmaps.filter("agent_id = 'big' and length(members) = 4096")
    assert wide.count() == 2 and rows(wide, "bucket", "members") == rows(spark_made.filter("bucket > 0"), "bucket", "members")


def test_cube_reads_the_smallest_cuboid(spark, fact):
    cube = registered._cube(spark, TESTDATA)
    assert set(cube.sizes) == {rollups.cuboid_name(c) for c in rollups.LATTICE}
    routes = {name: cube.route(s) for name, s in registered.CUBE_SLICERS.items()}
    assert routes["all"] == "months" and routes["carrier"] == "carrier" and routes["plan_span"] == "plan_type"
    assert routes["tier_state"] == "agent_tier-state" and routes["everything"] == "carrier-plan_type-agent_tier-state"
    for name, slicers in registered.CUBE_SLICERS.items():
        answer = cube.monthly_revenue(slicers)
        plan = answer._jdf.queryExecution().executedPlan().toString()
        assert "lineitem" not in plan and f"cuboid#" in plan and "PartitionFilters" in plan
        assert rows(answer) == rows(analyst.monthly_revenue(slicers.cut(fact, "fct_payments"))), name


def test_every_kind_of_slicer_has_a_cuboid_and_days_need_the_fact(spark):
    cube = registered._cube(spark, TESTDATA)
    assert cube.route(Slicers(carriers=["VSP"], states=["OH"])) == "carrier-plan_type-agent_tier-state"
    for slicers in (Slicers(start=date(1997, 1, 2)), Slicers(end=date(1997, 1, 30))):
        with pytest.raises(ValueError, match="whole months"):
            cube.monthly_revenue(slicers)
    with pytest.raises(LookupError):
        rollups.CubeReader(cube.cube.filter("cuboid = 'carrier'")).route(Slicers(states=["OH"]))


def test_missing_labels_are_not_totals(staged, spark, tmp_path):
    """A null carrier is a value of the cuboid by carrier, not the row of all carriers."""
    s = staged(payments=[dict(payment_id="1", carrier=None), dict(payment_id="2"), dict(payment_id="3", member_id="none")])
    fact = with_member_context(s.payments, s.members, s.agents)
    rollups.write_cube(rollups.revenue_cube(fact), str(tmp_path / "cube"))
    cube = rollups.CubeReader(spark.read.parquet(str(tmp_path / "cube")))
    for slicers in (Slicers(), Slicers(carriers=["VSP"]), Slicers(tiers=["gold"])):
        assert rows(cube.monthly_revenue(slicers)) == rows(analyst.monthly_revenue(slicers.cut(fact, "fct_payments")))
