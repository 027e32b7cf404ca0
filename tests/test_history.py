"""Stale spans and risk over time, against plain models."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from conftest import TESTDATA, rows

from coverloom.plans import analyst, history
from coverloom.sources.order_tables import AS_OF

LOADS = "carrier string, loaded_at timestamp"
NOW = datetime(2024, 2, 1)


def plain_spans(loads, now):
    found = []
    for carrier in {c for c, _ in loads}:
        times = sorted({t for c, t in loads if c == carrier and t is not None and t <= now}) + [now]
        found += [(carrier, a + timedelta(days=1), b, int((b - a).total_seconds()) - 86400) for a, b in zip(times, times[1:]) if b - a > timedelta(days=1)]
    return sorted(found, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_spans_equal_gaps_and_islands(spark, seed):
    pick = random.Random(seed)
    loads = [(pick.choice(["A", "B", None]), datetime(2024, 1, 1) + timedelta(seconds=pick.randrange(40 * 86400))) for _ in range(60)]
    loads += [("hot", datetime(2024, 1, 1) + timedelta(seconds=13 * k)) for k in range(20_000)] + [("C", None)]
    assert rows(history.stale_spans(spark.createDataFrame(loads, LOADS), NOW)) == plain_spans(loads, NOW)


def test_a_pause_of_exactly_a_day_is_fresh(spark):
    at = datetime(2024, 1, 30, 12)
    for pause, spans in ((timedelta(days=1), 0), (timedelta(days=1, seconds=1), 1)):
        frame = spark.createDataFrame([("A", at), ("A", at + pause)], LOADS)
        assert history.stale_spans(frame, at + pause).count() == spans
    assert history.stale_spans(spark.createDataFrame([], LOADS), NOW).count() == 0
    with pytest.raises(ValueError):
        history.stale_spans(frame, NOW, hours=3)


def test_a_hot_carrier_moves_as_days(spark):
    carrier = F.when(F.col("id") % 1000 == 0, "rare").otherwise("hot").alias("carrier")
    loads = spark.range(50_000).select(carrier, F.timestamp_seconds(1_700_000_000 + F.col("id") * 7).alias("loaded_at"))
    plan = history.stale_spans(loads, NOW)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan[plan.rindex("Exchange hashpartitioning("):]  # summed up before the first exchange


def test_sessions_on_a_stream(spark, tmp_path):
    """The same sessions from a stream: they come out once the watermark has passed their end."""
    for k, times in enumerate([[1, 5, 20], [60, 62], [300]]):
        frame = spark.createDataFrame([("A", datetime(2024, 1, 1) + timedelta(hours=h)) for h in times], LOADS)
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
        feed = spark.readStream.schema(LOADS).parquet(str(tmp_path / "feed")).withWatermark("loaded_at", "1 hour")
        query = history.load_sessions(feed).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination()
    hours = lambda t: int((t - datetime(2024, 1, 1)).total_seconds() // 3600)
    assert [(hours(r.first_load), hours(r.last_load)) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("first_load").collect()] == [(1, 20), (60, 62)]


def test_last_month_equals_the_risk_question(spark):
    s = registered._staged(spark, TESTDATA)
    for day in (date(1997, 3, 31), date(1998, 6, 30)):
        known = s.with_payments(s.payments.filter(F.col("due_date") <= F.lit(day)))
        risk = analyst.churn_risk(known.payments, known.members, known.agents, day)
        tiers = {r.churn_risk_tier: r.n for r in risk.groupBy("churn_risk_tier").agg(F.count("*").alias("n")).collect()}
        last = history.risk_history(s.payments, AS_OF).filter(F.col("month_end") == F.lit(day)).first()
        assert (last.high_risk, last.medium_risk) == (tiers.get("high_risk", 0), tiers.get("medium_risk", 0))
        assert last.high_risk + last.medium_risk > 0


def test_windows_keep_their_edges(staged):
    s = staged(payments=[
        dict(payment_id="1", due_date=date(2024, 1, 31), payment_status="failed"),
        dict(payment_id="2", due_date=date(2024, 3, 1)), dict(payment_id="3", due_date=date(2024, 3, 1), member_id=None),
    ])
    found = {r.month_end: r for r in history.risk_history(s.payments, date(2024, 5, 31)).collect()}
    # 31 January is 90 days before 30 April and 60 days before 31 March; 1 March is 91 days before 31 May.
    assert sorted(found) == [date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 31), date(2024, 4, 30)]
    assert [found[d].medium_risk for d in sorted(found)] == [1, 1, 1, 1]
    assert [found[d].members_paying for d in sorted(found)] == [0, 0, 2, 2]
