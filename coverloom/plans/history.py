"""Questions over time: when loads stood still, and how risk looked at every month end."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverloom.functions import choose, percent
from coverloom.operators.upsert import VERSION
from coverloom.plans.analyst import ACTIVE_DAYS, RISK_DAYS

FRESH_HOURS = 24


def load_sessions(loads: DataFrame, column: str = VERSION, hours: int = FRESH_HOURS) -> DataFrame:
    """carrier, first and last load of every run of loads with no pause longer than ``hours``.
    The same on a stream that has a watermark on ``column``: sessions come out when they end."""
    return (
        loads.groupBy("carrier", F.session_window(column, f"{hours} hours").alias("session"))
        .agg(F.min(column).alias("first_load"), F.max(column).alias("last_load"))
        .drop("session")
    )


def stale_spans(loads: DataFrame, now: datetime, column: str = VERSION, hours: int = FRESH_HOURS) -> DataFrame:
    """D13 over all time: carrier, stale_from, stale_until and stale_seconds of every span in
    which a carrier's newest load was older than ``hours``, up to ``now``; loads after ``now``
    have not happened yet, and loads without a carrier are a feed of their own.

    A pause longer than a day never lies inside one day, so each carrier's first and last load
    of a day stand for all of them: that is summed up before anything moves, and a carrier with
    a third of all loads is as many rows as it has days.
    """
    if hours < 24:
        raise ValueError("pauses shorter than a day can lie inside one")
    at = F.col(column)
    days = loads.filter(at <= F.lit(now)).groupBy("carrier", F.to_date(at).alias("day")).agg(F.min(at).alias("a"), F.max(at).alias("z"))
    points = days.select("carrier", F.explode(F.array_distinct(F.array("a", "z"))).alias(column))
    following = F.lead("first_load", 1, now).over(Window.partitionBy("carrier").orderBy("first_load"))
    spans = load_sessions(points, column, hours).select(
        "carrier", (F.col("last_load") + F.make_dt_interval(hours=F.lit(hours))).alias("stale_from"), following.alias("stale_until")
    )
    return spans.filter("stale_until > stale_from").withColumn(
        "stale_seconds", F.timestamp_diff("SECOND", F.col("stale_from"), F.col("stale_until"))
    )


def risk_history(payments: DataFrame, until: date, risk_days: int = RISK_DAYS, active_days: int = ACTIVE_DAYS) -> DataFrame:
    """Q5 and the window of Q4 as they stood at every month end up to ``until``, in one pass:
    month_end, members and plans with payments in the last ``risk_days``, how many of them were at
    risk, by tier, how many were paying (a good payment in the last ``active_days``), and the
    share of failed payments.

    Payments are summed up per member, plan and due date first. Month ends that a date can
    still be seen from are rows beside the dates, and a range frame over the days sums up what
    lies behind each: no join, and a member is as many rows as there are dates.
    """
    day = F.datediff("due_date", F.lit(date(1970, 1, 1)))
    seen_from = F.sequence(F.last_day("due_date"), F.last_day(F.date_add("due_date", max(risk_days, active_days))), F.expr("interval 1 month"))
    good = F.col("payment_status") != "failed"
    daily = payments.filter(F.col("due_date") <= F.lit(until)).groupBy("member_id", "plan_type", "due_date").agg(
        F.count("payment_id").alias("n"), F.count_if("is_failed").alias("failed"), F.count_if("is_late").alias("late"), F.count_if(good).alias("good")
    )
    marks = (
        daily.select("member_id", "plan_type", F.explode(seen_from).alias("due_date")).distinct()
        .withColumn("due_date", F.last_day("due_date")).distinct().withColumn("is_mark", F.lit(True))
    )
    rows = daily.withColumn("is_mark", F.lit(False)).unionByName(marks, allowMissingColumns=True).withColumn("day", day)
    key = Window.partitionBy("member_id", "plan_type").orderBy("day")
    behind, paying = key.rangeBetween(-risk_days, 0), key.rangeBetween(-active_days, 0)
    at_end = rows.select(
        "member_id", "plan_type", "due_date", "is_mark",
        *[F.coalesce(F.sum(c).over(behind), F.lit(0)).alias(c) for c in ("n", "failed", "late")],
        F.coalesce(F.sum("good").over(paying), F.lit(0)).alias("good"),
    ).filter(F.col("is_mark") & (F.col("due_date") <= F.lit(until)) & ((F.col("n") > 0) | (F.col("good") > 0)))
    tier = choose([(F.col("failed") >= 2, "high"), ((F.col("failed") == 1) | (F.col("late") >= 2), "medium")], "low")
    return (
        at_end.withColumn("tier", tier).groupBy(F.col("due_date").alias("month_end"))
        .agg(
            F.count_if(F.col("n") > 0).alias("members_billed"),
            F.count_if((F.col("n") > 0) & (F.col("tier") == "high")).alias("high_risk"),
            F.count_if((F.col("n") > 0) & (F.col("tier") == "medium")).alias("medium_risk"),
            F.count_if(F.col("good") > 0).alias("members_paying"),
            F.sum("failed").alias("_failed"), F.sum("n").alias("_n"),
        )
        .withColumn("failure_rate_pct", percent(F.col("_failed"), F.col("_n"), 1))
        .drop("_failed", "_n")
    )
