"""However a payment history arrives, the stored tables must equal a full build."""

import random
import re
import time
from datetime import date, datetime
from decimal import Decimal
from functools import reduce
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import DEFAULTS, rows

from coverloom import session
from coverloom.operators.staging import stage_payments
from coverloom.operators.upsert import VERSION, current_payments, first_rows, missing_rows, newest, upsert_payments
from coverloom.plans import marts, warehouse
from coverloom.schemas import PAYMENTS
from coverloom.sources.store import Store
from coverloom.streaming import payments
from coverloom.streaming.payments import FEED, merge_feed, payment_feed

D = Decimal


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


@pytest.fixture
def batch(spark):
    def build(version, *payments):
        filled = [{**DEFAULTS["payments"], **p} for p in payments]
        frame = spark.createDataFrame([tuple(p[f] for f in PAYMENTS.fieldNames()) for p in filled], PAYMENTS)
        return stage_payments(frame.withColumn(VERSION, F.lit(version).cast("int")), VERSION)

    return build


def stored(store):
    return rows(current_payments(store.read("payment_batches")), "payment_id", "due_period", "payment_status", VERSION)


def test_newest_version_wins_within_a_batch(batch):
    both = batch(1, dict(payment_status="failed")).unionByName(batch(2, dict(payment_status="paid")))
    assert rows(newest(both.unionByName(both)), "payment_status", VERSION) == [("paid", 2)]


def test_new_corrected_repeated_and_late_rows(store, batch):
    assert upsert_payments(store, batch(1, dict(payment_id="a"), dict(payment_id="b", payment_status="failed"))) == ["2024-06"]
    touched = upsert_payments(store, batch(
        2, dict(payment_id="b"), dict(payment_id="b"), dict(payment_id="c", due_date=date(2021, 1, 1)),
    ))
    assert touched == ["2021-01", "2024-06"]
    assert stored(store) == [("a", "2024-06", "paid", 1), ("b", "2024-06", "paid", 2), ("c", "2021-01", "paid", 2)]


def files_of(store, table, month):
    return {f for f in store.read(table).inputFiles() if f"={month}/" in f}


def test_untouched_months_keep_their_files(store, batch, staged):
    s = staged()
    upsert_payments(store, batch(1, dict(payment_id="a"), dict(payment_id="b", due_date=date(2024, 5, 1))))
    warehouse.refresh(store, s)
    before = {t: files_of(store, t, "2024-05") for t in ("payment_batches", "fct_payments", "agent_commission_summary")}
    assert upsert_payments(store, batch(2, dict(payment_id="a", payment_status="failed"))) == ["2024-06"]
    warehouse.refresh(store, s)
    assert before == {t: files_of(store, t, "2024-05") for t in before} and all(before.values())


def test_any_reader_sees_the_current_rows(spark, store, batch, staged):
    """Plain Parquet: no row of an earlier load is left in a mart's folder."""
    s = staged(payments=[dict(payment_id="a"), dict(payment_id="b", due_date=date(2024, 5, 1))])
    warehouse.start(store, s)
    upsert_payments(store, batch(2, dict(payment_id="b", due_date=date(2024, 7, 1))).withColumn(VERSION, F.lit(datetime(2024, 6, 1))))
    warehouse.refresh(store, s)
    plain = spark.read.parquet(store.path("fct_payments"))
    assert rows(plain, "payment_id", "due_period") == [("a", "2024-06"), ("b", "2024-07")]
    assert rows(spark.read.parquet(store.path("agent_commission_summary")), "period") == [("2024-06",), ("2024-07",)]


def test_moved_due_date_leaves_no_copy_behind(store, batch):
    upsert_payments(store, batch(1, dict(payment_id="a"), dict(payment_id="b", due_date=date(2024, 5, 1))))
    # "a" is alone in its month: the month has to disappear.
    assert upsert_payments(store, batch(2, dict(payment_id="a", due_date=date(2024, 7, 1)))) == ["2024-06", "2024-07"]
    assert stored(store) == [("a", "2024-07", "paid", 2), ("b", "2024-05", "paid", 1)]


def test_a_load_reads_narrow_rows_of_what_is_stored(store, batch):
    upsert_payments(store, batch(1, dict(payment_id="a")))
    plan = missing_rows(store, first_rows(batch(2, dict(payment_id="a", payment_status="failed"))))._jdf.queryExecution().executedPlan().toString()
    schemas = [x.split("ReadSchema:")[1] for x in plain_scans(plan) if "payment_batches" in x]
    assert schemas and all(set(re.findall(r"(\w+):", x)) <= {"payment_id", VERSION, "digest", "superseded"} for x in schemas)


def plain_scans(plan):
    return [x for x in plan.splitlines() if "FileScan" in x]


def test_only_what_is_missing_is_added(store, batch):
    both = batch(1, dict(payment_id="a")).unionByName(batch(2, dict(payment_id="a", due_date=date(2024, 5, 1))))
    upsert_payments(store, batch(1, dict(payment_id="a")))
    assert upsert_payments(store, both) == ["2024-05", "2024-06"]
    held = store.read("payment_batches").count()
    for again in (both, both.unionByName(both), batch(1, dict(payment_id="a"))):
        assert upsert_payments(store, again) == []
    assert store.read("payment_batches").count() == held == 3


def test_rows_that_cannot_be_merged_are_set_aside_once(store, batch):
    odd = batch(1, dict(payment_id=None), dict(payment_id=None, due_date=date(2024, 5, 1))).unionByName(batch(None, dict(payment_id="x")))
    for _ in range(3):
        upsert_payments(store, batch(1, dict(payment_id="a")).unionByName(odd).unionByName(odd))
    assert rows(current_payments(store.read("payment_batches")), "payment_id") == [("a",)]
    assert rows(store.read("payment_rejects"), "reason") == [
        ("load time is missing",), ("payment_id is missing",), ("payment_id is missing",),
    ]


def test_a_load_leaves_no_folder_behind_and_a_refresh_no_payments(store, batch, staged):
    before = session.folders_made()
    upsert_payments(store, batch(1, dict(payment_id="a")))
    upsert_payments(store, batch(2, dict(payment_id="a", payment_status="failed")))
    assert session.folders_made() == before
    warehouse.refresh(store, staged())
    assert not [f for f in session._made[before:] if "/current-" in f or "/fact-" in f]
    assert rows(store.read("fct_payments"), "payment_id", "payment_status") == [("a", "failed")]
    assert warehouse.stored_paid(store, staged()).count() == 0


def test_current_payments_of_few_columns(store, batch, staged):
    upsert_payments(store, batch(1, dict(payment_id="a"), dict(payment_id="b", member_id="M2")))
    upsert_payments(store, batch(2, dict(payment_id="a", member_id="M3")))
    few = warehouse.stored_payments(store, staged(), columns=warehouse.REACHED_BY)
    assert few.columns == ["policy_id", "member_id", "due_period"]
    assert rows(few, "member_id", "due_period") == [("M2", "2024-06"), ("M3", "2024-06")]
    scans = [x for x in plain_scans(few._jdf.queryExecution().executedPlan().toString())]
    assert scans and not [x for x in scans if "payment_method" in x.split("ReadSchema:")[1]]


def test_a_load_that_dies_leaves_the_old_rows(store, batch, staged, monkeypatch):
    s = staged()
    upsert_payments(store, batch(1, dict(payment_id="a"), dict(payment_id="b", due_date=date(2024, 5, 1))))
    warehouse.refresh(store, s)
    before = stored(store), rows(store.read("fct_payments")), rows(store.read("agent_commission_summary"))
    move = batch(2, dict(payment_id="a", due_date=date(2024, 7, 1)))
    broken = F.when(F.col("payment_id") == "a", F.raise_error(F.lit("gone"))).otherwise(F.col("payment_method"))
    with pytest.raises(Exception, match="gone"):
        upsert_payments(store, move.withColumn("payment_method", broken))
    assert (stored(store), *[rows(store.read(t)) for t in ("fct_payments", "agent_commission_summary")]) == before
    assert upsert_payments(store, move) == ["2024-06", "2024-07"]
    # The refresh dies while it writes the payment fact: its months stay as they were and stay open.
    made = marts.fct_payments
    with monkeypatch.context() as dies:
        dies.setattr(marts, "fct_payments", lambda of: made(of).withColumn("payment_method", broken))
        with pytest.raises(Exception, match="gone"):
            warehouse.refresh(store, s)
    assert rows(store.read("fct_payments")) == before[1]
    assert warehouse.pending(store) == {"2024-06", "2024-07"}
    warehouse.refresh(store, s)
    assert rows(store.read("fct_payments"), "payment_id", "due_period") == [("a", "2024-07"), ("b", "2024-05")]
    assert stored(store) == [("a", "2024-07", "paid", 2), ("b", "2024-05", "paid", 1)]


@pytest.mark.parametrize("table", ["agent_commission_summary", "fct_member_churn", "paid_by_policy"])
def test_a_refresh_that_dies_anywhere_is_finished_by_the_next(store, batch, staged, monkeypatch, table):
    first = staged(cancellations=[dict(cancellation_id="1"), dict(cancellation_id="2", cancellation_date=date(2024, 3, 1))])
    upsert_payments(store, batch(1, dict(payment_id="a")))
    warehouse.refresh(store, first)
    then = staged(cancellations=[dict(cancellation_id="1"), dict(cancellation_id="3", cancellation_date=date(2024, 1, 5))])
    upsert_payments(store, batch(2, dict(payment_id="z", paid_date=date(2024, 6, 9))))
    write = Store.replace_periods
    with monkeypatch.context() as dies:
        dies.setattr(Store, "replace_periods", lambda self, t, *rest: (_ for _ in ()).throw(OSError("gone")) if t == table else write(self, t, *rest))
        with pytest.raises(OSError):
            warehouse.refresh(store, then)
    warehouse.refresh(store, then)
    full = then.with_payments(warehouse.stored_payments(store, then))
    for name in ("fct_payments", "fct_member_churn", "agent_commission_summary", "agent_commission_summary_monthly"):
        frame = getattr(marts, name)(full)
        assert rows(store.read(name), *sorted(frame.columns)) == rows(frame, *sorted(frame.columns)), name


def test_building_again_keeps_what_was_loaded(spark, store, batch, staged):
    s = staged(payments=[dict(payment_id="y0")])
    warehouse.start(store, s)
    upsert_payments(store, stage_payments(spark.createDataFrame(
        [tuple({**DEFAULTS["payments"], "payment_id": "y9", VERSION: datetime(2024, 6, 3)}[f] for f in FEED.fieldNames())], FEED
    ), VERSION))
    warehouse.refresh(store, s)
    warehouse.start(store, s)
    assert rows(store.read("fct_payments"), "payment_id") == [("y0",), ("y9",)]
    warehouse.reset(store, s)
    assert rows(store.read("fct_payments"), "payment_id") == [("y0",)]


def test_outdated_and_repeated_batches_change_nothing(store, batch):
    upsert_payments(store, batch(2, dict(payment_id="a")))
    expected = stored(store)
    assert upsert_payments(store, batch(1, dict(payment_id="a", payment_status="failed"))) == []
    upsert_payments(store, batch(2, dict(payment_id="a")))
    assert stored(store) == expected


def test_empty_batches(store, batch, staged):
    empty = batch(1).limit(0)
    assert upsert_payments(store, empty) == [] and not store.exists("payment_batches")
    upsert_payments(store, batch(1, dict(payment_id="a")))
    assert upsert_payments(store, empty) == []
    assert stored(store) == [("a", "2024-06", "paid", 1)]


def test_build_with_empty_facts(store, staged):
    s = staged(payments=[], cancellations=[])
    warehouse.build(store, s)
    assert store.read("dim_agents").count() == 1


def test_payment_without_due_date(store, batch):
    upsert_payments(store, batch(1, dict(payment_id="a", due_date=None)))
    assert upsert_payments(store, batch(2, dict(payment_id="a"))) == ["2024-06", None]
    assert stored(store) == [("a", "2024-06", "paid", 2)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_batches_against_a_plain_model(store, batch, seed):
    """Any order of new, corrected, moved, repeated and outdated rows, against a dictionary."""
    pick = random.Random(seed)
    model = {}
    for _ in range(4):
        rows_ = {}
        for _ in range(pick.randint(1, 8)):
            key, version = pick.choice(["a", "b", "c", "d", "e", "f", None]), pick.choice([1, 2, 3, 4, 5, 6, None])
            # One version of a payment always has the same content.
            content = random.Random(f"{key}{version}")
            month = content.randint(1, 4)
            rows_[key, version] = (f"2024-0{month}", content.choice(["paid", "failed"]))
        frames = [
            batch(v, dict(payment_id=k, due_date=date(2024, int(m[-1]), 1), payment_status=status))
            for (k, v), (m, status) in rows_.items()
        ]
        upsert_payments(store, reduce(lambda a, b: a.unionByName(b), frames))
        for (k, v), (m, status) in rows_.items():
            if k is not None and v is not None and (k not in model or model[k][2] <= v):
                model[k] = (m, status, v)
    assert stored(store) == sorted((k, *content) for k, content in model.items())


def test_refresh_equals_full_build(spark, store, batch, staged, tmp_path):
    dims = staged(
        members=[dict(member_id="M1"), dict(member_id="M2", agent_id="A2")],
        agents=[dict(agent_id="A1"), dict(agent_id="A2")],
        cancellations=[
            dict(cancellation_id="1"), dict(cancellation_id="2", agent_id="A2", cancellation_date=date(2024, 4, 1)),
        ],
    )
    upsert_payments(store, batch(
        1, dict(payment_id="a"), dict(payment_id="b", payment_status="failed", amount_paid=D(0)),
        dict(payment_id="c", due_date=date(2024, 5, 1)), dict(payment_id="d", due_date=date(2024, 4, 1)),
    ))
    warehouse.refresh(store, dims)
    update = batch(
        2, dict(payment_id="b"), dict(payment_id="e", member_id="M2", due_date=date(2024, 5, 9)),
        dict(payment_id="d", due_date=date(2024, 3, 1)),
    )
    assert upsert_payments(store, update) == ["2024-03", "2024-04", "2024-05", "2024-06"]
    # The job dies here and the batch comes again: nothing is added, and the months are still open.
    assert upsert_payments(store, update) == []
    assert warehouse.pending(store) == {"2024-03", "2024-04", "2024-05", "2024-06"}
    warehouse.refresh(store, dims)
    assert warehouse.pending(store) == set()

    full = dims.with_payments(warehouse.stored_payments(store, dims))
    for table, frame in {
        "fct_payments": marts.fct_payments(full),
        "fct_member_churn": marts.fct_member_churn(full),
        "dim_agents": marts.dim_agents(full),
        "agent_commission_summary": marts.agent_commission_summary(full),
        "agent_commission_summary_monthly": marts.agent_commission_summary_monthly(full),
    }.items():
        assert rows(store.read(table), *sorted(frame.columns)) == rows(frame, *sorted(frame.columns)), table


def test_months_reached_by_changed_dimensions(staged, spark):
    s = staged(payments=[
        dict(payment_id="1"), dict(payment_id="2", member_id="M2", due_date=date(2024, 5, 1)),
        dict(payment_id="3", member_id="M2", policy_id="P2", due_date=date(2024, 4, 1)),
    ])
    members, policies = spark.createDataFrame([("M1",)], "member_id string"), spark.createDataFrame([("P2",)], "policy_id string")
    assert warehouse.touched_by_dimensions(s, members=members) == ["2024-06"]
    assert sorted(warehouse.touched_by_dimensions(s, members, policies)) == ["2024-04", "2024-06"]
    agents = spark.createDataFrame([("A1",)], "agent_id string")
    assert warehouse.touched_by_dimensions(s, agents=agents) == ["2024-06"]
    assert warehouse.touched_by_dimensions(s) == []


def test_refresh_follows_cancellations_and_agents(store, batch, staged):
    """A payment paid later, a new, a changed and a withdrawn cancellation, an agent promoted."""
    first = staged(cancellations=[
        dict(cancellation_id="1"), dict(cancellation_id="2", cancellation_date=date(2024, 3, 1)),
        dict(cancellation_id="3", cancellation_date=date(2024, 2, 1), cancellation_reason="moved_out_of_area"),
    ])
    upsert_payments(store, batch(1, dict(payment_id="a")))
    warehouse.refresh(store, first)
    then = staged(agents=[dict(tier="Platinum")], cancellations=[
        dict(cancellation_id="1"), dict(cancellation_id="3", cancellation_date=date(2024, 2, 1), cancellation_reason="deceased"),
        dict(cancellation_id="4", cancellation_date=date(2024, 1, 5)),
    ])
    upsert_payments(store, batch(2, dict(payment_id="z", paid_date=date(2024, 6, 9))))
    warehouse.refresh(store, then, warehouse.touched_by_dimensions(then.with_payments(warehouse.stored_payments(store, then)), agents=then.agents))
    full = then.with_payments(warehouse.stored_payments(store, then))
    for table in ("dim_agents", "fct_payments", "fct_member_churn", "agent_commission_summary", "agent_commission_summary_monthly"):
        frame = getattr(marts, table)(full)
        assert rows(store.read(table), *sorted(frame.columns)) == rows(frame, *sorted(frame.columns)), table
    assert [r[1] for r in rows(store.read("fct_member_churn"), "cancellation_id", "last_paid_date")] == [date(2024, 6, 9)] * 3


def test_stream_merges_files_and_refreshes_marts(spark, store, staged, tmp_path):
    dims = staged(members=[dict(member_id="M1")])

    def arrive(version, *payments):
        filled = [{**DEFAULTS["payments"], **p, VERSION: datetime(2024, 6, version)} for p in payments]
        rows_ = [tuple(p[f] for f in FEED.fieldNames()) for p in filled]
        spark.createDataFrame(rows_, FEED).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))

    def run():
        feed = payment_feed(spark, str(tmp_path / "feed"), files_per_batch=1)
        query = merge_feed(feed, store, str(tmp_path / "checkpoint"), dimensions=lambda: dims)
        query.awaitTermination()

    arrive(1, dict(payment_id="a", payment_status="Failed", amount_paid=D(0), paid_date=None), dict(payment_id="b"))
    run()  # the first batch builds the marts
    arrive(2, dict(payment_id="a"), dict(payment_id="old", due_date=date(2019, 1, 1)))
    arrive(1, dict(payment_id="a", payment_status="Failed", amount_paid=D(0), paid_date=None))  # out-of-date repeat
    run()
    assert rows(current_payments(store.read("payment_batches")), "payment_id", "payment_status") == [("a", "paid"), ("b", "paid"), ("old", "paid")]
    full = dims.with_payments(warehouse.stored_payments(store, dims))
    fact = marts.fct_payments(full)
    assert rows(store.read("fct_payments"), *fact.columns) == rows(fact)
    summary = marts.agent_commission_summary(full)
    assert rows(store.read("agent_commission_summary"), *summary.columns) == rows(summary)


def test_csv_feed(spark, store, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "1.csv").write_text(
        ",".join(FEED.fieldNames()) + "\n"
        "a,P1,M1,2024-06-01,2024-06-02,30.00,30.00,Paid,ACH,VSP,Dental Basic,2024-06-02T00:00:00\n"
        "b,P1,M1,2024-05-01,,30.00,0.00,Failed,ACH,VSP,Dental Basic,2024-06-02T00:00:00\n"
    )
    query = merge_feed(payment_feed(spark, str(tmp_path / "feed"), "csv"), store, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert rows(current_payments(store.read("payment_batches")), "payment_id", "paid_date", "is_failed", "due_period") == [
        ("a", date(2024, 6, 2), False, "2024-06"), ("b", None, True, "2024-05"),
    ]


def test_stream_needs_the_payments_the_marts_were_built_from(spark, store, staged, tmp_path):
    s = staged()
    warehouse.build(store, s)
    (tmp_path / "feed").mkdir()
    with pytest.raises(ValueError, match="stored payments"):
        merge_feed(payment_feed(spark, str(tmp_path / "feed")), store, str(tmp_path / "c"), dimensions=lambda: s)


def test_stateful_lane_and_late_lane(spark, store, staged, tmp_path, monkeypatch):
    """Repeats stop at the state store, rows later than the watermark come in by the other lane,
    and a restart goes on from both checkpoints."""
    dims, feed, merged = staged(members=[dict(member_id="M1")]), str(tmp_path / "feed"), []
    take = payments.upsert_payments

    def arrive(*given):
        filled = [{**DEFAULTS["payments"], **p} for p in given]
        spark.createDataFrame([tuple(p[f] for f in FEED.fieldNames()) for p in filled], FEED).coalesce(1).write.mode("append").parquet(feed)
        time.sleep(0.1)  # files are taken in the order of their times

    def run(start, name, **options):
        query = start(payment_feed(spark, feed, files_per_batch=1), store, str(tmp_path / name), **options)
        query.awaitTermination()
        return [int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"]]

    def counted(into, batch):
        merged.append(batch.count())
        return take(into, batch)

    monkeypatch.setattr(payments, "upsert_payments", counted)
    day = lambda d: datetime(2024, 6, d)
    arrive(dict(payment_id="a", loaded_at=day(1)), dict(payment_id="b", loaded_at=day(2)))
    arrive(dict(payment_id="a", loaded_at=day(1)), dict(payment_id="a", loaded_at=day(3), payment_status="failed"))
    run(payments.merge_feed, "fast", lateness="7 days", dimensions=lambda: dims)
    assert sum(merged) == 3
    # A restart: the repeat is known from the state, one row moves the watermark, which holds for
    # rows two batches on, and the last file has a late one.
    arrive(dict(payment_id="b", loaded_at=day(2)), dict(payment_id="c", loaded_at=day(28)), dict(payment_id=None, loaded_at=day(28)))
    arrive(dict(payment_id="c", loaded_at=day(28)))
    arrive(dict(payment_id="late", loaded_at=day(4), due_date=date(2021, 1, 1)), dict(payment_id="d", loaded_at=day(27)))
    dropped = run(payments.merge_feed, "fast", lateness="7 days", dimensions=lambda: dims)
    assert sum(merged) == 5 and sum(dropped) == 1
    assert [r[0] for r in stored(store)] == ["a", "b", "c", "d"]
    run(payments.merge_late, "late", dimensions=lambda: dims)
    assert [r[:3] for r in stored(store)] == [
        ("a", "2024-06", "failed"), ("b", "2024-06", "paid"), ("c", "2024-06", "paid"), ("d", "2024-06", "paid"), ("late", "2021-01", "paid"),
    ]
    assert store.read("payment_rejects").count() == 1
    fact = marts.fct_payments(dims.with_payments(warehouse.stored_payments(store, dims)))
    assert rows(store.read("fct_payments"), *fact.columns) == rows(fact)
    before = len(merged)
    run(payments.merge_late, "late")
    assert len(merged) == before  # nothing new, nothing read again
