from datetime import date, datetime
from pathlib import Path

from conftest import DEFAULTS, rows

from coverloom.jobs import main
from coverloom.operators.upsert import VERSION
from coverloom.schemas import RAW_SCHEMAS
from coverloom.sources.store import Store
from coverloom.streaming.payments import FEED


def test_seed_build_check_report_load(spark, raw, tmp_path, capsys):
    clean = raw(
        agents=[dict(tier="gold")], policies=[dict(status="active")], payments=[dict(payment_id="Y0", payment_status="paid"), dict(payment_status="failed")],
        cancellations=[dict(cancellation_reason="deceased")],
    )
    for table in RAW_SCHEMAS:
        clean[table].write.option("header", True).csv(f"{tmp_path}/csv/{table}.csv")
    places = {name: str(tmp_path / name) for name in ("csv", "raw", "marts", "out", "feed", "checkpoint")}

    def run(job, *names, **extra):
        options = {**{n: places[n] for n in names}, **extra}
        return main([job, *[part for n, v in options.items() for part in (f"--{n.replace('_', '-')}", v)]], spark)

    assert run("seed", "csv", "raw") == 0
    assert main(["build", "--raw", places["raw"], "--marts", places["marts"], "--as-of", "2024-06-15", "--gated"], spark) == 0
    assert run("check", "raw", "marts") == 0
    store = Store(spark, places["marts"])
    assert rows(store.read("fct_payments"), "payment_id", "payment_status") == [("Y0", "paid"), ("Y1", "failed")]
    # Nothing is left of what the jobs wrote on the way.
    assert not [f for f in Path(spark.conf.get("spark.checkpoint.dir")).glob("*-candidate-*")]

    assert run("report", "raw", "marts", "out", as_of="2024-06-15") == 0
    revenue = spark.read.parquet(f"{places['out']}/monthly_revenue")
    assert rows(revenue, "due_period", "failed_payments") == [("2024-06", 1)]
    assert spark.read.parquet(f"{places['out']}/churn_risk").count() == 1

    # A feed with a correction and with a status that is not declared.
    odd = {**DEFAULTS["payments"], "payment_id": "Y2", "payment_status": "refunded", "due_date": date(2024, 5, 1)}
    good = {**DEFAULTS["payments"], "payment_status": "paid"}
    feed = [{**p, VERSION: datetime(2024, 6, 1)} for p in (odd, good)]
    spark.createDataFrame([tuple(p[f] for f in FEED.fieldNames()) for p in feed], FEED).write.parquet(places["feed"])
    assert run("load", "feed", "raw", "marts", "checkpoint", as_of="2024-06-15") == 0
    assert run("build", "raw", "marts", as_of="2024-06-15") == 0  # keeps what was loaded
    clean.agents.select("agent_id").write.parquet(f"{tmp_path}/changed")
    assert run("refresh", "raw", "marts", as_of="2024-06-15", agents=f"{tmp_path}/changed") == 0
    assert rows(store.read("fct_payments"), "payment_id", "payment_status") == [
        ("Y0", "paid"), ("Y1", "paid"), ("Y2", "refunded"),
    ]
    capsys.readouterr()
    # A gated build stops at the status that is not declared and leaves the marts as they are.
    assert main(["build", "--raw", places["raw"], "--marts", places["marts"], "--as-of", "2024-06-15", "--gated"], spark) == 1
    assert "accepted_values payment_status: 1" in capsys.readouterr().out
    assert store.read("fct_payments").count() == 3
    assert run("check", "raw", "marts") == 1
    shown = capsys.readouterr().out
    assert "fct_payments" in shown and "payment_status" in shown and "agents" not in shown.replace("dim_agents", "")
