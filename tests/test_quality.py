"""Each check must fire on its planted defect and on nothing else."""

from datetime import date
from decimal import Decimal

import pytest

from conftest import rows

from coverloom.operators import quality
from coverloom.plans import marts
from coverloom.schemas import RAW_SCHEMAS

CLEAN = {
    "agents": [dict(agent_id="A1", tier="gold")],
    "members": [dict()],
    "policies": [dict(status="active")],
    "payments": [dict(payment_status="paid")],
    "cancellations": [dict(cancellation_reason="non_payment")],
}


@pytest.fixture
def tables(staged):
    def build(**planted):
        rows_ = {t: [*CLEAN[t], *planted.get(t, [])] for t in CLEAN}
        s = staged(**rows_)
        return {
            **{t: (lambda t=t: s.raw[t]) for t in RAW_SCHEMAS},
            "dim_agents": lambda: marts.dim_agents(s),
            "fct_payments": lambda: marts.fct_payments(s),
            "fct_member_churn": lambda: marts.fct_member_churn(s),
            "agent_commission_summary": lambda: marts.agent_commission_summary(s),
        }

    return build


def failures(report):
    return {
        (r.test, r.table_name, r.column_name): r.failures for r in report.filter("not passed").collect()
    }


def test_number_of_checks():
    kinds = [c.kind for c in quality.CHECKS]
    assert {k: kinds.count(k) for k in kinds} == {
        "unique": 8, "not_null": 14, "accepted_values": 9, "relationships": 4, "accepted_range": 5,
        "no_negative_commission": 1,
    }


def test_clean_tables_pass(tables):
    clean = tables()
    report = quality.report(clean)
    assert report.count() == 41 and failures(report) == {}
    assert {r.rows_checked for r in report.collect()} == {1}
    assert quality.failing_values(clean).count() == 0


def test_unique_counts_repeated_values_not_null(tables):
    planted = tables(members=[
        *[dict(member_id="M2")] * 3, *[dict(member_id="M3")] * 2, dict(member_id=None), dict(member_id=None),
    ])
    assert failures(quality.report(planted, ["unique"])) == {("unique", "members", "member_id"): 2}
    assert rows(quality.failing_values(planted, ["unique"]), "value", "n_records") == [("M2", 3), ("M3", 2)]


def test_repeated_dimension_key_shows_up_in_the_facts_too(tables):
    planted = tables(members=[dict()])
    assert failures(quality.report(planted, ["unique"])) == {
        ("unique", "members", "member_id"): 1,
        ("unique", "fct_payments", "payment_id"): 1,
        ("unique", "fct_member_churn", "cancellation_id"): 1,
    }


def test_not_null(tables):
    planted = tables(policies=[dict(policy_id="P2", member_id=None, monthly_premium=None, status="active")])
    assert failures(quality.report(planted, ["not_null"])) == {
        ("not_null", "policies", "member_id"): 1, ("not_null", "policies", "monthly_premium"): 1,
    }
    assert rows(quality.failing_values(planted, ["not_null"]), "column_name", "value", "n_records") == [
        ("member_id", None, 1), ("monthly_premium", None, 1),
    ]


def test_accepted_values_on_raw_labels(tables):
    planted = tables(
        payments=[
            dict(payment_id="2", payment_status="Paid"), dict(payment_id="3", payment_status="Paid"),
            dict(payment_id="4", payment_status=None), dict(payment_id="5", payment_status="refunded"),
        ],
    )
    # "Paid" fails on the raw table only; staging lowers it.
    assert failures(quality.report(planted, ["accepted_values"])) == {
        ("accepted_values", "payments", "payment_status"): 3,
        ("accepted_values", "fct_payments", "payment_status"): 1,
    }
    assert rows(quality.failing_values(planted, ["accepted_values"]), "table_name", "value", "n_records") == [
        ("fct_payments", "refunded", 1), ("payments", "Paid", 2), ("payments", "refunded", 1),
    ]


def test_relationships(tables):
    planted = tables(
        payments=[dict(payment_id=str(i), policy_id="gone", payment_status="paid") for i in range(3)]
        + [dict(payment_id="n", policy_id=None, payment_status="paid")],
    )
    report = quality.report(planted, ["relationships"])
    assert failures(report) == {("relationships", "payments", "policy_id"): 3}
    assert report.filter("table_name = 'payments'").collect()[0].rows_checked == 5
    assert rows(quality.failing_values(planted, ["relationships"]), "value", "n_records") == [("gone", 3)]


def test_accepted_range_and_negative_commission(tables):
    planted = tables(
        payments=[dict(payment_id="2", amount_paid=Decimal("-30.00"), payment_status="paid", due_date=date(2024, 5, 1))],
        cancellations=[dict(cancellation_id="2", months_active=-1, cancellation_reason="deceased")],
    )
    assert failures(quality.report(planted, ["accepted_range", "no_negative_commission"])) == {
        ("accepted_range", "fct_payments", "commission_earned"): 1,
        ("accepted_range", "fct_member_churn", "months_active"): 1,
        ("accepted_range", "agent_commission_summary", "collection_rate_pct"): 1,
        ("no_negative_commission", "fct_payments", "commission_earned"): 1,
    }
    bad = rows(quality.negative_commissions(planted["fct_payments"]()))
    assert bad == [("2", Decimal("-30.00"), Decimal("-5.40"))]


def test_null_passes_range(tables):
    planted = tables(payments=[dict(payment_id="2", policy_id="gone", payment_status="paid")])
    assert failures(quality.report(planted, ["accepted_range"])) == {}


def test_empty_tables_pass(spark, staged):
    s = staged(agents=[], members=[], policies=[], payments=[], cancellations=[])
    found = quality.report({
        **{t: (lambda t=t: s.raw[t]) for t in RAW_SCHEMAS},
        "dim_agents": lambda: marts.dim_agents(s),
        "fct_payments": lambda: marts.fct_payments(s),
        "fct_member_churn": lambda: marts.fct_member_churn(s),
        "agent_commission_summary": lambda: marts.agent_commission_summary(s),
    })
    assert found.count() == 41 and failures(found) == {}


def test_passes_kept_apart_find_the_same(tables):
    planted = tables(
        members=[dict(member_id="M2", agent_id="gone"), dict(member_id="M2", agent_id=None)],
        payments=[dict(payment_id="2", policy_id="gone", payment_status="odd"), dict(payment_id="2"), dict(payment_id=None)],
    )
    counted, found = quality.report(planted, apart=True), quality.failing_values(planted, apart=True)
    assert rows(counted) == rows(quality.report(planted)) and counted.count() == 41
    assert rows(found) == rows(quality.failing_values(planted)) and found.count() > 5
    for frame in (counted, found):  # each pass has ended: nothing is left to shuffle
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_keys_of_several_columns(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1), ("b", 1), (None, 1), (None, 1)], "k string, n int")
    assert quality.unique_together(frame, "t", "k", "n").first().asDict() == {
        "test": "unique", "table_name": "t", "column_name": "k, n", "rows_checked": 7, "failures": 1, "passed": False,
    }
    assert quality.unique_together(frame.limit(0), "t", "k", "n").first().rows_checked == 0
