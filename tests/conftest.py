from __future__ import annotations

import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from coverloom.operators.staging import Staged  # noqa: E402
from coverloom.schemas import RAW_SCHEMAS  # noqa: E402
from coverloom.session import open_session  # noqa: E402
from coverloom.sources import GivenTables  # noqa: E402

AS_OF = date(2024, 6, 15)
TESTDATA = "/root/testdata/sf0.001"

DEFAULTS = {
    "agents": dict(
        agent_id="A1", agent_name="Ann Agent", agency_name="Agency", state="in", email="Ann@Example.com",
        phone=None, hire_date=date(2020, 1, 31), is_active=True, tier="Gold",
    ),
    "members": dict(
        member_id="M1", first_name="Mia", last_name="Member", email="Mia@Example.com", phone=None,
        dob=date(1990, 1, 1), state="oh", zip_code="00501", enrollment_date=date(2023, 1, 15), agent_id="A1",
        carrier="VSP", plan_type="Dental Basic",
    ),
    "policies": dict(
        policy_id="P1", member_id="M1", agent_id="A1", carrier="VSP", plan_type="Dental Basic",
        effective_date=date(2023, 2, 1), expiry_date=date(2024, 2, 1), monthly_premium=Decimal("30.00"),
        annual_premium=Decimal("360.00"), commission_rate=Decimal("0.1800"), monthly_commission=Decimal("5.40"),
        status="Active", term_months=12,
    ),
    "payments": dict(
        payment_id="Y1", policy_id="P1", member_id="M1", due_date=date(2024, 6, 1), paid_date=date(2024, 6, 2),
        amount_due=Decimal("30.00"), amount_paid=Decimal("30.00"), payment_status="Paid", payment_method="ACH",
        carrier="VSP", plan_type="Dental Basic",
    ),
    "cancellations": dict(
        cancellation_id="C1", policy_id="P1", member_id="M1", agent_id="A1", cancellation_date=date(2024, 6, 10),
        cancellation_reason="NON_PAYMENT", months_active=5, lifetime_value=Decimal("150.00"), carrier="VSP",
        plan_type="Dental Basic", was_payment_failure=True,
    ),
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = open_session(
        "tests", "local[4]",
        settings={
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.maxMetadataStringLength": "1000",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    """raw(members=[{...}, ...]) -> raw tables; columns not named take the defaults, tables
    not named get one default row."""

    def build(**tables):
        frames = {}
        for table, schema in RAW_SCHEMAS.items():
            rows = [{**DEFAULTS[table], **row} for row in tables.get(table, [{}])]
            frames[table] = spark.createDataFrame([tuple(r[f] for f in schema.fieldNames()) for r in rows], schema)
        return GivenTables(**frames)

    return build


@pytest.fixture(scope="session")
def staged(raw):
    return lambda as_of=AS_OF, **tables: Staged(raw(**tables), as_of)


def rows(frame, *columns):
    """Rows as tuples of the named columns, sorted."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def one(frame):
    (row,) = frame.collect()
    return row
