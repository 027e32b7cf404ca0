"""Every registered query against its SQL statement in DuckDB: values, types, and a sane plan."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from conftest import TESTDATA
from oracle import sql

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}
# No cross join and no Python worker anywhere.
UNWANTED = ("CartesianProduct", "NestedLoop", "ArrowEvalPython", "BatchEvalPython", "InPandas")
# Checks whose whole answer is "nothing found" on this data; planted defects test them.
EMPTY = {"dq_no_negative_commission"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    return connection


def test_every_query_has_a_statement():
    own = {key for key in registered.queries() if not key.startswith(("op", "pipeline"))}
    assert own == set(sql.statements())


@pytest.mark.parametrize("key", sorted(sql.statements()))
def test_query_matches_sql(spark, duck, key):
    frame = registered.queries()[key](spark, TESTDATA)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [name for name in UNWANTED if name in plan]
    names = sorted(frame.columns)
    got = sorted((tuple(r[c] for c in names) for r in frame.collect()), key=repr)

    answer = duck.execute(registered.oracle_sql()[key])
    columns = {d[0]: str(d[1]) for d in answer.description}
    order = [list(columns).index(c) for c in names]
    expected = sorted((tuple(r[i] for i in order) for r in answer.fetchall()), key=repr)

    assert {f.name: TYPES[f.dataType.simpleString()] for f in frame.schema.fields} == columns
    assert got == expected
    assert bool(got) != (key in EMPTY)


def test_entry_imports_without_the_pipeline_package():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
        "assert set(e.queries()) == set(e.oracle_sql()) and not [k for k in e.queries() if k.startswith('op')]"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(registered.__file__).parent)


def test_entry(spark):
    frame = registered.entry(spark)
    assert frame.columns[0] == "due_period" and frame.count() == 85
