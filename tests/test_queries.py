"""Every registered query against its SQL, on the smallest tables."""

import importlib.util
import math
from pathlib import Path

import duckdb
import pytest

from cargolens import session

ROOT = Path(__file__).resolve().parents[1]
DATA = Path("/root/testdata/sf0.001")
spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

REGISTERED = entry.registry.QUERIES

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(clean(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_its_sql():
    assert set(REGISTERED) == set(entry.oracle.SQL)
    assert set(REGISTERED) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_matches_sql(spark, database, name):
    got = entry.queries()[name](spark, str(DATA))
    cursor = database.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert set(columns) == set(got.columns)
    assert canonical(got.collect(), got.columns) == canonical(cursor.fetchall(), columns)


def test_flagship(spark):
    assert entry.entry(spark).count() == 5


def test_no_python_in_any_plan(spark):
    for name in ("fact_orders", "describe_fact", "rfm_scores", "clean_orders", "key_findings"):
        plan = entry.queries()[name](spark, str(DATA))._jdf.queryExecution().executedPlan()
        text = plan.toString()
        assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text


def test_tasks_of_table_queries_read_little_whatever_the_session_says(spark):
    before = spark.conf.get(session.ADVISORY)
    try:
        for given, held in [("64MB", "16m"), ("67108864b", "16m"), ("1g", "16m"), ("8m", "8m"), ("16k", "16k")]:
            spark.conf.set(session.ADVISORY, given)
            session.tune(spark, fine=True)
            assert spark.conf.get(session.ADVISORY) == held
            session.tune(spark)
            assert spark.conf.get(session.ADVISORY) == (before if held == "16m" else held)
    finally:
        spark.conf.unset(session.ADVISORY)
