"""Every query with an SQL counterpart, on the smallest tables, next to that SQL."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from patronlens.operators.reports import high_risk_customers
from patronlens.plans.oracle import ORACLE
from patronlens.plans.queries import QUERIES
from patronlens.shared import application_dir, written
from tools.check_queries import rows_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = [pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables"), pytest.mark.usefixtures("adaptive")]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, database, name):
    df = queries()[name](spark, FOLDER)
    cursor = database.execute(oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_quality_checks_read_their_own_table_only(spark, adaptive):
    for name in ("duplicate_rows", "duplicate_summary", "duplicate_keys"):
        plan = plan_of(QUERIES[name](spark, FOLDER))
        assert plan.count("FileScan") == 1 and "lineitem.parquet" in plan
    for name, tables in (("domain_violations", 2), ("range_violations", 3), ("segment_domain_violations", 2)):
        plan = plan_of(QUERIES[name](spark, FOLDER))
        assert plan.count("FileScan") == tables and "o_custkey" not in plan
    assert "Join" not in plan_of(QUERIES["range_violations"](spark, FOLDER))


def folders(spark):
    root = Path(application_dir(spark).removeprefix("file:"))
    return {p.name for p in root.iterdir()} if root.exists() else set()


@pytest.mark.parametrize(
    "name", ["csv_gzip_roundtrip", "stream_scoring", "p80_thresholds_by_rank", "standardized_features", "churn_predictions", "sql_function_view_scores"]
)
def test_a_query_leaves_only_its_result(spark, name):
    before = folders(spark)
    schemas = {d.name for d in spark.catalog.listDatabases()}
    rows = QUERIES[name](spark, FOLDER).count()
    left = folders(spark) - before
    assert rows and len(left) == 1 and left.pop().startswith(f"result-{name}-")
    assert {d.name for d in spark.catalog.listDatabases()} == schemas


def test_at_risk_customers_are_filtered_in_the_scan(spark):
    users = spark.createDataFrame([(1, "e", "s")], "user_id long, email string, customer_segment string")
    stored = spark.createDataFrame([(1, 5.0, True)], "user_id long, total_spent double, churn_prediction boolean")
    df = high_risk_customers(users, written(stored, "predictions"))
    assert "PushedFilters: [IsNotNull(churn_prediction), EqualTo(churn_prediction,true)" in plan_of(df)


def test_flagship(spark):
    assert entry(spark).count() == 3
