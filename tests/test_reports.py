import pytest
from pyspark.sql import functions as F

from patronlens import contract as C
from patronlens.operators import reports
from patronlens.operators.joins import join_dimension, measured_bytes, sum_by_attribute
from patronlens.shared import written
from patronlens.sources.star import order_lines_from
from tests import samples


@pytest.fixture(scope="module")
def products(spark):
    rows = [(1, "P1", "Books", 10.0, "B"), (2, "P2", "Home", 20.0, "B"), (3, "P3", "Books", 0.1, "B"), (4, "P4", None, 1.0, "B")]
    return spark.createDataFrame(rows, C.RAW_PRODUCTS)


@pytest.fixture(scope="module")
def sales(spark):
    """A third of the rows and more are of one product; some products are unknown."""
    rows = [(1 if i % 3 == 0 else i % 6, round(i / 7, 2)) for i in range(600)] + [(None, 5.0), (2, None)]
    return spark.createDataFrame(rows, "product_id bigint, total_amount double")


def test_revenue_is_the_same_whether_products_are_broadcast_or_shuffled(sales, products):
    small = reports.revenue_by_category(sales, products)
    large = reports.revenue_by_category(sales, products, broadcast_bytes=0)
    assert small.collect() == large.collect()
    revenue = [row["revenue"] for row in small.collect()]
    assert revenue == sorted(revenue, reverse=True) and len(revenue) == 3
    by_hand = sales.join(products, "product_id").where("category = 'Home'").agg(F.sum("total_amount")).first()[0]
    assert small.where("category = 'Home'").first()["revenue"] == pytest.approx(by_hand)


def test_hot_keys_are_combined_before_a_shuffled_join(sales, products, spark):
    amounts = sales.select("product_id", F.lit(1).cast("bigint").alias("n"))
    plan = sum_by_attribute(amounts, products, "product_id", "category", ["n"], limit=0)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join") < text.rindex("Aggregate")  # an aggregate lies below the join


def test_measured_size_and_duplicate_products(spark, sales, products):
    assert measured_bytes(products.select("product_id")) == 4 * 16
    assert measured_bytes(products.limit(0)) == 0
    twice = products.union(products)
    assert join_dimension(sales, twice.select("product_id", "category"), "product_id").count() == 2 * sales.join(
        products, "product_id"
    ).count()
    single = reports.revenue_by_category(sales, products).first()["revenue"]
    for limit in (0, 10**9):
        assert reports.revenue_by_category(sales, twice, limit).first()["revenue"] == pytest.approx(2 * single)


def test_key_metrics_are_formatted(spark):
    users = samples.users(spark, [(i, 20, "Basic") for i in range(1234)])
    transactions = samples.transactions(spark, [(i, 1, 1234567.891, 1, "PayPal") for i in range(1001)])
    features = samples.features(spark, samples.feature_rows(8, label=lambda days, rng: days > 1000))
    features = features.withColumn("is_churned", F.when(F.col("user_id") == 1, True).when(F.col("user_id") == 2, None).otherwise(False))
    row = reports.key_metrics(users, transactions, features).first()
    assert tuple(row) == ("1,234", "1,001", "$1,235,802,458.89", "12.5%")


def test_totals_of_empty_tables(spark):
    assert reports.total_customers(samples.users(spark, [])).first()[0] == 0
    nothing = samples.transactions(spark, [])
    assert reports.total_transactions(nothing).first()[0] == 0
    assert reports.total_revenue(nothing).first()[0] is None
    assert reports.churn_rate(samples.features(spark, [])).first()[0] is None
    assert reports.churn_rate_by_segment(samples.users(spark, []), samples.features(spark, [])).collect() == []


def test_churn_rate_uses_the_segment_of_the_users_table(spark):
    users = samples.users(spark, [(1, 20, "Premium"), (2, 20, "Premium"), (3, 20, "Basic"), (4, 20, "Gold")])
    rows = [(*row[:-1], row[0] == 1) for row in samples.feature_rows(3)]
    got = reports.churn_rate_by_segment(users, samples.features(spark, rows)).collect()
    assert [tuple(row) for row in got] == [("Premium", 50.0), ("Basic", 0.0)]


def test_high_risk_customers_by_spend_with_ties_by_id(spark):
    users = samples.users(spark, [(i, 20, "Basic") for i in range(1, 41)])
    predictions = spark.createDataFrame(
        [(i, float(i // 2 * 100), i % 4 != 0) for i in range(1, 41)], "user_id bigint, total_spent double, churn_prediction boolean"
    )
    top = reports.high_risk_customers(users, predictions)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    got = [row["user_id"] for row in top.collect()]
    expected = sorted((i for i in range(1, 41) if i % 4), key=lambda i: (-(i // 2), i))[:20]
    assert got == expected


def test_priced_lines(spark, products):
    lines = spark.createDataFrame([(10, 3, 3), (11, 1, 2), (12, 99, 1)], "order_id int, product_id bigint, quantity int")
    got = {row["order_id"]: (row["unit_price"], row["list_amount"]) for row in reports.priced_lines(lines, products).collect()}
    assert got == {10: (0.1, 0.3), 11: (10.0, 20.0)}
    assert reports.priced_lines(lines, products, broadcast_bytes=0).count() == 2


def test_customers_by_segment(spark):
    users = samples.users(spark, [(1, 20, "Basic"), (2, 20, "Basic"), (3, 20, None)])
    assert sorted(reports.customers_by_segment(users).collect(), key=repr) == [("Basic", 2), (None, 1)]


def test_a_hot_order_is_split_by_the_adaptive_planner(spark):
    lines = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("l_orderkey"),
        (F.col("id") % 5).cast("int").alias("l_linenumber"),
        (F.col("id") % 9).alias("l_partkey"),
        F.lit(2.0).alias("l_quantity"),
        (F.col("id") / 100).alias("l_extendedprice"),
    )
    orders = spark.range(200_000).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 77).alias("o_custkey"),
        F.lit("2001-01-01").cast("timestamp_ntz").alias("o_orderdate"),
    )
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = order_lines_from(written(lines.repartition(8), "lines"), written(orders, "orders"))
        assert len(joined.collect()) == 200_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
