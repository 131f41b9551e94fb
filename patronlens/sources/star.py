"""The canonical users, products and transactions seen through an order-management star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.operators.joins import join_dimension

# The names that stand for payment methods here.
ORDER_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def star_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def users_from(customer: DataFrame, nation: DataFrame) -> DataFrame:
    customers = customer.select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.invalid")).alias("email"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.lit(None).cast("date").alias("signup_date"),
        F.col("c_nationkey").alias("n_nationkey"),
        (F.col("c_custkey") % 53 + 18).cast("int").alias("age"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Basic")
        .when(F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"), "Premium")
        .otherwise("Standard")
        .alias("customer_segment"),
    )
    countries = nation.select("n_nationkey", F.col("n_name").alias("country"))
    return join_dimension(customers, countries, "n_nationkey").select(
        "user_id", "email", "first_name", "last_name", "signup_date", "country", "age", "customer_segment"
    )


def user_profiles_from(customer: DataFrame) -> DataFrame:
    """Users without the country lookup, for jobs that never read it."""
    return customer.select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.invalid")).alias("email"),
        (F.col("c_custkey") % 53 + 18).cast("int").alias("age"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Basic")
        .when(F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"), "Premium")
        .otherwise("Standard")
        .alias("customer_segment"),
    )


def products_from(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_brand").alias("brand"),
    )


def transactions_from(orders: DataFrame) -> DataFrame:
    """One transaction per order."""
    return orders.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").alias("transaction_date"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def sales_from(lineitem: DataFrame) -> DataFrame:
    """Amount sold per order line; enough for product reports, which need no order attribute."""
    return lineitem.select(F.col("l_partkey").alias("product_id"), F.col("l_extendedprice").alias("total_amount"))


def order_lines_from(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order line with its buyer and date.

    Both sides grow with the data, so this is a shuffled join on the order key; the adaptive planner splits
    a partition that one hot order fills.
    """
    buyers = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("transaction_date"),
    )
    lines = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
    )
    return lines.join(buyers, "order_id")
