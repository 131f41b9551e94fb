"""Dashboard reports. Each returns a small DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.functions import beyond_cents, cents, dollar_text, from_cents, percent_text, sum_money, whole_text
from patronlens.operators.joins import BROADCAST_BYTES, join_dimension, sum_by_attribute


def total_customers(users: DataFrame) -> DataFrame:
    return users.agg(F.count(F.lit(1)).alias("total_customers"))


def total_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.agg(F.count(F.lit(1)).alias("total_transactions"))


def total_revenue(transactions: DataFrame) -> DataFrame:
    return transactions.agg(sum_money("total_amount").alias("total_revenue"))


def churned_percent() -> Column:
    """Share of churned rows in percent; a null label counts as not churned, an empty group gives null."""
    return F.count_if("is_churned") / F.nullif(F.count(F.lit(1)), F.lit(0)) * 100


def churn_rate(features: DataFrame) -> DataFrame:
    return features.agg(churned_percent().alias("churn_rate"))


def key_metrics(users: DataFrame, transactions: DataFrame, features: DataFrame) -> DataFrame:
    """One row with the four headline figures formatted for display."""
    sales = transactions.agg(
        F.count(F.lit(1)).alias("total_transactions"), sum_money("total_amount").alias("total_revenue")
    )
    return sales.select(
        whole_text(total_customers(users).scalar()).alias("total_customers"),
        whole_text(F.col("total_transactions")).alias("total_transactions"),
        dollar_text(F.col("total_revenue")).alias("total_revenue"),
        percent_text(churn_rate(features).scalar()).alias("churn_rate"),
    )


def revenue_by_category(sales: DataFrame, products: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Revenue per product category, highest first."""
    amounts = sales.select("product_id", cents("total_amount").alias("whole"), beyond_cents("total_amount").alias("beyond"))
    by_category = sum_by_attribute(amounts, products, "product_id", "category", ["whole", "beyond"], broadcast_bytes)
    return by_category.select("category", (from_cents(F.col("whole")) + F.col("beyond")).alias("revenue")).orderBy(
        F.desc("revenue"), "category"
    )


def customers_by_segment(users: DataFrame) -> DataFrame:
    return users.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customers"))


def churn_rate_by_segment(users: DataFrame, features: DataFrame) -> DataFrame:
    """Churn rate per segment as the users table has it now, highest first."""
    return (
        users.select("user_id", "customer_segment")
        .join(features.select("user_id", "is_churned"), "user_id")
        .groupBy("customer_segment")
        .agg(churned_percent().alias("churn_rate"))
        .orderBy(F.desc("churn_rate"), "customer_segment")
    )


def high_risk_customers(users: DataFrame, predictions: DataFrame, rows: int = 20) -> DataFrame:
    """The customers predicted to churn who spent most. On a stored prediction table the filter reaches the scan.

    Only ids and spend are joined and ordered; the columns of the few found are fetched afterwards.
    """
    at_risk = predictions.where("churn_prediction").select("user_id", "total_spent")
    order = [F.desc("total_spent"), "user_id"]
    top = at_risk.join(users.select("user_id"), "user_id", "left_semi").orderBy(*order).limit(rows)
    found = users.select("user_id", "email", "customer_segment").join(F.broadcast(top), "user_id")
    return found.orderBy(*order).limit(rows)


def priced_lines(lines: DataFrame, products: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add the product's ``unit_price`` and the list amount (unit price by quantity, to 2 decimals)."""
    prices = products.select("product_id", F.col("price").alias("unit_price"))
    priced = join_dimension(lines, prices, "product_id", broadcast_bytes)
    return priced.withColumn("list_amount", from_cents(cents("unit_price") * F.col("quantity")))
