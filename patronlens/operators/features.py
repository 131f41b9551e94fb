"""Per-customer features as of a date, and the churn label."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronlens import contract as C
from patronlens.functions import age_in_days, mean_money, mean_share, not_after, sum_money, uniform_draw


def transaction_features(
    transactions: DataFrame, as_of: dt.date | None = None, usual_methods: list[str] = C.PAYMENT_METHODS
) -> DataFrame:
    """One row of spend, frequency and recency aggregates per customer with transactions up to ``as_of``.

    Everything is combined inside each task before the shuffle, so a customer who holds a third of all rows
    reaches the reducer as a handful of partial rows. A distinct count alone would have every customer shuffled
    once per payment method; the usual methods (a hint of at most 62 names) are therefore counted as bits of one
    number, and only other names go through the distinct count. The result is exact for any names.
    """
    usual = list(usual_methods)
    if len(usual) > 62:
        raise ValueError("a bigint has bits for at most 62 usual payment methods")
    method = F.col("payment_method")
    bits = [F.when(method == name, F.lit(1 << i).cast("bigint")) for i, name in enumerate(usual)]
    known = transactions.where(not_after("transaction_date", as_of)).select(
        "user_id",
        "transaction_id",
        F.coalesce(*bits, F.lit(None).cast("bigint")).alias("usual_method"),
        F.when(~method.isin(usual), method).alias("other_method"),
        "total_amount",
        age_in_days("transaction_date", as_of).alias("days"),
    )
    return (
        known.groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            sum_money("total_amount").alias("total_spent"),
            mean_money("total_amount").alias("avg_transaction_amount"),
            F.max("total_amount").alias("max_transaction_amount"),
            F.min("total_amount").alias("min_transaction_amount"),
            F.count("transaction_id").alias("transaction_frequency"),
            F.min("days").alias("days_since_last_transaction"),
            F.count_if(F.col("days") <= C.RECENT_DAYS).alias("transactions_last_30_days"),
            F.avg("days").alias("avg_days_between_transactions"),
            mean_share(F.lit(1.0) / (F.col("days") + 1)).alias("recency_score"),
            F.bit_or("usual_method").alias("usual_methods"),
            F.count_distinct("other_method").alias("other_methods"),
        )
        .withColumn("payment_method_count", F.coalesce(F.bit_count("usual_methods"), F.lit(0)) + F.col("other_methods"))
        .select("user_id", *C.USER_FEATURES[3:])
    )


def user_features(
    users: DataFrame,
    transactions: DataFrame,
    as_of: dt.date | None = None,
    usual_methods: list[str] = C.PAYMENT_METHODS,
) -> DataFrame:
    """Demographics plus transaction features; customers without transactions drop out.

    The aggregate is already partitioned by customer, so only the three user columns move for the join.
    """
    profiles = users.select("user_id", "age", "customer_segment")
    return profiles.join(transaction_features(transactions, as_of, usual_methods), "user_id").select(*C.USER_FEATURES)


def with_churn_label(features: DataFrame) -> DataFrame:
    """Add ``is_churned``: three clauses, each firing with its own probability and an independent draw."""
    stale = (F.col("days_since_last_transaction") > C.STALE_AFTER_DAYS) & (
        uniform_draw("user_id", "stale") > 1 - C.STALE_PROBABILITY
    )
    segment = (F.col("customer_segment") == C.CHURNING_SEGMENT) & (
        uniform_draw("user_id", "segment") > 1 - C.SEGMENT_PROBABILITY
    )
    senior = (F.col("age") > C.SENIOR_ABOVE_AGE) & (uniform_draw("user_id", "senior") > 1 - C.SENIOR_PROBABILITY)
    return features.withColumn("is_churned", F.coalesce(stale | segment | senior, F.lit(False)))


def feature_statistics(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.count_if("is_churned").alias("churned_users"),
        mean_money("total_spent").alias("avg_spent"),
        F.avg("total_transactions").alias("avg_transactions"),
        F.avg("recency_score").alias("avg_recency_score"),
    )


def churn_distribution(features: DataFrame) -> DataFrame:
    """Customers per label."""
    return features.groupBy("is_churned").agg(F.count(F.lit(1)).alias("customers"))


def churn_value_counts(features: DataFrame) -> DataFrame:
    """Customers per label, the larger group first, with each label's share in percent."""
    three_rows = Window.partitionBy()  # one row per label value: true, false, null
    share = F.col("customers") / F.sum("customers").over(three_rows) * 100
    return churn_distribution(features).withColumn("share_pct", share).orderBy(F.desc("customers"), "is_churned")
