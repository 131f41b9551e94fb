"""Derived model features and the thresholds they depend on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens import contract as C
from patronlens.functions import ratio_or_zero, segment_code, zero_if_missing
from patronlens.operators.percentiles import approximate_percentiles, exact_percentiles, percentiles_by_rank

METHODS = {"exact": exact_percentiles, "by_rank": percentiles_by_rank, "approximate": approximate_percentiles}


@dataclass(frozen=True)
class Thresholds:
    """80th percentiles above which a customer counts as high-value or frequent."""

    total_spent: float
    total_transactions: float


def threshold_table(features: DataFrame, method: str = "exact") -> DataFrame:
    """One row with both 80th percentiles: ``exact``, ``by_rank`` (exact too) or ``approximate``. Pass a stored table."""
    found = METHODS[method](features, ["total_spent", "total_transactions"], [C.HIGH_SHARE])
    return found.agg(
        F.max(F.when(F.col("column_name") == "total_spent", F.col("value"))).alias("total_spent_p80"),
        F.max(F.when(F.col("column_name") == "total_transactions", F.col("value"))).alias("total_transactions_p80"),
    )


def fit_thresholds(features: DataFrame, method: str = "exact") -> Thresholds:
    """Both thresholds as plain numbers: they are stored with a model and used on streams.

    On an empty table they are infinite, so nobody is flagged."""
    return thresholds_of(threshold_table(features, method))


def thresholds_of(table: DataFrame) -> Thresholds:
    """The row of ``threshold_table`` as plain numbers."""
    return Thresholds(*[float("inf") if value is None else value for value in table.first()])


def with_engineered_features(features: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Add spend per transaction, the two strictly-above-threshold flags and the segment code."""
    return features.withColumns(
        {
            "spend_per_transaction": ratio_or_zero(F.col("total_spent"), F.col("total_transactions")),
            "high_value_customer": F.when(F.col("total_spent") > thresholds.total_spent, 1).otherwise(0),
            "frequent_buyer": F.when(F.col("total_transactions") > thresholds.total_transactions, 1).otherwise(0),
            "customer_segment_encoded": segment_code("customer_segment"),
        }
    )


def model_matrix(features: DataFrame, thresholds: Thresholds) -> DataFrame:
    """``user_id``, the 12 model inputs as doubles in contract order (null and NaN as 0) and the 0/1 ``label``."""
    inputs = [F.nanvl(zero_if_missing(name), F.lit(0.0)).alias(name) for name in C.MODEL_FEATURES]
    label = F.col("is_churned").cast("int").alias("label")
    return with_engineered_features(features, thresholds).select("user_id", *inputs, label)
