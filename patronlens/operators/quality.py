"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.operators.percentiles import exact_percentiles

QUARTILES = [0.25, 0.5, 0.75]


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole rows that occur more than once."""
    return duplicate_keys(df, df.columns)


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: all rows, distinct keys, keys that repeat, and rows beyond the first of their key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """``(column_name, null_count, null_rate)`` from one pass; the rate of an empty table is null."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot("_rows", df.columns, "column_name", "null_count").select(
        "column_name", "null_count", (F.col("null_count") / F.nullif("_rows", F.lit(0))).alias("null_rate")
    )


def range_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, minimum, maximum, mean and exact quartiles per numeric column. Pass a stored table."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    columns = columns or numeric
    plain = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns]
    totals = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(value).alias("value_count"),
                F.min(value).alias("min_value"),
                F.max(value).alias("max_value"),
                F.avg(value).alias("mean_value"),
            ).alias(c)
            for c, value in zip(columns, plain, strict=True)
        ]
    ).select(F.inline(F.array(*columns)))
    quartiles = (
        exact_percentiles(df, columns, QUARTILES)
        .groupBy("column_name")
        .agg(*[F.max(F.when(F.col("probability") == p, F.col("value"))).alias(f"p{int(p * 100)}") for p in QUARTILES])
    )
    return totals.join(quartiles, "column_name", "left")  # a column without values has no quartiles


def range_violations(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """``(column_name, low, high, violations)``: values outside the inclusive bounds; null is no violation."""
    counts = df.agg(
        *[F.count_if(~F.col(c).between(low, high)).alias(c) for c, (low, high) in bounds.items()]
    )
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(float(low)).alias("low"),
            F.lit(float(high)).alias("high"),
            F.col(c).alias("violations"),
        )
        for c, (low, high) in bounds.items()
    ]
    return counts.select(F.inline(F.array(*lines)))


def domain_violations(df: DataFrame, domains: dict[str, list[str]], counted: str | None = None) -> DataFrame:
    """``(column_name, value, rows)``: values outside each column's allowed list; null is no violation.

    ``counted`` names a column with the number of rows that each row stands for.
    """
    rows = F.lit(1) if counted is None else F.col(counted)
    checked = df.select(
        rows.cast("long").alias("_rows"),
        *[F.when(~F.col(c).isin(allowed), F.col(c).cast("string")).alias(c) for c, allowed in domains.items()],
    )
    return (
        checked.unpivot("_rows", list(domains), "column_name", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.sum("_rows").alias("rows"))
    )


def prediction_alignment(predictions: DataFrame) -> DataFrame:
    """One row: how far predictions and labels agree, and whether every prediction follows its probability."""
    agrees = F.col("churn_prediction") == F.coalesce("is_churned", F.lit(False))
    return predictions.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(agrees).alias("agreeing_rows"),
        (F.count_if(agrees) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("agreement_rate"),
        F.count_if(F.col("churn_prediction") != (F.col("churn_probability") > 0.5)).alias("inconsistent_rows"),
    )
