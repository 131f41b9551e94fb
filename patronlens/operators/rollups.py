"""All totals of a dashboard from one pass over the lines.

Lines are combined once, inside each task and then per finest group (say segment, category and month). Every coarser total is merged from
those groups, so the rows that are multiplied for the grouping sets are groups, not lines. Sums are of whole cents and merge exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.functions import beyond_cents, cents, from_cents


def finest_totals(lines: DataFrame, by: list[str], amount: str) -> DataFrame:
    """(by, rows, whole, beyond, largest): what merges upwards, per finest group."""
    return lines.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(cents(amount)).alias("whole"),
        F.sum(beyond_cents(amount)).alias("beyond"),
        F.max(amount).alias("largest"),
    )


def _merged() -> list:
    total = from_cents(F.sum("whole")) + F.sum("beyond")
    return [F.sum("rows").alias("rows"), total.alias("amount"), F.max("largest").alias("largest")]


def cube_totals(finest: DataFrame, by: list[str]) -> DataFrame:
    """(by, grouping_id, rows, amount, largest) of every combination of the columns ``by``.

    ``grouping_id`` has a bit for each column, the first the highest: 1 where the row is a total over that column. That tells a
    total (null, bit 1) from the group of rows without a value (null, bit 0). No lines give the grand total alone: 0 rows, null amounts.
    """
    found = finest.cube(*by).agg(F.grouping_id().cast("bigint").alias("grouping_id"), *_merged())
    if finest.isEmpty():
        blank = [F.lit(None).cast(finest.schema[name].dataType).alias(name) for name in by]
        grand = finest.agg(*_merged()).select(*blank, F.lit(2 ** len(by) - 1).cast("bigint").alias("grouping_id"), "*")
        return grand.withColumn("rows", F.coalesce("rows", F.lit(0)))
    return found


def pivoted_amounts(finest: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """One row per value of ``row`` with the amount of each of the named ``values`` of ``column`` (null: none) and of all of them."""
    total = (from_cents(F.sum("whole")) + F.sum("beyond")).alias("all_amounts")
    each = []
    for value in values:
        whole, beyond = (F.sum(F.when(F.col(column) == value, F.col(part))) for part in ("whole", "beyond"))
        each.append((from_cents(whole) + beyond).alias(value))
    return finest.groupBy(row).agg(*each, total)
