"""Fact-to-dimension joins that broadcast only what was measured to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
COMPRESSED = 20  # files may be that much smaller than what they hold
FIXED_WIDTH = 16  # bytes counted per value besides the characters of a string


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` in memory, from one aggregate over it."""
    rows = F.count(F.lit(1)) * F.lit(FIXED_WIDTH * len(df.columns))
    text = [
        F.coalesce(F.sum(F.octet_length(field.name)), F.lit(0))
        for field in df.schema.fields
        if isinstance(field.dataType, T.StringType)
    ]
    return df.agg(sum(text, rows).alias("size")).first()["size"]


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """The planner's size, from files or catalog, decides where it leaves no doubt; otherwise the rows are measured."""
    planned = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(planned)) * COMPRESSED <= limit or measured_bytes(df) <= limit


def join_dimension(fact: DataFrame, dimension: DataFrame, key: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Inner join of a fact table with a lookup table.

    A dimension measured below ``limit`` is broadcast and the fact table is not shuffled at all. A larger one
    is joined by shuffle, where the adaptive planner splits partitions that a hot key fills.
    """
    if is_small(dimension, limit):
        return fact.join(F.broadcast(dimension), key)
    return fact.join(dimension, key)


def sum_by_attribute(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    attribute: str,
    measures: list[str],
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The sums of ``measures`` of the fact rows per ``attribute`` of their dimension row.

    Small dimension: broadcast, and only per-task totals by attribute are shuffled. Large dimension: totals by
    key come first, combined before the shuffle, so that a key with a third of all rows joins as one row.
    """
    dimension = dimension.select(key, attribute)
    sums = [F.sum(measure).alias(measure) for measure in measures]
    if is_small(dimension, limit):
        joined = fact.select(key, *measures).join(F.broadcast(dimension), key)
    else:
        joined = fact.groupBy(key).agg(*sums).join(dimension, key)
    return joined.groupBy(attribute).agg(*sums)
