"""Scans in the order of time per customer, in chunks of time.

A window over a whole customer would put one who holds a third of all rows into one task. Rows are therefore ordered within (customer,
chunk of days) only. What a chunk needs of the chunks before is one carried row, taken from an aggregate per (customer, chunk) that is combined
inside each task; the chunks of a customer are few (the time range over ``chunk_days``), so that carry is passed on by a small window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_DAYS = 90


def chunk_of(moment: str, chunk_days: int = CHUNK_DAYS) -> Column:
    return F.floor(F.unix_date(F.to_date(moment)) / F.lit(chunk_days))


def _carried(newest: DataFrame, key: str, value: str) -> DataFrame:
    """(key, chunk, carried): the last ``value`` of the chunks before each chunk."""
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return newest.select(key, "_chunk", F.last(value, ignorenulls=True).over(before).alias("_carried"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    values: dict[str, str],
    order: list[str],
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Every row of ``left`` with ``values`` (column of ``right``: new name) of the latest row of ``right`` with its key at or before its time.

    Of rows of one time the greatest by ``order`` counts. A left row without such a row, or of no key or time, gets nulls; right rows
    of no key or time match nothing. Left rows come out once each.
    """
    rank = [F.col(name).alias(f"_by{i}") for i, name in enumerate(order)]
    match = F.struct(*rank, *[F.col(old).alias(new) for old, new in values.items()])
    usable = left[key].isNotNull() & left[left_time].isNotNull()
    events = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull())
    events = events.select(key, F.col(right_time).alias("_time"), match.alias("_match"))
    events = events.groupBy(key, "_time").agg(F.max("_match").alias("_match"))
    asked = left.where(usable).select(key, F.col(left_time).alias("_time"), F.struct("*").alias("_left"))
    kind = left.select(F.struct("*").alias("_left")).schema["_left"].dataType
    both = asked.withColumn("_match", F.lit(None).cast(events.schema["_match"].dataType)).unionByName(
        events.withColumn("_left", F.lit(None).cast(kind))
    )
    both = both.withColumn("_chunk", chunk_of("_time", chunk_days))
    newest = both.groupBy(key, "_chunk").agg(F.max(F.when(F.col("_left").isNull(), F.struct("_time", "_match"))).alias("_newest"))
    carried = _carried(newest, key, "_newest").select(key, "_chunk", F.col("_carried._match").alias("_carried"))
    # at one time the events come first
    so_far = Window.partitionBy(key, "_chunk").orderBy("_time", F.col("_left").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_here", F.last("_match", ignorenulls=True).over(so_far)).where(F.col("_left").isNotNull())
    found = F.coalesce("_here", "_carried")
    joined = seen.join(carried, [key, "_chunk"], "left").select(
        "_left.*", *[found.getField(new).alias(new) for new in values.values()]
    )
    nothing = {new: F.lit(None).cast(right.schema[old].dataType) for old, new in values.items()}
    return joined.unionByName(left.where(~usable).withColumns(nothing))


def with_days_since_previous(rows: DataFrame, key: str, moment: str, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """``rows`` of a key and a time with ``days_since_previous``: calendar days since the row before; null for the first of a key."""
    dated = rows.where(F.col(key).isNotNull() & F.col(moment).isNotNull()).withColumn("_chunk", chunk_of(moment, chunk_days))
    newest = dated.groupBy(key, "_chunk").agg(F.max(moment).alias("_newest"))
    carried = _carried(newest, key, "_newest")
    in_chunk = Window.partitionBy(key, "_chunk").orderBy(moment)
    before = dated.withColumn("_before", F.lag(moment).over(in_chunk)).join(carried, [key, "_chunk"], "left")
    gap = F.datediff(F.to_date(moment), F.to_date(F.coalesce("_before", "_carried")))
    return before.withColumn("days_since_previous", gap).drop("_chunk", "_before", "_carried")


def gap_statistics(rows: DataFrame, key: str, moment: str, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Per key: rows, gaps, and their mean, median and longest in days (null for a single row).

    The median is exact: an aggregate counts the different gaps, of which a customer has no more than days.
    """
    gap = F.col("days_since_previous")
    return with_days_since_previous(rows.select(key, moment), key, moment, chunk_days).groupBy(key).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count(gap).alias("gaps"),
        F.avg(gap).alias("mean_gap"),
        F.percentile(gap, F.lit(0.5)).alias("median_gap"),
        F.max(gap).alias("longest_gap"),
    )
