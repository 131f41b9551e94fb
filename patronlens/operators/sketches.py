"""Mergeable sketches as binary columns: percentiles and distinct counts that grow batch by batch, day by day.

A percentile sketch (KLL) of ``PERCENTILE_SIZE`` has a rank error of ``RANK_ERROR`` at 99 % confidence, however many sketches were merged. A
distinct sketch (HyperLogLog) of 2**``DISTINCT_SIZE`` registers has a relative standard error of 1.04 / sqrt(2**DISTINCT_SIZE). Both are
made by plain aggregates: combined inside each task, some kilobytes per task and group afterwards.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens import contract as C
from patronlens.operators.engineered import Thresholds

PERCENTILE_SIZE = 4000
RANK_ERROR = 2.446 / PERCENTILE_SIZE**0.9433  # fixed values: the published fit for one rank, 99 % confidence
DISTINCT_SIZE = 12
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_SIZE / 2)
THRESHOLD_COLUMNS = ("total_spent", "total_transactions")


def percentile_sketch(column: str) -> Column:
    """Aggregate: the sketch of the numbers of a column, nulls and NaN left out."""
    value = F.col(column).cast("double")
    return F.kll_sketch_agg_double(F.nanvl(value, F.lit(None).cast("double")), F.lit(PERCENTILE_SIZE))


def feature_sketches(features: DataFrame) -> DataFrame:
    """One row: the number of rows of a batch of features and a sketch of each column with a threshold."""
    sketches = [percentile_sketch(name).alias(name) for name in THRESHOLD_COLUMNS]
    return features.agg(F.count(F.lit(1)).alias("rows"), *sketches)


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One row as if all batches had been one."""
    merged = [F.kll_merge_agg_double(name, F.lit(PERCENTILE_SIZE)).alias(name) for name in THRESHOLD_COLUMNS]
    return sketches.where("rows > 0").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *merged)


def sketched_thresholds(sketches: DataFrame, share: float = C.HIGH_SHARE) -> Thresholds:
    """The thresholds of all that was sketched so far; infinite if that is nothing."""
    merged = merged_sketches(sketches)
    found = merged.select(
        [
            F.when(F.kll_sketch_get_n_double(name) > 0, F.kll_sketch_get_quantile_double(name, F.lit(share))).alias(name)
            for name in THRESHOLD_COLUMNS
        ]
    ).first()
    return Thresholds(*[float("inf") if value is None else value for value in found])


def distinct_sketch(column: str) -> Column:
    """Aggregate: the sketch of the different values of a column."""
    return F.hll_sketch_agg(column, F.lit(DISTINCT_SIZE))


def distinct_in_ranges(
    sketches: DataFrame, day: str, sketch: str, keys: list[str], ranges: list[tuple[dt.date, dt.date]]
) -> DataFrame:
    """(keys, range_from, range_to, distinct_estimate) for each range of days, both ends included; reads no row but the sketches."""
    if not ranges:
        raise ValueError("no ranges")
    wanted = F.array(*[F.struct(F.lit(first).alias("range_from"), F.lit(last).alias("range_to")) for first, last in ranges])
    covering = F.filter(wanted, lambda r: F.col(day).between(r["range_from"], r["range_to"]))
    inside = sketches.select(*keys, sketch, F.inline(covering))
    united = F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias("distinct_estimate")
    return inside.groupBy(*keys, "range_from", "range_to").agg(united)

