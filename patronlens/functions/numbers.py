"""Null-, NaN- and zero-safe numeric expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from patronlens.contract import SEGMENT_CODES


def zero_if_missing(column: str | Column) -> Column:
    """As a double, with null as 0. NaN stays NaN."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("double"), F.lit(0.0))


def share_parts(share: Column) -> tuple[Column, Column]:
    """The first 24 and the next 29 bits of a value from 0 to 1, as whole numbers whose sums are exact in any order."""
    front = F.floor(share * float(1 << 24))
    return front, F.floor((share * float(1 << 24) - front) * float(1 << 29))


def mean_of_shares(fronts: Column, behinds: Column, count: Column) -> Column:
    """The mean of values from the sums of their parts."""
    return (fronts / F.lit(float(1 << 24)) + behinds / F.lit(float(1 << 53))) / count


def mean_share(share: Column) -> Column:
    """Mean of values from 0 to 1, to 53 binary places and the same under any partitioning."""
    front, behind = share_parts(share)
    return mean_of_shares(F.sum(front), F.sum(behind), F.nullif(F.count(share), F.lit(0)))


def has_nan(columns: list[str]) -> Column:
    """True when any of the (double) columns is NaN."""
    return reduce(or_, [F.coalesce(F.isnan(F.col(name).cast("double")), F.lit(False)) for name in columns])


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` for a positive denominator, else 0 (null denominators included)."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def segment_code(segment: str | Column) -> Column:
    """The ordinal code of a customer segment; unknown and null segments are 0."""
    segment = F.col(segment) if isinstance(segment, str) else segment
    code = F.lit(0)
    for name, value in SEGMENT_CODES.items():
        if value:
            code = F.when(segment == name, F.lit(value)).otherwise(code)
    return code
