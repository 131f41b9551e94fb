"""Joins of spans of time that overlap.

Spans are put into bins of days whose size is a power of two above the length of the span, so that a span touches at most two bins of its
size. A row goes to the bins of its own size, and to those of each larger size that the other side has; a long span never
multiplies with its length. Two spans meet at the larger of their two sizes, in the bin in which the later one starts: each pair comes out once.
The join is one of equal keys, which adaptive execution splits where a bin is hot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_number(moment: Column) -> Column:
    return F.unix_date(F.to_date(moment)).cast("bigint")


def _spans(rows: DataFrame, keys: list[str], span: tuple[str, str], place: Callable[[Column], Column], side: str) -> DataFrame:
    """(keys, side_0, side_1, ..., side_first, side_last, side_size): usable rows, their first and last place, and the power of two of their bins."""
    start, end = (F.col(name) for name in span)
    usable = start <= end
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    placed = rows.where(usable).select(
        *keys,
        *[F.col(f"`{name}`").alias(f"{side}_{i}") for i, name in enumerate(rows.columns)],
        place(start).alias(f"{side}_first"),
        place(end).alias(f"{side}_last"),
    )
    length = F.col(f"{side}_last") - F.col(f"{side}_first")
    size = F.when(length == 0, 0).otherwise(F.length(F.bin(length)))
    return placed.withColumn(f"{side}_size", size.cast("int"))


def _row(rows: DataFrame, side: str) -> Column:
    return F.struct(*[F.col(f"{side}_{i}").alias(name) for i, name in enumerate(rows.columns)]).alias(side)


def _sizes(spans: DataFrame, side: str) -> list[int]:
    """The sizes that occur: one for each power of two, at most."""
    return sorted(row[0] for row in spans.select(f"{side}_size").distinct().collect())


def _in_bins(spans: DataFrame, side: str, others: list[int]) -> DataFrame:
    own, first, last = (F.col(f"{side}_{name}") for name in ("size", "first", "last"))
    larger = F.filter(F.array(*[F.lit(size) for size in others]).cast("array<int>"), lambda size: size > own)
    each_size = spans.withColumn("_size", F.explode(F.concat(F.array(own), larger)))
    low, high = (F.call_function("shiftright", place, F.col("_size")) for place in (first, last))
    return each_size.withColumn("_bin", F.explode(F.sequence(low, high)))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    keys: list[str] | None = None,
    place: Callable[[Column], Column] = day_number,
) -> DataFrame:
    """(left, right): the pairs of rows, as structs, with equal ``keys`` whose spans share a moment, both ends included.

    ``place`` gives the whole number (a day) of a moment, which must not fall as moments rise. A span with a null end, one that ends
    before it starts and a row with a null key match nothing; repeated rows each make their pairs.
    """
    keys = keys or []
    a = _spans(left, keys, left_span, place, "left")
    b = _spans(right, keys, right_span, place, "right")
    a_sizes, b_sizes = _sizes(a, "left"), _sizes(b, "right")
    a, b = _in_bins(a, "left", b_sizes), _in_bins(b, "right", a_sizes)
    later = F.greatest("left_first", "right_first")
    (a_start, a_end), (b_start, b_end) = (
        [F.col(f"{side}_{rows.columns.index(name)}") for name in span]
        for side, rows, span in (("left", left, left_span), ("right", right, right_span))
    )
    return (
        a.join(b, [*keys, "_size", "_bin"])
        .where(F.col("_size") == F.greatest("left_size", "right_size"))
        .where(F.col("_bin") == F.call_function("shiftright", later, F.col("_size")))
        .where((a_start <= b_end) & (b_start <= a_end))
        .select(_row(left, "left"), _row(right, "right"))
    )
