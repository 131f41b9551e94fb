"""How far a column has moved between two runs.

Kolmogorov-Smirnov: the greatest distance between the shares of rows at or below a value. Values are counted per slice between quantiles of a
sketch; the counts give the distance at the end of each slice and bound it inside. Only slices whose bound exceeds the best end
are looked at value by value: those with many rows are sliced again first, the rest are ordered slice by slice. The sketch decides how much
is ordered, never the result, and no column is ordered as a whole.

Population stability: the sum of (share now - share before) * ln(share now / share before) over the bins between the tenths of the baseline.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.operators.percentiles import exact_percentiles
from patronlens.shared import written

EDGES = [i / 16 for i in range(17)]
FINE = 64  # slices between two edges
AGAIN = 32  # slices of a slice with many rows
ORDERED_ROWS = 1_000_000  # a slice with more rows is sliced again
LEAST_SHARE = 1e-4  # what an empty bin counts as
TENTHS = [i / 10 for i in range(1, 10)]


@dataclass(frozen=True)
class Slice:
    """Rows before and inside a slice, of the baseline (a) and of now (b), and the least and greatest value in it."""

    number: int
    before: tuple[int, int]
    inside: tuple[int, int]
    low: float
    high: float

    def distance(self, totals: tuple[int, int]) -> int:
        """The distance at the end of the slice, times both totals: a whole number."""
        a, b = (x + y for x, y in zip(self.before, self.inside))
        return abs(a * totals[1] - b * totals[0])

    def bound(self, totals: tuple[int, int]) -> int:
        """No value inside has a greater distance, times both totals."""
        (a, b), (m, n) = self.before, self.inside
        return max((a + m) * totals[1] - b * totals[0], (b + n) * totals[0] - a * totals[1])


def _fine_slice(value: Column, edges: list[float]) -> Column:
    """A number that never falls as the value rises."""
    number = F.lit(len(edges) * FINE)
    for i in reversed(range(len(edges))):
        width = edges[i] - edges[i - 1] if i else 0.0
        inner = F.lit(0)
        if 0 < width < math.inf:
            inner = F.least(F.floor((value - edges[i - 1]) / width * FINE), F.lit(FINE - 1)).cast("int")
        number = F.when(value <= edges[i], inner + i * FINE).otherwise(number)
    return number.cast("bigint")


def _counted(values: DataFrame, before: dict[int, tuple[int, int]] | None = None) -> list[Slice]:
    """The slices in order; those that were cut out of a slice start from what was ``before`` it (by the number of that slice)."""
    counts = values.groupBy("slice").agg(
        F.count_if(~F.col("now")).alias("a"), F.count_if("now").alias("b"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    found, a, b, parent = [], 0, 0, None
    for row in sorted(counts.collect(), key=lambda row: row.slice):
        if before is not None and row.slice // AGAIN != parent:
            parent = row.slice // AGAIN
            a, b = before[parent]
        found.append(Slice(row.slice, (a, b), (row.a, row.b), row.low, row.high))
        a, b = a + row.a, b + row.b
    return found


def kolmogorov_smirnov(before: DataFrame, now: DataFrame, column: str, ordered_rows: int = ORDERED_ROWS) -> tuple[int, int, float | None]:
    """Rows of both with a value, and the exact distance; None where a side has no value. Nulls and NaN are left out. Pass stored tables."""
    value = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double")).alias("value")
    both = before.select(value, F.lit(False).alias("now")).unionAll(now.select(value, F.lit(True).alias("now")))
    both = both.where(F.col("value").isNotNull())
    # a few numbers come to the driver and go back as constants
    edges = sorted(set(both.agg(F.percentile_approx("value", EDGES, 2000)).first()[0] or []))
    values = both.withColumn("slice", _fine_slice(F.col("value"), edges))
    slices = _counted(values)
    totals = (sum(s.inside[0] for s in slices), sum(s.inside[1] for s in slices))
    if not all(totals):
        return *totals, None
    best = 0
    while True:
        best = max([best, *(s.distance(totals) for s in slices)])
        open_ = [s for s in slices if s.low < s.high and s.bound(totals) > best]
        if not any(sum(s.inside) > ordered_rows for s in open_):
            break
        values = _cut_again(_open_rows(values, open_))
        slices = _counted(values, {i: s.before for i, s in enumerate(open_)})
    if open_:
        best = max(best, _greatest_inside(_open_rows(values, open_), totals))
    return *totals, best / (totals[0] * totals[1])


def _open_rows(values: DataFrame, open_: list[Slice]) -> DataFrame:
    """The rows of some slices, with the position of the slice among them and what is before it; the slices are thousands at most."""
    rows = [(s.number, i, *s.before) for i, s in enumerate(open_)]
    few = values.sparkSession.createDataFrame(rows, "slice bigint, position bigint, a bigint, b bigint")
    return values.join(F.broadcast(few), "slice")


def _cut_again(values: DataFrame) -> DataFrame:
    """Each slice cut at its own quantiles. A value that is a quantile is a slice alone, so every cut gets somewhere."""
    inner = [i / (AGAIN // 2) for i in range(1, AGAIN // 2)]
    edges = values.groupBy("slice").agg(F.array_distinct(F.percentile_approx("value", inner, 200)).alias("edges"))
    cut = 2 * F.size(F.filter("edges", lambda edge: edge < F.col("value"))) + F.array_contains("edges", F.col("value")).cast("int")
    return values.join(F.broadcast(edges), "slice").select(
        "value", "now", (F.col("position") * AGAIN + cut).cast("bigint").alias("slice")
    )


def _greatest_inside(rows: DataFrame, totals: tuple[int, int]) -> int:
    """The greatest distance at a value of the slices, times both totals: equal values are combined, each slice is ordered alone."""
    per_value = rows.groupBy("slice", "value").agg(
        F.first("a").alias("a"), F.first("b").alias("b"), F.count_if(~F.col("now")).alias("m"), F.count_if("now").alias("n")
    )
    so_far = Window.partitionBy("slice").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    a, b = (F.col(x) + F.sum(y).over(so_far) for x, y in (("a", "m"), ("b", "n")))
    exact = "decimal(38,0)"
    apart = F.abs(a.cast("decimal(19,0)") * F.lit(totals[1]).cast("decimal(18,0)") - b.cast("decimal(19,0)") * F.lit(totals[0]).cast("decimal(18,0)"))
    return int(per_value.select(apart.cast(exact).alias("apart")).agg(F.max("apart")).first()[0])


def population_stability(before: DataFrame, now: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, stability): a bin that one side lacks counts as ``LEAST_SHARE`` of it; null where a side has no value."""
    edges: dict[str, list[float]] = {}
    for row in exact_percentiles(before, columns, TENTHS).collect():
        edges.setdefault(row.column_name, []).append(row.value)
    cells = []
    for name in columns:
        value = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
        number = F.lit(0)
        for edge in sorted(set(edges.get(name, []))):
            number = number + (value > edge).cast("int")
        cells.append(F.struct(F.lit(name).alias("column_name"), number.alias("bin")))
    binned = [
        side.select(F.inline(F.array(*cells))).where("bin IS NOT NULL").withColumn("now", F.lit(flag))
        for side, flag in ((before, False), (now, True))
    ]
    counts = binned[0].unionAll(binned[1]).groupBy("column_name", "bin").agg(
        F.count_if(~F.col("now")).alias("a"), F.count_if("now").alias("b")
    )
    whole = Window.partitionBy("column_name")  # ten rows a column
    p, q = (F.greatest(F.col(x) / F.nullif(F.sum(x).over(whole), F.lit(0)), F.lit(LEAST_SHARE)) for x in "ab")
    known = (F.sum("a").over(whole) > 0) & (F.sum("b").over(whole) > 0)
    return (
        counts.select("column_name", F.when(known, (q - p) * F.ln(q / p)).alias("part"))
        .groupBy("column_name")
        .agg(F.sum("part").alias("stability"))
    )


def drift(before: DataFrame, now: DataFrame, columns: list[str], ordered_rows: int = ORDERED_ROWS) -> DataFrame:
    """One row per column: column_name, rows_before, rows_now (with a value), ks and stability."""
    spark = before.sparkSession
    before, now = (written(side.select(*columns), "drift") for side in (before, now))
    lines = [(name, *kolmogorov_smirnov(before, now, name, ordered_rows)) for name in columns]
    distances = spark.createDataFrame(lines, "column_name string, rows_before bigint, rows_now bigint, ks double")
    return distances.join(population_stability(before, now, columns), "column_name", "left")
