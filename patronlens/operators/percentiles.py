"""Exact interpolated percentiles of whole columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.operators.ranking import rows_at_ranks

ROWS_IN_ONE_TASK = 1_000_000
SKETCH_ACCURACY = 2000
SLICES = 256


def exact_percentiles(
    df: DataFrame, columns: list[str], probabilities: list[float], in_one_task: int = ROWS_IN_ONE_TASK
) -> DataFrame:
    """``(column_name, probability, value)``, interpolating linearly between the two nearest values.

    The built-in ``percentile`` keeps every distinct value of a column in one task, so it serves tables counted
    at no more than ``in_one_task`` rows; larger ones go by rank. Nulls and NaN are left out. Pass a stored table.
    """
    if df.count() <= in_one_task:
        return _in_rows(df, columns, probabilities, lambda value: F.percentile(value, probabilities))
    return percentiles_by_rank(df, columns, probabilities)


def approximate_percentiles(
    df: DataFrame, columns: list[str], probabilities: list[float], accuracy: int = 10000
) -> DataFrame:
    """The same shape from one pass with a sketch; no interpolation, rank error up to 1 / accuracy."""
    return _in_rows(df, columns, probabilities, lambda value: F.percentile_approx(value, probabilities, accuracy))


def percentiles_by_rank(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """Exact percentiles without an ordered group that grows with the table.

    Each percentile is bracketed between two sketch quantiles, the values are counted per slice of the brackets,
    and only the slice that holds the wanted rank is ordered. The sketch decides how much is ordered, never the
    result. Runs three jobs over ``df``: pass a stored table.
    """
    margin = 2.0 / SKETCH_ACCURACY
    around = sorted({min(max(p + side * margin, 0.0), 1.0) for p in probabilities for side in (-1, 1)})
    # A few numbers per column come to the driver and go back as constants.
    edges = df.agg(*[F.percentile_approx(_value(name), around, SKETCH_ACCURACY).alias(name) for name in columns]).first()
    cells = [
        F.struct(
            F.lit(i).alias("column"),
            _value(name).alias("value"),
            _slice(_value(name), sorted(edges[name] or [])).alias("slice"),
        )
        for i, name in enumerate(columns)
    ]
    values = df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())  # one scan for all columns

    def ranks(size: Column) -> list[Column]:
        position = [(size - 1).cast("double") * p for p in probabilities]
        return [rounded(x) + 1 for x in position for rounded in (F.floor, F.ceil)]

    # Targets 2i and 2i + 1 are the neighbours below and above percentile i.
    found = {(row.stratum, row.target): row for row in rows_at_ranks(values, "column", "slice", ["value"], ranks)}
    lines = []
    for (column, target), row in found.items():
        if target % 2 == 0:
            below, above = row.keys["value"], found[column, target + 1].keys["value"]
            position = (row.stratum_rows - 1) * probabilities[target // 2]
            lines.append((columns[column], probabilities[target // 2], between(below, above, position)))
    return df.sparkSession.createDataFrame(lines, "column_name string, probability double, value double")


def between(below: float, above: float, position: float) -> float:
    """Linear interpolation in the very operations of the built-in ``percentile``, so that both agree to the last bit."""
    low, high = math.floor(position), math.ceil(position)
    if low == high or below == above:
        return below
    return (high - position) * below + (position - low) * above


def _value(name: str) -> Column:
    """The column as a double, without NaN."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def _in_rows(df: DataFrame, columns: list[str], probabilities: list[float], found) -> DataFrame:
    """One row per column and probability from one aggregate that yields an array per column."""
    lines = [
        F.struct(F.lit(name).alias("column_name"), F.lit(p).alias("probability"), F.col(name)[i].alias("value"))
        for name in columns
        for i, p in enumerate(probabilities)
    ]
    arrays = df.agg(*[found(_value(name)).alias(name) for name in columns])
    return arrays.select(F.inline(F.array(*lines))).where(F.col("value").isNotNull())


def _slice(value: Column, edges: list[float]) -> Column:
    """Number of the slice that ``value`` falls into: it grows with the value, and is fine between the edges."""
    number = F.lit(len(edges) * SLICES)
    for i in reversed(range(len(edges))):
        width = edges[i] - edges[i - 1] if i else 0.0
        fine = F.lit(0)
        if 0 < width < math.inf:
            fine = F.least(F.floor((value - edges[i - 1]) / width * (SLICES - 1)), F.lit(SLICES - 1)).cast("int")
        number = F.when(value <= edges[i], fine + i * SLICES).otherwise(number)
    return number
