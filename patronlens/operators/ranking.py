"""Exact selection by rank without sorting the whole table.

A global sort, or a window over a whole group, would put a stratum of any size into one task. Here rows are
counted per coarse bucket first; the counts tell which bucket holds a wanted rank, and only the rows of that
bucket are ordered.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RankedRow:
    stratum: object
    stratum_rows: int
    target: int  # position in the list of wanted ranks
    keys: Row


def rows_at_ranks(
    df: DataFrame,
    stratum: str,
    bucket: str,
    keys: list[str],
    ranks: Callable[[Column], list[Column]],
) -> list[RankedRow]:
    """The ``keys`` found at wanted 1-based ranks of each stratum, ordered by ``keys``.

    ``bucket`` (an integer) must not decrease with ``keys`` and must have few distinct values; strata must be
    few. ``ranks`` maps the size of a stratum (a bigint) to the wanted ranks; one outside the stratum gives no
    row. Runs two jobs over ``df``, so pass a stored table; what comes back is one row per stratum and rank.
    """
    wanted = _buckets_at_ranks(df, stratum, bucket, ranks)
    if not wanted:
        return []
    hit = reduce(or_, [(F.col(stratum) == s) & (F.col(bucket) == b) for s, b in {(w[stratum], w[bucket]) for w in wanted}])
    # Equal keys collapse before the shuffle, however often they occur.
    counted = df.select(stratum, bucket, *keys).where(hit).groupBy(stratum, bucket, *keys).agg(F.count(F.lit(1)).alias("_ties"))
    in_order = Window.partitionBy(stratum, bucket).orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("_last", F.sum("_ties").over(in_order)).withColumn(
        "_targets",
        F.array_compact(
            F.array(
                *[
                    F.when(
                        (F.col(stratum) == w[stratum])
                        & (F.col(bucket) == w[bucket])
                        & F.lit(w["rank"] - w["before"]).between(F.col("_last") - F.col("_ties") + 1, F.col("_last")),
                        F.lit(position),
                    )
                    for position, w in enumerate(wanted)
                ]
            )
        ),
    )
    found = placed.select(F.explode("_targets").alias("_position"), F.struct(*keys).alias("_keys")).collect()
    return [
        RankedRow(w[stratum], w["stratum_rows"], w["target"], keys_found)
        for w, keys_found in ((wanted[position], keys_found) for position, keys_found in found)
    ]


def _buckets_at_ranks(df: DataFrame, stratum: str, bucket: str, ranks: Callable[[Column], list[Column]]) -> list[Row]:
    """Per stratum and wanted rank the bucket that holds it, and the number of rows in earlier buckets."""
    whole = Window.partitionBy(stratum)
    earlier = whole.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(stratum, bucket).agg(F.count(F.lit(1)).alias("_in_bucket"))
    return (
        counts.where(F.col(stratum).isNotNull())
        .withColumn("before", F.coalesce(F.sum("_in_bucket").over(earlier), F.lit(0)))
        .withColumn("stratum_rows", F.sum("_in_bucket").over(whole))
        .select("*", F.posexplode(F.array(*ranks(F.col("stratum_rows")))).alias("target", "rank"))
        .where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("_in_bucket")))
        .collect()
    )
