"""Do landed files and a stored table hold the same rows, each the same number of times?

Both sides are summed up per bucket of the key: number of rows and sums of the four halves of two 64-bit hashes of the whole row. Sums do not depend
on the order of rows and count repeats; they are combined inside each task, so equal sides shuffle a few numbers per bucket and no row.
Only rows of buckets that differ are then compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
HALF = (1 << 32) - 1
KINDS = ("missing", "extra", "repeated")


def _bucket(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("bucket")


def bucket_checksums(rows: DataFrame, key: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, sums): equal for equal multisets of rows, whatever their order."""
    columns = sorted(rows.columns)
    hashes = [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]
    halves = [half for h in hashes for half in (h.bitwiseAND(F.lit(HALF)), F.shiftrightunsigned(h, 32))]
    sums = F.array(*[F.sum(half) for half in halves])
    return rows.groupBy(_bucket(key, buckets)).agg(F.count(F.lit(1)).alias("rows"), sums.alias("sums"))


def differing_buckets(landed: DataFrame, stored: DataFrame, key: list[str], buckets: int = BUCKETS) -> list[int]:
    """The buckets in which the sides differ, in order; there are at most ``buckets``."""
    a, b = (bucket_checksums(side, key, buckets) for side in (landed, stored))
    both = a.withColumn("side", F.lit(1)).unionByName(b.withColumn("side", F.lit(2)))
    same = both.groupBy("bucket", "rows", "sums").agg(F.count(F.lit(1)).alias("sides")).where("sides < 2")
    return sorted(row.bucket for row in same.select("bucket").distinct().collect())


def reconcile(landed: DataFrame, stored: DataFrame, key: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The columns, with landed_rows, stored_rows and kind, of every different row that the sides hold a different number of times.

    ``missing``: landed only; ``extra``: stored only; ``repeated``: in both, more often in one. Both sides need the same columns and types.
    Nulls are equal to nulls; a null key has a bucket like any other. Empty sides are allowed.
    """
    layout = {field.name: field.dataType for field in landed.schema}
    if layout != {field.name: field.dataType for field in stored.schema}:
        raise ValueError("landed files and stored table have different columns")
    wanted = differing_buckets(landed, stored, key, buckets)
    few = landed.sparkSession.createDataFrame([(bucket,) for bucket in wanted], "bucket int")
    sides = [
        side.withColumns({"bucket": _bucket(key, buckets), "_landed": F.lit(1 - i), "_stored": F.lit(i)})
        for i, side in enumerate((landed, stored))
    ]
    rows = sides[0].unionByName(sides[1]) if wanted else sides[0].limit(0)
    kind = F.when(F.col("stored_rows") == 0, KINDS[0]).when(F.col("landed_rows") == 0, KINDS[1]).otherwise(KINDS[2])
    return (
        rows.join(F.broadcast(few), "bucket", "left_semi")
        .groupBy(*landed.columns)
        .agg(F.sum("_landed").alias("landed_rows"), F.sum("_stored").alias("stored_rows"))
        .where("landed_rows <> stored_rows")
        .withColumn("kind", kind)
    )
