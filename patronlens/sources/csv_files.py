"""Typed CSV with optional double quotes: ``a,"b ""c"", d"``; one header line; gzip or plain by suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The file format.
READ_FORMAT = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',  # a doubled quote inside quotes, not a backslash
    "mode": "FAILFAST",  # a bad value fails the load instead of becoming null
    "enforceSchema": "true",  # columns bind by position; the header line is only skipped
}
WRITE_FORMAT = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, partitions: int | None = None) -> DataFrame:
    """Read files or folders of CSV with a declared schema.

    A gzip file cannot be split, so its rows come from one task. Land many files; or give ``partitions`` to
    spread the rows of a few large ones evenly before a heavy step.
    """
    df = spark.read.schema(schema).options(**READ_FORMAT).csv(path)
    return df if partitions is None else df.repartition(partitions)


def write_csv(df: DataFrame, path: str, compression: str = "gzip", rows_per_file: int = 2_000_000) -> None:
    """Write a folder of CSV files. Files stay small enough to be read back in parallel although gzip
    cannot be split."""
    (
        df.write.mode("overwrite")
        .options(**WRITE_FORMAT, compression=compression, maxRecordsPerFile=str(rows_per_file))
        .csv(path)
    )
