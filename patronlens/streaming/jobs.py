"""Structured Streaming jobs: incremental ingest of landed files, and scoring of arriving feature rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from patronlens.operators.scoring import ChurnModel, score_features
from patronlens.sources.csv_files import READ_FORMAT

FILES_PER_BATCH = 10_000


def csv_stream(spark: SparkSession, landing: str, schema: T.StructType, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """New CSV files of a landing folder."""
    return (
        spark.readStream.schema(schema)
        .options(**READ_FORMAT, maxFilesPerTrigger=str(files_per_batch))
        .csv(landing)
    )


def run_to_end(stream: DataFrame, target: str, progress: str) -> None:
    """Append all that is new to the Parquet table at ``target``, then stop.

    ``progress`` remembers what was loaded: each input file is loaded once, over any number of runs, and a run
    that was cut short resumes there. Both folders belong on shared storage.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()


def each_new_batch(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    action: Callable[[DataFrame, int], None],
    progress: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Call ``action`` with all rows that were added to a Parquet folder since the last call, in numbered batches.

    A batch that was cut short is repeated under its number by the next call, so ``action`` has to replace what it left.
    """
    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", str(files_per_batch))
        .parquet(folder)
        .writeStream.foreachBatch(action)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_new_files(spark: SparkSession, landing: str, schema: T.StructType, target: str, progress: str) -> None:
    """Load the files that arrived since the last run."""
    run_to_end(csv_stream(spark, landing, schema), target, progress)


def feature_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Feature rows as they are added to a Parquet folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files_per_batch)).parquet(folder)


def score_stream(features: DataFrame, model: ChurnModel, target: str, progress: str) -> None:
    """Score arriving rows with the batch expression. It is stateless: the thresholds come with the model."""
    run_to_end(score_features(features, model), target, progress)
