"""Activity per day and type of event from a stream whose events come late, out of order and more than once.

The watermark is the newest event time of all batches before, less the delay. An event at or behind it is dropped; an event whose
id was seen within the delay is dropped as a repetition; a day is written once, as soon as the watermark has passed its end. State is
bounded by the events and days of one delay, lives in the checkpoint folder and is taken up again after a restart. Counts are combined
inside each task before the shuffle, so a type of event with a third of all rows is a row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.functions import sum_money
from patronlens.operators.sketches import distinct_sketch
from patronlens.streaming.jobs import feature_stream, run_to_end

DELAY = "1 day"


def as_instant(wall_clock: str | Column) -> Column:
    """A timestamp without a zone, read as UTC whatever the zone of the session: watermarks need instants."""
    moment = F.col(wall_clock) if isinstance(wall_clock, str) else wall_clock
    return F.from_utc_timestamp(moment.cast("timestamp"), F.current_timezone())


def as_wall_clock(instant: Column) -> Column:
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")


def fresh_events(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """``events`` (event_id, ts, ...) without those behind the watermark and without repetitions, with the instant ``at``."""
    return events.withColumn("at", as_instant("ts")).withWatermark("at", delay).dropDuplicatesWithinWatermark(["event_id"])


def daily_activity(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """Per day and event type: events, their value, and a sketch of the users that can be united over any days."""
    return (
        fresh_events(events, delay)
        .groupBy(F.window("at", "1 day").alias("day"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("events"),
            sum_money("value").alias("total_value"),
            distinct_sketch("user_id").alias("users"),
        )
        .select(as_wall_clock(F.col("day.start")).cast("date").alias("day"), "event_type", "events", "total_value", "users")
    )


def append_activity(spark: SparkSession, folder: str, schema: T.StructType, target: str, progress: str, delay: str = DELAY) -> None:
    """Take in the events that were added to ``folder``; append the days that the watermark has passed to ``target``."""
    run_to_end(daily_activity(feature_stream(spark, folder, schema), delay), target, progress)
