import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from patronlens.operators import sketches
from patronlens.operators.engineered import Thresholds
from patronlens.operators.scoring import ChurnModel, LinearModel, score_features
from patronlens.shared import new_path, write_table
from patronlens.streaming import activity, jobs
from tests import samples

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
DAY = dt.datetime(2024, 1, 1)


def event(number, hours, kind="view", value=1.0, user=1):
    return (number, DAY + dt.timedelta(hours=hours), user, kind, value, None)


def test_late_and_repeated_events_over_restarts(spark):
    folder, target, progress = (new_path(spark, name) for name in ("events", "activity", "progress"))
    landings = [
        [event(1, 1), event(2, 5, value=2.5), event(2, 5, value=2.5), event(3, 30, "click")],  # watermark: hour 6
        # of the first day, in any order: behind the watermark, just ahead of it, and one that came before
        [event(4, 6), event(5, 6.001), event(2, 5, value=2.5), event(6, 60, "click"), event(3, 30, "click")],  # watermark: hour 36
        [event(7, 35), event(8, 40), event(9, 120, "click")],  # watermark: hour 96
    ]
    seen = []
    schema = spark.createDataFrame([], SCHEMA).schema
    for rows in landings:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        activity.append_activity(spark, folder, schema, target, progress)
        seen.append(sorted((r.day.day, r.event_type, r.events, r.total_value) for r in spark.read.parquet(target).collect()))
    first_day = (1, "view", 3, 4.5)  # events 1, 2 and 5; event 4 is at the watermark
    assert seen[0] == [] and seen[1] == [first_day]
    assert seen[2] == [first_day, (2, "click", 1, 1.0), (2, "view", 1, 1.0), (3, "click", 1, 1.0)]  # event 7 was late
    activity.append_activity(spark, folder, schema, target, progress)  # nothing new
    assert spark.read.parquet(target).count() == 4
    users = spark.read.parquet(target).agg(F.hll_sketch_estimate(F.hll_union_agg("users"))).first()[0]
    assert users == 1


def test_wall_clock_and_instant_do_not_depend_on_the_zone(spark):
    df = spark.createDataFrame([(DAY,)], "ts timestamp_ntz")
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            row = df.select(
                F.unix_seconds(activity.as_instant("ts")).alias("s"), activity.as_wall_clock(activity.as_instant("ts")).alias("w")
            ).first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert row.s == 1704067200 and row.w == DAY


def test_merged_percentiles_are_as_near_as_stated(spark):
    draw = random.Random(4)
    values = [draw.lognormvariate(4, 2) for _ in range(60_000)]
    parts = []
    for i in range(30):  # unequal batches
        own = values[i * i * 66 : (i + 1) * (i + 1) * 66]
        rows = spark.createDataFrame([(v, int(v) % 50) for v in own], "total_spent double, total_transactions long")
        parts.append(sketches.feature_sketches(rows))
    while len(parts) > 1:
        parts = [a.unionAll(b) for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) // 2 * 2 :]
    stored = spark.read.parquet(write_table(parts[0], "sketches"))
    seen = sorted(values[: 30 * 30 * 66])
    assert sketches.merged_sketches(stored).first().rows == len(seen)
    for share in (0.1, 0.5, 0.8, 0.99):
        limit = sketches.sketched_thresholds(stored, share).total_spent
        assert abs(sum(v <= limit for v in seen) / len(seen) - share) <= sketches.RANK_ERROR + 1 / len(seen)
    assert sketches.RANK_ERROR < 0.0011


def test_a_stream_is_scored_with_sketched_thresholds(spark, tmp_path):
    features = samples.features(spark, samples.feature_rows(100))
    limits = sketches.sketched_thresholds(sketches.feature_sketches(features))
    model = ChurnModel("LogisticRegression", limits, LinearModel((0.01,) * 12, -0.2))
    folder = write_table(features, "features")
    jobs.score_stream(jobs.feature_stream(spark, folder, features.schema), model, str(tmp_path / "t"), str(tmp_path / "p"))
    assert sorted(spark.read.parquet(str(tmp_path / "t")).collect()) == sorted(score_features(features, model).collect())
    assert 10 <= features.where(F.col("total_spent") > limits.total_spent).count() <= 21
    assert sketches.sketched_thresholds(sketches.feature_sketches(features.limit(0))) == Thresholds(float("inf"), float("inf"))


def test_distinct_counts_of_ranges_from_daily_sketches(spark):
    rows = spark.range(40_000).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 20).cast("int")).alias("day"), F.pmod(F.xxhash64("id"), F.lit(7000)).alias("user")
    )
    daily = spark.read.parquet(write_table(rows.groupBy("day").agg(sketches.distinct_sketch("user").alias("users")), "daily"))
    ranges = [(dt.date(2024, 1, a), dt.date(2024, 1, b)) for a, b in ((1, 1), (1, 7), (5, 20), (3, 18), (19, 25))]
    got = {(r.range_from, r.range_to): r.distinct_estimate for r in sketches.distinct_in_ranges(daily, "day", "users", [], ranges).collect()}
    for first, last in ranges:
        exact = rows.where(F.col("day").between(first, last)).select("user").distinct().count()
        assert abs(got[first, last] - exact) <= 4 * sketches.DISTINCT_ERROR * exact
    with pytest.raises(ValueError):
        sketches.distinct_in_ranges(daily, "day", "users", [], [])
