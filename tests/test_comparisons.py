"""Interval joins, totals merged upwards, drift and reconciliation against plain computations."""

import datetime as dt
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from patronlens.operators import drift, intervals, rollups
from patronlens.sources.reconciliation import bucket_checksums, differing_buckets, reconcile

START = dt.datetime(2024, 1, 1)


def spans(draw, count):
    rows = []
    for i in range(count):
        start = START + dt.timedelta(hours=draw.randrange(-5000, 5000))
        length = draw.choice([0, 1, 20, 24, 300, 9000])
        end = start + dt.timedelta(hours=length if draw.random() < 0.95 else -1)
        user = 1 if draw.random() < 0.35 else draw.choice([2, 3, None])
        rows.append((i, user, None if draw.random() < 0.03 else start, None if draw.random() < 0.03 else end))
    return rows + rows[:3]


@pytest.mark.parametrize("keys", [[], ["user"]])
def test_overlaps_equal_comparing_all(spark, adaptive, keys):
    draw = random.Random(5)
    left, right = spans(draw, 150), spans(draw, 120)
    a, b = (spark.createDataFrame(rows, "id int, user int, start timestamp_ntz, end timestamp_ntz").repartition(3) for rows in (left, right))
    found = intervals.overlap_join(a, b, ("start", "end"), ("start", "end"), keys).select("left.id", F.col("right.id").alias("other"))
    expected = []
    for i, u, s, e in left:
        for j, v, t, f in right:
            if None in (s, e, t, f) or s > e or t > f or (keys and (u is None or u != v)):
                continue
            if s <= f and t <= e:
                expected.append((i, j))
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in found._jdf.queryExecution().executedPlan().toString()
    assert intervals.overlap_join(a.limit(0), b, ("start", "end"), ("start", "end"), keys).collect() == []


def test_long_spans_do_not_multiply(spark):
    day = "timestampadd(DAY, {}, timestamp_ntz'2000-01-01 00:00:00')"
    rows = spark.range(200).selectExpr("id", f"{day.format('-id')} AS start", f"{day.format('id * id')} AS end")
    placed = intervals._spans(rows, [], ("start", "end"), intervals.day_number, "left")
    sizes = intervals._sizes(placed, "left")
    binned = intervals._in_bins(placed, "left", sizes)
    assert binned.groupBy("left_0").count().agg(F.max("count")).first()[0] <= 2 * len(sizes) <= 40


def test_cube_merges_upwards(spark):
    draw = random.Random(7)
    rows = [(draw.choice(["a", "b", None]), draw.choice(["x", None]), draw.randrange(3), draw.randrange(10_000) / 100) for _ in range(300)]
    lines = spark.createDataFrame(rows, "s string, c string, m int, amount double").repartition(3)
    by = ["s", "c", "m"]
    cube = rollups.cube_totals(rollups.finest_totals(lines, by, "amount"), by)
    got = {(r.grouping_id, r.s, r.c, r.m): (r.rows, round(r.amount, 2), r.largest) for r in cube.collect()}
    expected = {}
    for size in range(4):
        for kept in combinations(range(3), size):
            bits = sum(4 >> i for i in range(3) if i not in kept)
            for row in rows:
                key = (bits, *[row[i] if i in kept else None for i in range(3)])
                expected.setdefault(key, []).append(row[3])
    assert got == {key: (len(v), round(sum(v), 2), max(v)) for key, v in expected.items()}
    assert cube.count() == len(expected)  # rows without a value and totals stay apart
    nothing = rollups.cube_totals(rollups.finest_totals(lines.limit(0), by, "amount"), by)
    assert [tuple(r) for r in nothing.collect()] == [(None, None, None, 7, 0, None, None)]
    wide = {r.m: r for r in rollups.pivoted_amounts(rollups.finest_totals(lines, by, "amount"), "m", "s", ["a", "z"]).collect()}
    for m, row in wide.items():
        assert round(row.a, 2) == round(sum(x[3] for x in rows if x[2] == m and x[0] == "a"), 2)
        assert round(row.all_amounts, 2) == round(sum(x[3] for x in rows if x[2] == m), 2) and row.z is None


def ks(a, b):
    return max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in {*a, *b})


SAMPLES = {
    "shifted": lambda d: ([d.gauss(0, 1) for _ in range(300)], [d.gauss(0.1, 1) for _ in range(250)]),
    "ties": lambda d: ([float(d.randrange(4)) for _ in range(300)], [float(d.randrange(5)) for _ in range(90)]),
    "heavy": lambda d: ([0.0] * 200 + [d.random() * 1e-9 for _ in range(99)], [d.random() * 1e12 for _ in range(50)] + [0.0] * 70),
    "powers": lambda d: ([2.0**d.randrange(-900, 900) for _ in range(200)], [-(2.0 ** d.randrange(-900, 900)) for _ in range(100)]),
    "ends": lambda d: ([float("-inf"), 1.0, float("inf")] * 5, [1.5, float("inf"), 1.7e308, -1.7e308] * 5),
    "equal": lambda d: ([3.0] * 40, [3.0] * 7),
}


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("ordered_rows", [4, 10_000])
def test_distance_is_exact(spark, name, ordered_rows):
    a, b = SAMPLES[name](random.Random(3))
    gaps = [None, float("nan")]
    before, now = (spark.createDataFrame([(x,) for x in [*side, *gaps]], "v double").repartition(2) for side in (a, b))
    rows_a, rows_b, distance = drift.kolmogorov_smirnov(before, now, "v", ordered_rows)
    assert (rows_a, rows_b) == (len(a), len(b)) and distance == pytest.approx(ks(a, b), abs=1e-12)


def test_stability_and_empty_sides(spark):
    before = spark.createDataFrame([(float(i % 50), 1.0) for i in range(500)], "v double, w double")
    now = spark.createDataFrame([(float(i % 20), None) for i in range(100)], "v double, w double")
    rows = {r.column_name: r for r in drift.drift(before, now, ["v", "w"]).collect()}
    assert rows["v"].ks == pytest.approx(0.6) and rows["v"].stability > 1
    assert (rows["w"].rows_now, rows["w"].ks, rows["w"].stability) == (0, None, None)
    same = drift.drift(before, before, ["v"]).first()
    assert same.ks == 0 and same.stability == 0


def test_reconciliation_equals_except_all(spark):
    draw = random.Random(9)
    landed = [(draw.choice([None, *range(200)]), draw.choice(["p", None]), draw.choice([0.5, float("nan"), None])) for _ in range(400)]
    stored = [row for row in landed if draw.random() < 0.97] + landed[:4] + [(999, "new", 1.0), (5, "changed", None)]
    kind = "k int, s string, v double"
    a, b = (spark.createDataFrame(rows, kind).repartition(n) for rows, n in ((landed, 2), (stored, 3)))
    found = reconcile(a, b, ["k"], 64)
    text = lambda rows: sorted(repr(tuple(r)) for r in rows)
    missing = found.where("landed_rows > stored_rows").selectExpr("k", "s", "v", "explode(sequence(1, landed_rows - stored_rows)) AS n")
    extra = found.where("landed_rows < stored_rows").selectExpr("k", "s", "v", "explode(sequence(1, stored_rows - landed_rows)) AS n")
    assert text(missing.drop("n").collect()) == text(a.exceptAll(b).collect())
    assert text(extra.drop("n").collect()) == text(b.exceptAll(a).collect())
    assert {r.kind for r in found.collect()} == {"missing", "extra", "repeated"}
    for r in found.collect():
        assert r.kind == ("missing" if not r.stored_rows else "extra" if not r.landed_rows else "repeated")


def test_equal_sides_compare_no_row(spark):
    rows = spark.range(500).selectExpr("id % 300 AS k", "cast(id % 7 AS string) AS s")
    other = rows.repartition(5).select("s", "k")
    assert differing_buckets(rows, other, ["k"], 32) == []
    assert bucket_checksums(rows, ["k"], 32).count() <= 32
    assert reconcile(rows, other, ["k"]).collect() == []
    assert reconcile(rows.limit(0), rows.limit(0), ["k"]).collect() == []
    assert reconcile(rows.limit(0), rows, ["k"], 8).where("kind = 'extra'").count() == rows.distinct().count()
    twice = rows.unionAll(rows)  # an even number of repeats must not cancel
    assert {r.kind for r in reconcile(rows, twice, ["k"], 8).collect()} == {"repeated"}
    with pytest.raises(ValueError):
        reconcile(rows, rows.withColumn("k", F.col("k").cast("int")), ["k"])
