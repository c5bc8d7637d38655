import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aeroband.operators.nearest import NearestLimits, RightShape, nearest_match, right_shape
from aeroband.functions.labels import standardise
from aeroband.plans import enriched as enrichment
from aeroband.plans import staging
from tests.frames import NOON, observation, reading, readings, weather

PLANS = {
    "broadcast lists": NearestLimits(per_chunk=10_000),
    "shuffled lists": NearestLimits(per_chunk=10_000, broadcast_bytes=0),
    "some buckets crowded": NearestLimits(per_chunk=45),
    "chunks": NearestLimits(per_chunk=1),
    "shuffled chunks": NearestLimits(per_chunk=4, broadcast_bytes=0),
}
LEFT = "id int, bucket long, x double, y double"
RIGHT = "name string, bucket long, x double, y double, v int"


def match(left, right, limits):
    return nearest_match(
        left, right, bucket="bucket", left_xy=("x", "y"), right_xy=("x", "y"), carry=["name", "v"], ties=["name"],
        limits=limits,
    )


def known(*values):
    return all(v is not None and math.isfinite(v) for v in values)


def brute_force(left, right):
    out = []
    for i, bucket, x, y in left:
        ranked = []
        for name, other, px, py, v in right:
            if bucket is not None and bucket == other:
                d = (x - px) * (x - px) + (y - py) * (y - py) if known(x, y, px, py) else None
                ranked.append(((d is None, d or 0.0, name is None, name or "", v), d, name, v))
        best = min(ranked)[1:] if ranked else (None, None, None)
        out.append((i, best[1], best[2], best[0]))
    return sorted(out, key=lambda r: r[0])


def check(spark, left, right, limits):
    found = match(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), limits)
    assert found.columns == ["id", "bucket", "x", "y", "name", "v", "distance_sq"]
    rows = [(r["id"], r["name"], r["v"], r["distance_sq"]) for r in found.orderBy("id").collect()]
    for ours, theirs in zip(rows, brute_force(left, right), strict=True):
        assert ours[:3] == theirs[:3]
        assert ours[3] == (None if theirs[3] is None else pytest.approx(theirs[3], rel=1e-12, abs=1e-15))


@pytest.mark.parametrize("limits", PLANS.values(), ids=PLANS)
def test_special_cases(spark, limits):
    nan = float("nan")
    left = [
        (1, 1, 0.0, 0.0), (2, 1, 0.0, 0.0), (3, 2, 0.0, 0.0), (4, 3, 0.0, 0.0), (5, None, 0.0, 0.0), (6, 4, None, 0.0),
        (7, 4, nan, 0.0), (8, 4, 9.0, 9.0), (9, 5, 1.0, 1.0), (10, 6, 0.0, 0.0), (11, 7, 5.0, 5.0), (12, 1, 1e6, -1e6),
    ]
    right = [
        ("b", 1, 1.0, 0.0, 1), ("a", 1, -1.0, 0.0, 2), ("a", 1, -1.0, 0.0, 1), ("far", 1, 50.0, 50.0, 3),  # ties
        ("alone", 2, 7.0, 7.0, 4),  # one
        # bucket 3: none
        ("z", 4, 9.0, 9.0, 5), ("y", 4, 0.0, 0.0, 6), ("x", 4, None, 1.0, 7),  # unknown on the right
        ("q", 5, None, None, 8), ("p", 5, nan, 1.0, 9),  # only unknown ones
        (None, 6, 0.0, 1.0, 10), ("n", 6, 1.0, 0.0, 11),  # a null tie-break is last
        ("null bucket", None, 0.0, 0.0, 12), ("same", 7, 5.0, 5.0, 13),
    ]
    check(spark, left, right, limits)


@pytest.mark.parametrize("limits", PLANS.values(), ids=PLANS)
@pytest.mark.parametrize("seed", [1, 2])
def test_random_clusters_against_brute_force(spark, limits, seed):
    rng = random.Random(seed)
    place = lambda spread: (rng.gauss(0, spread), rng.gauss(0, spread))
    centres = [place(20) for _ in range(4)] + [(300.0, -200.0)]

    def point():
        centre, off = rng.choice(centres), place(rng.choice([1e-6, 0.01, 3]))
        return centre[0] + off[0], centre[1] + off[1]

    # Half of everything is in one bucket; some points share a place, some sites too.
    bucket = lambda: rng.choice([0, 0, 0, 1, 2, 3])
    right = [(f"p{rng.randrange(40)}", bucket(), *point(), n) for n in range(250)]
    right += [(f"q{n}", 0, *centres[0], n) for n in range(30)]
    left = [(n, bucket(), *(point() if n % 9 else place(400))) for n in range(200)]
    check(spark, left, right, limits)


@pytest.mark.parametrize("limits", PLANS.values(), ids=PLANS)
def test_empty_sides(spark, limits):
    check(spark, [(1, 1, 0.0, 0.0)], [], limits)
    check(spark, [], [("a", 1, 0.0, 0.0, 1)], limits)


def test_shape_is_measured(spark):
    rows = spark.createDataFrame([("a", 1), ("bb", 1), (None, 2), ("c", None), ("c", None)], "n string, b long")
    assert right_shape(rows, "b", 1) == RightShape(5 * 32 + 5, 1)
    assert right_shape(rows, "b", 2) == RightShape(5 * 32 + 5, 0)
    assert right_shape(rows.limit(0), "b") == RightShape(0, 0)


def test_plan_follows_the_measured_size(spark, plan_of):
    left = spark.createDataFrame([(1, 1, 0.0, 0.0)], LEFT)
    right = spark.createDataFrame([("a", 1, 0.0, 0.0, 1), ("b", 1, 0.0, 1.0, 1)], RIGHT)
    assert "BroadcastHashJoin" in plan_of(match(left, right, NearestLimits()))
    assert "_salt" in plan_of(match(left, right, NearestLimits(broadcast_bytes=0)))
    assert "_chunk" not in plan_of(match(left, right, NearestLimits()))
    assert "_chunk" in plan_of(match(left, right, NearestLimits(per_chunk=1)))


def test_a_crowded_bucket_is_cut_into_arrays(spark, monkeypatch):
    """Candidates are the sites times the arrays; other buckets stay out of it."""
    from aeroband.operators import nearest

    seen = []
    closest = nearest._closest
    monkeypatch.setattr(nearest, "_closest", lambda joined: seen.append(joined) or closest(joined))
    right = [(f"p{n}", 0, n % 50 / 7, n // 50 / 3, n) for n in range(1000)] + [("q", 1, 0.0, 0.0, 1), ("far", 0, 1e9, -1e9, 0)]
    left = [(n, n % 2, n % 10 / 3, 0.5) for n in range(400)]
    check(spark, left, right, NearestLimits())
    lists, chunks = seen
    assert lists.filter("bucket = 0").isEmpty()
    sizes = [r["n"] for r in chunks.select(F.size("_pxs").alias("n")).collect()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(sizes) <= 64 and len(sizes) <= 5 * (math.ceil(1001 / 64) + parts)


def model(spark, rows, observations, **options):
    staged = staging.staged_readings(readings(spark, *rows), keep_raw_label=True)
    return enrichment.readings_with_weather(staged, staging.staged_weather(weather(spark, *observations)), **options)


def test_nearest_available_in_the_hour(spark):
    rows = [reading(timestamp=NOON + timedelta(hours=h, minutes=20)) for h in range(3)]
    near = [observation(location_name="near", latitude=50.01)]
    far = [observation(location_name="far", latitude=51.0, timestamp=NOON + timedelta(hours=h)) for h in (0, 1)]
    found = model(spark, rows, near + far).orderBy("measured_at").collect()
    assert [r["weather_station"] for r in found] == ["near", "far", None]
    assert len(found[0]) == 18


def test_reading_without_time_keeps_null_weather(spark):
    found = model(spark, [reading(timestamp=None)], [observation()]).collect()
    assert [(r["measured_at"], r["weather_station"]) for r in found] == [(None, None)]


def test_colliding_labels_collapse_by_distance_then_ingest_then_label(spark):
    later = datetime(2024, 1, 12)
    two = lambda **b: [reading(pollutant="PM2.5", value=1.0), reading(pollutant="Particulate 2.5", value=2.0, **b)]
    value = lambda rows: [r["measurement_value"] for r in model(spark, rows, [observation()]).collect()]
    assert value(two(latitude=50.5, ingested_at=later)) == [1.0]
    assert value(two(ingested_at=later)) == [2.0]
    assert value(two()) == [1.0]


def test_only_colliding_names_are_collapsed(spark):
    rows = [reading(station_id=str(i % 3), timestamp=NOON + timedelta(hours=i)) for i in range(9)]
    rows += [reading(pollutant=label, value=v) for label, v in (("PM2.5", 1.0), ("Particulate 2.5", 2.0))]
    raw, air = readings(spark, *rows), weather(spark, observation())
    names = enrichment.colliding_names(raw.select(F.col("pollutant").alias("raw_label")), standardise("raw_label"))
    assert [r["pollutant"] for r in names.collect()] == ["PM2.5"]
    found = enrichment.enriched(raw, air)
    assert sorted(map(str, found.collect())) == sorted(map(str, model(spark, rows, [observation()]).collect()))
    assert found.count() == 10


def test_hour_join_counts_the_weather_of_the_hour(spark):
    rows = [reading(timestamp=t) for t in (NOON + timedelta(minutes=59), NOON + timedelta(hours=1), None)]
    air = [observation(), observation(location_name="There", temperature_2m=4.0)]
    joined = enrichment.hour_joined(
        staging.staged_readings(readings(spark, *rows)), staging.staged_weather(weather(spark, *air))
    )
    found = {r["measured_at"]: (r["weather_rows"], r["hour_temperature"]) for r in joined.collect()}
    assert found == {NOON + timedelta(minutes=59): (2, 2.5), NOON + timedelta(hours=1): (0, None), None: (0, None)}


def test_a_hot_key_is_spread_over_reducers(spark, plan_of):
    from aeroband.operators.joins import join_on_bucket, salted

    key = F.when(F.col("id") % 3 > 0, 7).when(F.col("id") % 9 > 0, F.col("id"))
    left = spark.range(9000).select(key.alias("k"), "id")
    right = spark.createDataFrame([(7, "seven"), (3, "three"), (None, "null")], "k long, word string")
    joined = join_on_bucket(left, right, ["k"], most=500)
    words = {r["word"]: r["n"] for r in joined.groupBy("word").agg(F.count("*").alias("n")).collect()}
    assert words == {"seven": 6000, "three": 1, None: 2999}
    assert joined.columns == ["k", "id", "word"]
    # Twelve copies of the right row of the hot key, two for the nulls, one of the other; none without skew.
    for most, copies in ((500, {7: 12, 3: 1, None: 2}), (10_000, {7: 1, 3: 1, None: 1})):
        spread, copied = salted(left, right, ["k"], most)
        assert {r["k"]: r["count"] for r in copied.groupBy("k").count().collect()} == copies
        assert spread.filter("k = 7").select("_salt").distinct().count() == copies[7]
