"""Operators that must not gather a group: brute force, and bounds on what one task holds."""
import math
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from waymark.config import Settings
from waymark.operators import drift, eta, quantiles, rolling, silver as silver_ops

T0 = datetime(2024, 1, 1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ exact quantiles

@pytest.mark.parametrize("n", [1, 2, 3, 11, 5000])
def test_quantiles_equal_percentile(spark, n):
    """Unrounded doubles, a hot value, negative values, several groups of different sizes."""
    v = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("feature"),
        F.when(F.col("id") % 5 < 2, F.lit(1.5)).otherwise((F.rand(7) - 0.3) * 1e3).alias("value")).cache()
    probs = [i / 10 for i in range(11)] + [0.123, 0.9999]
    counts = v.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    got = {r.feature: r.q for r in quantiles.exact_quantiles(counts, probs, parts=7).collect()}
    want = {r.feature: r.q for r in v.groupBy("feature").agg(
        F.percentile("value", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()}
    assert got == want
    v.unpersist()


def test_quantiles_hold_one_partition_at_a_time(spark):
    v = spark.range(20_000).select(F.lit("a").alias("feature"), F.rand(1).alias("value"), F.lit(1).alias("n"))
    t = quantiles.ranged(v, "feature", "value", 16)
    sizes = [r["count"] for r in t.groupBy("feature", "part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 20_000 / 8
    assert "percentile" not in _plan(quantiles.exact_quantiles(v, [0.5], parts=16))
    assert quantiles.exact_quantiles(v.limit(0), [0.5]).count() == 0


def test_cut_points_of_unrounded_features(spark):
    ref = spark.range(3000).select((F.rand(3) * 40).alias("dist_remaining_km"),
                                   F.when(F.col("id") % 4 == 0, 0.0).otherwise(F.rand(4) * 90).alias("speed_kmh")).cache()
    cuts = {r.feature: r.cuts for r in drift.cut_points(ref).collect()}
    for f, c in cuts.items():
        want = ref.select(F.percentile(f, F.array(*[F.lit(i / 10) for i in range(11)]))).first()[0]
        assert c[1:-1] == want[1:-1] and c[0] == -math.inf and c[-1] == math.inf


# ------------------------------------------------------------------ trailing means

def _pings(spark, n, hour_only):
    rng = random.Random(n)
    data = []
    for i in range(n):
        ship = "HOT" if i % 3 else f"S{i % 7}"
        t = T0 + timedelta(seconds=rng.randint(0, 3599 if hour_only or ship == "HOT" else 90_000))
        if i % 11 == 0:
            t = None
        data.append((ship, t, i, rng.choice([None, 0.0, 12.5, 33.3, 47.1])))
    return spark.createDataFrame(data, "shipment_id string, event_time timestamp, seq bigint, speed_kmh double")


@pytest.mark.parametrize("rows", [40, 300, 10**6])
def test_trailing_mean_with_dense_hours(spark, rows):
    """A shipment with all its rows in one hour, and rows without a time: split by range."""
    df = _pings(spark, 2000, False).repartition(5).cache()
    st = Settings(rolling_bucket_rows=rows)
    got = rolling.trailing_mean(df, "shipment_id", "event_time", "seq", "speed_kmh", "m", 5, st)
    w = Window.partitionBy("shipment_id").orderBy("event_time", "seq").rowsBetween(-4, 0)
    want = df.withColumn("m", F.avg("speed_kmh").over(w))
    assert Counter(map(repr, got.collect())) == Counter(map(repr, want.select(got.columns).collect()))
    df.unpersist()


def test_dense_hour_is_spread(spark):
    df = _pings(spark, 6000, True).cache()
    b = rolling._bucketed(df, "shipment_id", "event_time", "seq", Settings(rolling_bucket_rows=400))
    sizes = [r["count"] for r in b.groupBy("shipment_id", "_bkt", "_part").count().collect()]
    assert sum(sizes) == 6000 and max(sizes) <= 2 * 400            # the hot hour alone has over 3,000
    # order of ranges is the order of time
    r = b.where("shipment_id = 'HOT' AND event_time IS NOT NULL").groupBy("_part").agg(
        F.min(F.struct("event_time", "seq")).alias("lo"), F.max(F.struct("event_time", "seq")).alias("hi")).orderBy("_part").collect()
    assert len(r) > 5 and all(x.hi < y.lo for x, y in zip(r, r[1:]))
    df.unpersist()


def test_latest_trailing_mean_limits_before_the_shuffle(spark):
    df = _pings(spark, 2000, False).repartition(4)
    got = rolling.latest_trailing_mean(df, "shipment_id", "event_time", "seq", "speed_kmh", "m", 5)
    assert _plan(got).count("WindowGroupLimit") >= 2
    w = Window.partitionBy("shipment_id").orderBy("event_time", "seq").rowsBetween(-4, 0)
    last = df.withColumn("m", F.avg("speed_kmh").over(w)).groupBy("shipment_id").agg(
        F.max_by("m", F.struct("event_time", "seq")).alias("m"))
    assert Counter(map(repr, got.collect())) == Counter(map(repr, last.collect()))


# ------------------------------------------------------------------ bootstrap

def test_bootstrap_does_not_depend_on_partitioning(spark, monkeypatch):
    monkeypatch.setattr(eta, "CELL_ROWS", 50)
    monkeypatch.setattr(eta, "RANGES", 4)
    monkeypatch.setattr(eta, "CHUNK", 64)
    df = spark.range(1500).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("id"), F.lit("x").alias("_a")).cache()
    one = Counter(map(tuple, eta.bootstrap_sample(df, 700, seed=9).collect()))
    assert sum(one.values()) == 700
    for parts in (1, 7):
        assert Counter(map(tuple, eta.bootstrap_sample(df.repartition(parts), 700, seed=9).collect())) == one
    assert Counter(map(tuple, eta.bootstrap_sample(df, 700, seed=10).collect())) != one
    assert 170 < one[(-1, "x")] < 300                               # a third of the rows
    big = Counter(r.id for r in eta.bootstrap_sample(df, 15_000).collect())
    assert sum(big.values()) == 15_000 and abs(big[-1] - 5000) < 400
    singles = [big[i] for i in range(1500) if i % 3]
    assert abs(sum(singles) / len(singles) - 10) < 1 and max(singles) < 30
    assert eta.bootstrap_sample(df, 0).count() == eta.bootstrap_sample(df.limit(0), 5).count() == 0
    df.unpersist()


def test_multinomial_split():
    s = eta._split(10_000, [1, 0, 4, 5], 3)
    assert sum(s) == 10_000 and s[1] == 0 and abs(s[3] - 5000) < 300
    assert eta._split(7, [3], 1) == [7]


# ------------------------------------------------------------------ large route networks

def _route(spark, points):
    segs = [dict(ax=a[0], ay=a[1], bx=b[0], by=b[1]) for a, b in zip(points, points[1:])]
    return [(tuple(s[k] for k in ("ax", "ay", "bx", "by"))) for s in segs]


def _routes(spark, routes):
    return spark.createDataFrame([(k, v) for k, v in routes.items()],
                                 "route_id string, segs array<struct<ax:double,ay:double,bx:double,by:double>>")


def test_diagonal_registers_in_cells_of_its_length(spark):
    def cells(km):
        end = km / math.sqrt(2)
        seg = _routes(spark, {"R": [(0.3, 0.1, end, end * 0.97)]})
        return silver_ops.segment_index(seg, 2.0).agg(F.count(F.lit(1)), F.sum(F.size("cand"))).first()
    (n1, c1), (n2, c2) = cells(250), cells(500)
    assert c1 == n1 and c2 == n2                                    # one segment: one candidate a cell
    assert n2 < 2.2 * n1 and n2 < 8 * 500 / 2                       # the bounding box has 31,000


def test_index_equals_every_segment(spark):
    """Long, short, vertical, horizontal and empty segments; pings on, near and far off the route."""
    rng = random.Random(4)
    pts = [(11500.0, 150.0)]
    for i in range(300):
        x, y = pts[-1]
        step = rng.choice([0.0, 0.02, 0.5, 3.0, 40.0])
        a = rng.choice([0, math.pi / 2, rng.random() * 6.3])
        pts.append((x + step * math.cos(a), y + step * math.sin(a)))
    arrays = _routes(spark, {"A": _route(spark, pts), "B": _route(spark, [(11500.0, 100.0), (11850.0, 450.0)]), "E": []})
    st = Settings()
    to_lon = lambda x: math.degrees(x / (st.cos_lat0 * st.earth_km))
    to_lat = lambda y: math.degrees(y / st.earth_km)
    rows = []
    for i in range(400):
        x, y = rng.choice(pts)
        off = rng.choice([0.0, 0.3, 2.0, 4.0, 20.0, 300.0, 5000.0])
        rows.append((i, rng.choice("AB"), to_lat(min(9900.0, y + rng.uniform(-off, off))), to_lon(x + rng.uniform(-off, off))))
    rows += [(900, "A", 0.0, 0.0), (901, "B", -80.0, -179.9), (902, "Z", 1.3, 103.8), (903, None, 1.3, 103.8), (904, "A", None, 103.8), (905, "E", 1.3, 103.8)]
    pings = spark.createDataFrame(rows, "id int, route_id string, lat double, lon double").cache()
    full = {r.id: r.d for r in silver_ops._dist_to_route_join(pings, arrays, st, "d").collect()}
    for cell in (0.5, 30.0):
        got = {r.id: r.d for r in silver_ops.dist_to_route_indexed(pings, arrays, Settings(segment_cell_km=cell), "d").collect()}
        assert got == full, cell
    # the same at each threshold of the dispatch
    for s in (Settings(unroll_max_segments=10**6), Settings(unroll_max_segments=0, segment_index_min=10**9),
              Settings(unroll_max_segments=0, segment_index_min=1)):
        assert {r.id: r.d for r in silver_ops.dist_to_route(pings, arrays, s, "d").collect()} == full
    pings.unpersist()


def test_near_pings_meet_few_segments(spark):
    """A polyline of 5,000 short segments: a ping beside it gets a cell's share, not the route."""
    pts = [(11000 + i * 0.05, 100 + 0.01 * (i % 7)) for i in range(5001)]
    idx = silver_ops.segment_index(_routes(spark, {"R": _route(spark, pts)}), 2.0)
    assert idx.agg(F.max(F.size("cand"))).first()[0] <= 250


def test_broadcast_bound_counts_bytes(spark):
    from waymark.sources import network
    wide = spark.range(3).select("id", F.array_repeat(F.lit(1.0), 1000).alias("a"))
    hinted = lambda df: "BroadcastHint" in df._jdf.queryExecution().logical().toString() or "broadcast" in df._jdf.queryExecution().logical().toString()
    assert hinted(network.maybe_broadcast(wide, Settings()))
    assert not hinted(network.maybe_broadcast(wide, Settings(broadcast_max_bytes=1000)))
    assert not hinted(network.maybe_broadcast(wide, Settings(broadcast_max_rows=2)))
