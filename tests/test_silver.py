"""Silver validation, dedup, enrichment: boundaries and the golden counts."""
import pytest
from pyspark.sql import functions as F

from waymark.operators import silver as so
from waymark.sources import envelope, network


def _rows(spark, rows):
    return spark.createDataFrame(rows, "shipment_id string, route_id string, lat double, lon double, "
                                       "speed_kmh double, dist_km double, total_km double, seq bigint")


def test_validation_boundaries_inclusive(spark):
    df = _rows(spark, [("A", "R", 90.0, 180.0, 1.0, 1.0, 2.0, 1), ("A", "R", -90.0, -180.0, 1.0, 1.0, 2.0, 2),
                       ("A", "R", 90.0001, 0.0, 1.0, 1.0, 2.0, 3), ("A", "R", float("nan"), 0.0, 1.0, 1.0, 2.0, 4),
                       (None, "R", 1.0, 1.0, 1.0, 1.0, 2.0, 5), ("A", "R", None, 1.0, 1.0, 1.0, 2.0, 6)])
    assert sorted(r.seq for r in so.validate(df).collect()) == [1, 2]


def test_dedup_batch_keeps_one_per_key(spark):
    df = _rows(spark, [("A", "R", 1.0, 1.0, 1.0, 1.0, 2.0, 1)] * 3 + [("A", "R", 1.0, 1.0, 1.0, 1.0, 2.0, 2)])
    assert so.dedup(df).count() == 2


def test_dist_to_route_zero_on_waypoints_and_null_for_unknown(spark):
    wp = network.waypoints(spark)
    arrays = network.route_segment_arrays(network.segments(wp))
    pts = wp.select("route_id", "lat", "lon").unionByName(
        spark.createDataFrame([("R-UNKNOWN", 1.3, 103.8)], "route_id string, lat double, lon double"))
    out = so.dist_to_route(pts, arrays).collect()
    known = [r.dist_to_route_km for r in out if r.route_id != "R-UNKNOWN"]
    assert len(known) == 19 and all(d == 0.0 for d in known)
    assert [r.dist_to_route_km for r in out if r.route_id == "R-UNKNOWN"] == [None]


def test_facility_radius_inclusive_and_ties(spark):
    fac = network.facilities(spark)
    # 0.8 km due north of "Woodlands" is inside (<=), 0.81 km is outside.
    lat0, lon0 = 1.4360, 103.7860
    dlat = 0.8 / 6371.0088 * 180 / 3.141592653589793
    pts = spark.createDataFrame([(lat0, lon0), (lat0 + dlat * 0.999999, lon0), (lat0 + dlat * 1.0125, lon0)],
                                "lat double, lon double")
    got = [r.at_facility for r in so.nearest_facility(pts, fac).collect()]
    assert got == ["Woodlands", "Woodlands", None]


def test_grid_lookup_matches_array_lookup(spark, lake001):
    from waymark.config import Settings
    pings = lake001.deduped.select("event_id", "lat", "lon")
    fac = network.facilities(spark)
    a = so.nearest_facility(pings, fac).select("event_id", F.col("at_facility").alias("a"))
    g = so.nearest_facility_grid(pings, fac).select("event_id", F.col("at_facility").alias("g"))
    j = a.join(g, "event_id")
    assert j.count() == pings.count()
    assert j.where(~F.col("a").eqNullSafe(F.col("g"))).count() == 0


def test_dedup_keeps_the_first_arrival_under_any_partitioning(spark):
    rows = [("A", 1, off, float(off)) for off in (5, 1, 3)] + [("A", None, 7, 1.0), ("A", None, 8, 2.0), (None, 1, 9, 3.0)]
    df = spark.createDataFrame(rows, "shipment_id string, seq bigint, kafka_offset bigint, speed_kmh double")
    for n in (1, 4):
        got = sorted(r.kafka_offset for r in so.dedup(df.repartition(n)).collect())
        assert got == [1, 7, 8, 9]                     # rows without a key are all kept


def test_silver_golden_counts(lake001, lake01):
    events = lake001.spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert lake001.pings.where("copy = 0").count() == events == 1000
    assert lake01.pings.count() == 10209
    assert lake01.valid.count() == 9874
    assert lake01.silver.count() == 9665


def test_envelope_roundtrip_and_malformed(spark, lake001):
    env = lake001.envelopes
    dec = envelope.decode_envelope(env, with_ingest_time=False)
    assert dec.count() == lake001.pings.count()
    assert dec.where("event_time IS NULL").count() == 0
    bad = spark.createDataFrame([("K", "{not json", 0, 1, None), ("K", '{"shipment_id":"S","event_time":"nope"}', 0, 2, None),
                                 ("K", None, 0, 3, None)], envelope.ENVELOPE_SCHEMA)
    rows = envelope.decode_envelope(bad, with_ingest_time=False).orderBy("kafka_offset").collect()
    assert rows[0].shipment_id is None and rows[0].event_time is None
    assert rows[1].shipment_id == "S" and rows[1].event_time is None
    assert rows[2].shipment_id is None
    # same key -> same partition
    parts = env.groupBy("key").agg(F.countDistinct("partition").alias("n")).where("n > 1")
    assert parts.count() == 0


def test_grid_lookup_wraps_the_antimeridian(spark):
    fac = spark.createDataFrame([(0, "East", 10.0, 179.999), (1, "West", -20.0, -179.9995)],
                                "ord bigint, name string, lat double, lon double")
    pts = spark.createDataFrame([(1, 10.0, -179.999), (2, 10.0, 179.99), (3, -20.0, 179.9995),
                                 (4, 10.0, 0.0)], "id int, lat double, lon double")
    got = {r.id: r.at_facility for r in so.nearest_facility_grid(pts, fac).collect()}
    assert got == {1: "East", 2: None, 3: "West", 4: None}
    arr = {r.id: r.at_facility for r in so.nearest_facility(pts, fac).collect()}
    assert arr == got


def test_indexed_route_distance_equals_full_scan(spark, lake01):
    """The segment cell index is exact: small cells need the finest grid (on-route pings)
    and the coarser ones (detours, far pings)."""
    from waymark.config import Settings
    pings = lake01.pings.select("event_id", "copy", "route_id", "lat", "lon")
    arrays = lake01.route_arrays
    full = so._dist_to_route_join(pings, arrays, Settings(), "d").select("event_id", "copy", "d")
    for cell in (0.25, 5.0):
        idx = so.dist_to_route_indexed(pings, arrays, Settings(segment_cell_km=cell), "i")
        j = full.join(idx.select("event_id", "copy", "i"), ["event_id", "copy"])
        assert j.count() == pings.count()
        assert j.where(~F.col("d").eqNullSafe(F.col("i"))).count() == 0
    # coarser grids really are asked with 0.25 km cells
    assert full.where("d > 0.25").count() > 0
    # dispatch: a network over the index threshold takes the indexed path
    via = so.dist_to_route(pings, arrays, Settings(unroll_max_segments=0, segment_index_min=1), "v")
    assert "_cand" not in via.columns
    j = full.join(via.select("event_id", "copy", "v"), ["event_id", "copy"])
    assert j.where(~F.col("d").eqNullSafe(F.col("v"))).count() == 0


def test_require_event_time_option(spark):
    from datetime import datetime
    df = spark.createDataFrame([("A", 1.0, 1.0, datetime(2024, 1, 1)), ("B", 1.0, 1.0, None)],
                               "shipment_id string, lat double, lon double, event_time timestamp")
    assert so.validate(df).count() == 2
    assert so.validate(df, require_event_time=True).count() == 1


def test_a_message_is_parsed_once(spark):
    env = spark.createDataFrame([("S", '{"shipment_id":"S","lat":"x","lon":2.5,"seq":7,"event_time":"2024-01-01T00:00:00+00:00"}', 0, 1, None),
                                 ("T", '[{"shipment_id":"T","seq":8}]', 0, 2, None), ("U", "", 0, 3, None),
                                 ("V", '{"shipment_id":"V","lat":1.5,', 0, 4, None)], envelope.ENVELOPE_SCHEMA)
    dec = envelope.decode_envelope(env)
    plan = dec._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    rows = [(r.shipment_id, r.lat, r.lon, r.seq) for r in dec.orderBy("kafka_offset").collect()]
    # a field of another type is NULL, the other fields stay; an array or text cut short gives NULLs
    assert rows == [("S", None, 2.5, 7)] + [(None, None, None, None)] * 3


def test_enrichment_is_short_enough_to_be_compiled(spark, lake001):
    """The JVM compiles no method of more than 8,000 bytes; it interprets it."""
    import re
    path = so.scratch_path(spark, "bronze")
    envelope.decode_envelope(lake001.envelopes).limit(100).write.parquet(path)
    rows = so.enrich(spark.read.parquet(path), lake001.route_arrays, lake001.facilities)
    code = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_unrolled_route_distance_equals_the_join(spark):
    """Routes of one, two and three segments, some without length, an unknown and a missing route."""
    from waymark.config import Settings
    segs = spark.createDataFrame([("A", [(0.0, 0.0, 3.0, 4.0)]), ("B", [(1.0, 1.0, 1.0, 1.0), (1.0, 1.0, -5.0, 2.0)]),
                                  ("C", [(11000.0, 150.0, 11010.0, 150.0), (11010.0, 150.0, 11010.0, 150.0),
                                         (11010.0, 150.0, 11000.0, 140.0)]), ("D", [])],
                                 "route_id string, segs array<struct<ax double, ay double, bx double, by double>>")
    nan = float("nan")
    at = [(0.0, 0.0), (1.3, 103.8), (-2.0, 98.9), (1.2, nan), (None, 1.0), (0.01, 0.02)]
    pts = spark.createDataFrame([(r, *p) for r in ("A", "B", "C", "D", "E", None) for p in at], "route_id string, lat double, lon double")
    key = ("route_id", "lat", "lon")
    def rows(df):
        return sorted((tuple(str(r[c]) for c in (*key, "d")) for r in df.collect()))
    assert rows(so.dist_to_route(pts, segs, Settings(), "d")) == rows(so._dist_to_route_join(pts, segs, Settings(), "d"))
    for one in ("A", "D"):
        few = segs.where(F.col("route_id") == one)
        assert rows(so.dist_to_route(pts, few, Settings(), "d")) == rows(so._dist_to_route_join(pts, few, Settings(), "d"))
