"""Scalar geometry: golden route lengths, symmetry, boundary behaviour."""
import math

import pytest
from pyspark.sql import functions as F

from waymark.functions import geo, telemetry
from waymark.sources import network

# Golden cumulative km per waypoint (own calculation from the coordinates).
GOLDEN = {
    "R-PORT-TUAS": [0, 4.7731, 11.8041, 18.8350, 24.5034],
    "R-SIN-JHB": [0, 5.6884, 11.9637, 21.0783, 24.7628],
    "R-CHANGI-JURONG": [0, 6.4819, 15.4746, 25.5190, 30.1892],
    "R-WOODLANDS-SELETAR": [0, 4.1773, 7.6926, 9.7693],
}


def test_route_lengths_golden(spark):
    rl = network.route_lengths(network.waypoints(spark)).orderBy("route_id", "seq").collect()
    got = {}
    for r in rl:
        got.setdefault(r["route_id"], []).append(round(r["cum_km"], 4))
    assert got == {k: [float(x) for x in v] for k, v in GOLDEN.items()}


def test_haversine_symmetric_and_zero(spark):
    df = spark.createDataFrame([(1.30, 103.80, 1.45, 103.70)], "a double, b double, c double, d double")
    r = df.select(geo.haversine_km("a", "b", "c", "d").alias("x"),
                  geo.haversine_km("c", "d", "a", "b").alias("y"),
                  geo.haversine_km("a", "b", "a", "b").alias("z")).first()
    assert r.x == pytest.approx(r.y, abs=1e-12)
    assert r.z == 0.0
    # python reference formula
    la1, lo1, la2, lo2 = map(math.radians, (1.30, 103.80, 1.45, 103.70))
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    assert r.x == pytest.approx(2 * 6371.0088 * math.asin(math.sqrt(h)), rel=1e-12)


def test_point_segment_clamps_and_degenerate(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0, 3.0, 1.0), (5.0, 5.0, 1.0, 1.0, 1.0, 1.0),
                                (2.0, 3.0, 1.0, 1.0, 3.0, 1.0)],
                               "px double, py double, ax double, ay double, bx double, by double")
    got = [r.d for r in df.select(geo.point_segment_km("px", "py", "ax", "ay", "bx", "by").alias("d")).collect()]
    assert got[0] == pytest.approx(math.sqrt(2))   # clamped to a
    assert got[1] == pytest.approx(math.sqrt(32))  # zero-length segment
    assert got[2] == pytest.approx(2.0)            # perpendicular foot inside


def test_bearing_quadrants(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 1.0), (0.0, 0.0, -1.0, 0.0),
                                (0.0, 0.0, 0.0, -1.0)], "a double, b double, c double, d double")
    got = [round(r.x, 6) for r in df.select(geo.bearing_deg("a", "b", "c", "d").alias("x")).collect()]
    assert got == [0.0, 90.0, 180.0, 270.0]


def test_fallback_eta_and_status_rules(spark):
    df = spark.createDataFrame(
        [(10.0, 60.0, 1.6, None, 50.0), (10.0, 5.0, 1.5, "Woodlands", 2.0),
         (10.0, None, None, None, 2.9), (0.0, 30.0, 0.2, "", 3.0)],
        "d double, avg double, off double, fac string, sp double")
    r = df.select(telemetry.fallback_eta_min("d", "avg").alias("eta"),
                  telemetry.shipment_status("off", "fac", "sp").alias("st")).collect()
    assert [x.eta for x in r] == [10.0, 24.0, 24.0, 0.0]
    assert [x.st for x in r] == ["OFF_ROUTE", "AT_FACILITY", "STOPPED", "IN_TRANSIT"]


def test_dist_remaining_and_progress(spark):
    df = spark.createDataFrame([(5.0, 10.0), (12.0, 10.0), (None, 10.0), (3.0, 0.0), (3.0, None)],
                               "dist_km double, total_km double")
    r = df.select(telemetry.dist_remaining_km().alias("rem"), telemetry.progress_pct().alias("p")).collect()
    assert [x.rem for x in r] == [5.0, 0.0, None, 0.0, None]
    assert [x.p for x in r] == [50.0, 120.0, None, 0.0, 0.0]


def test_expected_position_on_a_repeated_last_waypoint(spark):
    from waymark.operators import geometry
    from waymark.sources import network
    wp = spark.createDataFrame([(0, "R", 0, 1.0, 103.0), (0, "R", 1, 1.1, 103.0), (0, "R", 2, 1.1, 103.0)],
                               "route_rank int, route_id string, seq int, lat double, lon double")
    seg = network.segments(wp)
    rows = spark.createDataFrame([("R", 0.0), ("R", 500.0), ("X", 1.0)], "route_id string, dist_km double")
    got = {(r.route_id, r.dist_km): (r.exp_lat, r.exp_lon) for r in geometry.expected_position(rows, seg).collect()}
    assert got == {("R", 0.0): (1.0, 103.0), ("R", 500.0): (1.1, 103.0), ("X", 1.0): (None, None)}
