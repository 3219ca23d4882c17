"""Property checks: haversine symmetry / triangle inequality,
point-segment distance bounds, Silver key uniqueness, status = off + at."""
import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from waymark.functions import geo

lat = st.floats(min_value=-80, max_value=80, allow_nan=False)
lon = st.floats(min_value=-179, max_value=179, allow_nan=False)
point = st.tuples(lat, lon)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(point, point, point), min_size=1, max_size=40))
def test_haversine_metric_properties(spark, triples):
    rows = [(a[0], a[1], b[0], b[1], c[0], c[1]) for a, b, c in triples]
    df = spark.createDataFrame(rows, "a1 double, a2 double, b1 double, b2 double, c1 double, c2 double")
    r = df.select(geo.haversine_km("a1", "a2", "b1", "b2").alias("ab"),
                  geo.haversine_km("b1", "b2", "a1", "a2").alias("ba"),
                  geo.haversine_km("b1", "b2", "c1", "c2").alias("bc"),
                  geo.haversine_km("a1", "a2", "c1", "c2").alias("ac")).collect()
    for x in r:
        assert x.ab >= 0 and abs(x.ab - x.ba) < 1e-9
        assert x.ac <= x.ab + x.bc + 1e-6
        assert x.ab <= math.pi * 6371.0088 + 1e-6


coord = st.floats(min_value=-50, max_value=50, allow_nan=False)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(coord, coord, coord, coord, coord, coord), min_size=1, max_size=40))
def test_point_segment_bounds(spark, rows):
    df = spark.createDataFrame(rows, "px double, py double, ax double, ay double, bx double, by double")
    r = df.select(geo.point_segment_km("px", "py", "ax", "ay", "bx", "by").alias("d"),
                  F.sqrt(F.pow(F.col("px") - F.col("ax"), 2) + F.pow(F.col("py") - F.col("ay"), 2)).alias("da"),
                  F.sqrt(F.pow(F.col("px") - F.col("bx"), 2) + F.pow(F.col("py") - F.col("by"), 2)).alias("db")
                  ).collect()
    for x in r:
        assert x.d >= 0
        assert x.d <= min(x.da, x.db) + 1e-9


def test_silver_key_unique_and_status_is_off_plus_at(lake01):
    s = lake01.silver
    assert s.groupBy("shipment_id", "seq").count().where("count > 1").count() == 0
    assert s.where("dist_to_route_km < 0").count() == 0
    off = s.where("dist_to_route_km > 1.5").count()
    at = s.where("at_facility IS NOT NULL").count()
    assert lake01.status_events.count() == off + at
