"""Gold status events and windowed exceptions: golden counts and rules."""
from pyspark.sql import functions as F

from waymark.operators import gold


def _counts(df):
    return {r.event_type: r["count"] for r in df.groupBy("event_type").count().collect()}


def test_status_matches_sql(lake01):
    lake01.silver.createOrReplaceTempView("silver_rows")
    want = lake01.spark.sql("""
        SELECT shipment_id, route_id, lat, lon, speed_kmh, event_time, 'OFF_ROUTE' AS event_type,
               CAST(dist_to_route_km AS STRING) AS detail FROM silver_rows WHERE dist_to_route_km > 1.5
        UNION ALL SELECT shipment_id, route_id, lat, lon, speed_kmh, event_time, 'AT_FACILITY', at_facility
        FROM silver_rows WHERE at_facility IS NOT NULL""")
    got = lake01.status_events
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert _counts(got).keys() == {"OFF_ROUTE", "AT_FACILITY"}


def test_exceptions_golden(lake01):
    assert sum(_counts(lake01.exceptions).values()) == 2744
    assert set(_counts(lake01.exceptions)) == {"DWELL", "STOPPED"}
    closed = gold.closed_windows(lake01.exceptions, lake01.silver)
    assert sum(_counts(closed).values()) == 2743


def test_stop_thresholds_strict(spark):
    from datetime import datetime
    rows = [("A", "R", datetime(2024, 1, 1, 0, 0, s), float(sp), d, fac, s)
            for s, sp, d, fac in [(0, 4.9, 1.0, None), (10, 4.9, 1.0799, None),   # stopped
                                  ]]
    rows += [("B", "R", datetime(2024, 1, 1, 0, 0, s), sp, d, None, s)
             for s, sp, d in [(0, 5.0, 1.0), (10, 0.0, 1.0)]]                     # speed 5 not < 5
    rows += [("C", "R", datetime(2024, 1, 1, 0, 0, s), 0.0, d, "Z", s)
             for s, d in [(0, 1.0), (10, 1.08)]]                                  # moved 0.08 not < 0.08
    df = spark.createDataFrame(rows, "shipment_id string, route_id string, event_time timestamp, "
                                     "speed_kmh double, dist_km double, at_facility string, seq bigint")
    got = [(r.shipment_id, r.event_type) for r in gold.window_exceptions(df).collect()]
    assert got == [("A", "STOPPED")]


def test_every_event_gives_its_rows(spark):
    """One ping per event and one more per re-delivery, at the largest scale here."""
    from waymark.plans.lake import Lake
    sf = "/root/testdata/sf0.1"
    events = spark.read.parquet(f"{sf}/events.parquet")
    again = events.where("event_type = 'purchase' AND CAST(get_json_object(props, '$.k') AS INT) % 10 = 7").count()
    lk = Lake(spark, sf)
    assert lk.pings.count() == events.count() + again and again > 0
    # Of two deliveries the first stays, and no valid ping is lost.
    firsts = lk.valid.where("copy = 0").count()
    assert lk.silver.count() == firsts
    assert lk.silver.join(lk.valid.where("copy = 0"), ["event_id", "speed_kmh"]).count() == firsts
