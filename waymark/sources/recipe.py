"""One vehicle ping per event of the driver's ``events`` table.

Every column of a ping is a function of the event's own columns: the shipment is the
``user_id``, the time is ``ts`` (whole seconds), the speed is ``value``, and the
number in ``props`` moves the position a little and picks defects among ``error``
events (no position, latitude out of range, unknown route, no shipment id).  ``signup``
events are stops; some ``click`` events are detours.  A shipment runs along its route
over ``TRIP_SECONDS`` from a start that depends on the shipment, and stays at the
end.  ``purchase`` events whose number ends in 7 are delivered twice, the second time
with another speed.  Every event gives its rows; order, skew and repetition of
``events`` stay as they are.  The same recipe is written in SQL for the oracle
(``waymark.plans.oracle_recipe``); every fractional literal is a double so both
engines compute the same bits.

The job is a projection of ``events`` plus two broadcast joins against the
(fixed, size-checked) route segment table, so it scales linearly with
``events`` and never shuffles the event rows.  Downstream jobs read its
output as the written Bronze table (``waymark.plans.tables``), so their
predicates reach a parquet scan rather than these expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.config import DEFAULT, Settings
from waymark.sources import network

EPOCH0 = 1704067200          # 2024-01-01 00:00:00 UTC, the first day of events
TRIP_SECONDS = 24 * 86400    # time of a whole route
HEAD_START = 86400           # shipments start up to six of these ahead


def recipe_segments(spark: SparkSession, settings: Settings = DEFAULT,
                    seg: DataFrame | None = None) -> DataFrame:
    if seg is None:
        seg = network.segments(network.waypoints(spark), settings)
    return seg.select("route_rank", "route_id", F.col("seq").alias("i"), "lat", "lon",
                      "lat2", "lon2", "len_km", "cum_km", "total_km", "is_last", "bearing")


def pings_from_events(events: DataFrame, settings: Settings = DEFAULT,
                      segments: DataFrame | None = None) -> DataFrame:
    """``segments``: the route segment dimension (fixed, 15 rows, broadcast)."""
    spark = events.sparkSession
    seg = recipe_segments(spark, settings, segments)
    if network.bounded_rows(seg, settings.broadcast_max_rows) is None:
        raise ValueError("route network too large to broadcast")
    seg = F.broadcast(seg)
    tot = seg.select("route_rank", "route_id", "total_km").distinct()

    eid, kind, uid = F.col("event_id"), F.col("event_type"), F.coalesce("user_id", F.lit(0))
    number = F.nullif(F.regexp_extract("props", '"k": *([0-9]+)', 1), F.lit("")).try_cast("int")
    at = F.date_trunc("second", F.col("ts").cast("timestamp"))
    e0 = events.select(eid, "user_id", "event_type", F.col("value").alias("raw_speed"),
                       F.coalesce(number, F.lit(0)).alias("k"), at.alias("at"), uid.alias("s"))
    e1 = e0.join(F.broadcast(tot), F.col("route_rank") == F.col("s") % len(network.ROUTES), "left")
    gone = (F.unix_seconds("at") - EPOCH0 + F.col("s") % 7 * HEAD_START) / F.lit(float(TRIP_SECONDS))
    e2 = e1.withColumn("dist", F.col("total_km") * F.least(F.lit(1.0), gone))

    # Range lookup of the segment under `dist`: broadcast hash join on the
    # route with a range condition (at most 4 candidate segments per row).
    g = seg.select(F.col("route_rank").alias("g_rank"), F.col("lat").alias("g_lat"),
                   F.col("lon").alias("g_lon"), F.col("lat2").alias("g_lat2"),
                   F.col("lon2").alias("g_lon2"), F.col("cum_km").alias("g_cum"),
                   F.col("len_km").alias("g_len"), F.col("is_last").alias("g_last"),
                   F.col("bearing").alias("g_bearing"))
    dist = F.col("dist")
    e3 = e2.join(g, (F.col("g_rank") == F.col("route_rank")) & (dist >= F.col("g_cum"))
                 & ((dist < F.col("g_cum") + F.col("g_len")) | F.col("g_last")), "left")
    plat = F.col("g_lat") + (F.col("g_lat2") - F.col("g_lat")) * (dist - F.col("g_cum")) / F.col("g_len")
    plon = F.col("g_lon") + (F.col("g_lon2") - F.col("g_lon")) * (dist - F.col("g_cum")) / F.col("g_len")
    k, error = F.col("k"), kind == "error"
    detour_off = F.when((kind == "click") & (k >= 90), F.lit(3e-2)).otherwise(F.lit(0.0))
    noise = (k % 13 - 6) * F.lit(1e-4)

    return e3.select(
        eid, kind, "k",
        F.when(F.col("user_id").isNotNull() & ~(error & k.between(20, 21)),
               F.concat(F.lit("SHP-"), F.lpad((F.col("s") + 1).cast("string"), 5, "0")))
         .alias("shipment_id"),
        F.concat(F.lit("VEH-"), F.lpad(((F.col("s") + 1) % 12).cast("string"), 3, "0")).alias("vehicle_id"),
        F.when(error & k.between(15, 19), F.lit("R-UNKNOWN")).otherwise(F.col("route_id")).alias("route_id"),
        F.when(error & (k < 10), F.lit(None).cast("double"))
         .when(error & k.between(10, 14), F.lit(95.0))
         .otherwise(F.round(plat + detour_off + noise, 6)).alias("lat"),
        F.round(plon + detour_off, 6).alias("lon"),
        F.when(kind == "signup", F.lit(0.0)).otherwise(F.round("raw_speed", 1)).alias("speed_kmh"),
        F.round(F.col("g_bearing"), 1).alias("heading"),
        F.round(dist, 3).alias("dist_km"),
        F.round(F.col("total_km"), 3).alias("total_km"),
        (eid + 1).cast("bigint").alias("seq"),
        F.col("at").alias("event_time"),
    )


def pings(spark: SparkSession, sf_dir: str, settings: Settings = DEFAULT,
          segments: DataFrame | None = None) -> DataFrame:
    """The ping stream: every event once (``copy`` 0), some delivered again (``copy`` 1)."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet") \
        .select("event_id", "ts", "user_id", "event_type", "value", "props")
    p0 = pings_from_events(events, settings, segments)
    twice = (F.col("event_type") == "purchase") & (F.col("k") % 10 == 7)
    copies = F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    out = p0.select("*", copies.alias("copy"))
    speed = F.when(F.col("copy") == 1, F.round(F.col("speed_kmh") + 1.0, 1)).otherwise(F.col("speed_kmh"))
    return out.withColumn("speed_kmh", speed).drop("event_type", "k")


PING_COLUMNS = ["shipment_id", "vehicle_id", "route_id", "lat", "lon", "speed_kmh",
                "heading", "dist_km", "total_km", "seq", "event_time"]


#: Batches of the late-arrival replay, days of event time in each, and its watermark.
ARRIVALS, ARRIVAL_DAYS, LATE_WATERMARK = 4, 8, "1 day"


def arrival_batch():
    """The batch that a delivery arrives in: its own days', one later for a tenth of the events,
    two later for a hundredth, and one more for half of the re-deliveries."""
    eid = F.col("event_id")
    own = F.floor((F.unix_seconds("event_time") - EPOCH0) / F.lit(ARRIVAL_DAYS * 86400)).cast("int")
    late = F.when(eid % 100 == 7, 2).when(eid % 10 == 3, 1).otherwise(0)
    again = F.when((F.col("copy") == 1) & (eid % 2 == 0), 1).otherwise(0)
    return F.least(F.lit(ARRIVALS - 1), F.greatest(F.lit(0), F.coalesce(own, F.lit(0))) + late + again)
