"""Current fleet state from Silver: latest ping, status, KPIs, feed and board.

All per-shipment reductions are ``max_by`` aggregates: Spark combines them
map-side before the shuffle, so a shipment with a huge ping history sends
one partial row per input partition.  Their buffers hold strings and structs, so
Spark sorts each task's rows by shipment instead of hashing them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.config import DEFAULT, Settings
from waymark.functions import telemetry

STATE_COLUMNS = ["route_id", "lat", "lon", "speed_kmh", "progress_pct", "dist_to_route_km",
                 "at_facility", "dist_km", "total_km", "event_time"]


def _order():
    return F.struct("event_time", "seq")


def latest_state(silver: DataFrame, cols=STATE_COLUMNS) -> DataFrame:
    """The latest ping (by event_time, then seq) of every shipment."""
    cols = [c for c in cols if c != "shipment_id"]
    last = F.max_by(F.struct(*cols), _order()).alias("_last")
    return silver.groupBy("shipment_id").agg(last).select("shipment_id", "_last.*")


def latest_nonnull(silver: DataFrame, cols=STATE_COLUMNS) -> DataFrame:
    """Per shipment and column, the latest non-NULL value.

    This is what a column-wise "last" over a time-sorted frame returns: a
    facility name stays visible after the shipment left the geofence
    (``at_facility`` is sticky).
    """
    cols = [c for c in cols if c != "shipment_id"]
    aggs = [F.expr(f"max_by({c}, struct(event_time, seq)) FILTER (WHERE {c} IS NOT NULL)")
            .alias(c) for c in cols]
    return silver.groupBy("shipment_id").agg(*aggs)


def with_status(state: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Adds status, map colour and dist_remaining_km (2 dp)."""
    return (state.withColumn("status", telemetry.shipment_status(settings=settings))
                 .withColumn("color", telemetry.status_color("status"))
                 .withColumn("dist_remaining_km",
                             F.round(telemetry.dist_remaining_km(), 2)))


def board(status: DataFrame, settings: Settings = DEFAULT, eta: DataFrame | None = None) -> DataFrame:
    """Shipment board: ETA per shipment, ordered by ETA ascending, NULLs last.

    Without a model column the ETA is the distance/speed fallback with the
    current speed standing in for the trailing average.
    """
    if eta is None:
        b = status.withColumn("eta_min", telemetry.fallback_eta_min(
            "dist_remaining_km", "speed_kmh", settings))
    else:
        b = status.join(eta, "shipment_id", "left")
    return (b.select("shipment_id", "route_id", "status", "progress_pct", "dist_remaining_km",
                     "speed_kmh", "eta_min")
             .orderBy(F.col("eta_min").asc_nulls_last(), F.col("shipment_id")))


def kpis(board_df: DataFrame) -> DataFrame:
    """Active shipments, OFF_ROUTE and STOPPED counts, mean ETA (1 dp; NULL when
    no shipment has an ETA)."""
    return board_df.agg(
        F.count(F.lit(1)).alias("active_shipments"),
        F.count_if(F.col("status") == "OFF_ROUTE").alias("off_route"),
        F.count_if(F.col("status") == "STOPPED").alias("stopped"),
        F.round(F.avg("eta_min"), 1).alias("avg_eta_min"))


def exception_feed(status_events: DataFrame | None, exceptions: DataFrame | None,
                   limit: int | None = None, settings: Settings = DEFAULT) -> DataFrame | None:
    """Latest status events and windowed exceptions, newest first (top-k).

    Either input may be missing (``None``); with neither, returns None and the
    caller shows an empty feed.
    """
    limit = limit or settings.feed_limit
    parts = []
    if status_events is not None:
        parts.append(status_events.select("shipment_id", "event_type",
                                          F.col("detail").alias("info"),
                                          F.col("event_time").alias("ts")))
    if exceptions is not None:
        parts.append(exceptions.select("shipment_id", "event_type",
                                       F.col("at_facility").alias("info"),
                                       F.col("window_end").alias("ts")))
    if not parts:
        return None
    feed = parts[0]
    for p in parts[1:]:
        feed = feed.unionByName(p)
    return feed.orderBy(F.col("ts").desc(), F.col("shipment_id").asc(),
                        F.col("event_type").asc(), F.col("info").asc_nulls_first()).limit(limit)
