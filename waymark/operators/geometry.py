"""Per-ping geometry against the route network: linear referencing, distance
and bearing to the route ends, lateral offsets and route coverage.

The route side is a small dimension attached by a size-checked broadcast
hash join on ``route_id``; the per-ping work is array / scalar expressions,
so the ping side is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.config import DEFAULT, Settings
from waymark.functions import geo
from waymark.sources import network


def route_lines(segments: DataFrame) -> DataFrame:
    """route_id -> ordered segment array (cum, len, endpoints, bearing) + route_km."""
    return segments.groupBy("route_id").agg(
        F.sort_array(F.collect_list(F.struct(
            "seq", F.col("cum_km").alias("cum"), F.col("len_km").alias("len"), "lat", "lon",
            "lat2", "lon2", "bearing", "is_last"))).alias("_line"),
        F.max("total_km").alias("_route_km"))


def expected_position(df: DataFrame, segments: DataFrame, settings: Settings = DEFAULT,
                      dist_col: str = "dist_km") -> DataFrame:
    """Where a ping should be after ``dist_col`` km along its route.

    Finds the segment with cum <= d < cum + len (the last segment also takes
    d = route length), interpolates lat/lon, and reports the segment bearing.
    d is clamped to [0, route length].  Unknown routes give NULLs; on a segment of
    length zero (a repeated waypoint) the position is its start.
    """
    lines = network.maybe_broadcast(route_lines(segments), settings)
    j = df.join(lines, "route_id", "left")
    d = F.least(F.greatest(F.col(dist_col), F.lit(0.0)), F.col("_route_km"))
    seg = F.element_at(F.filter(F.col("_line"), lambda s: (d >= s["cum"]) & (
        (d < s["cum"] + s["len"]) | s["is_last"])), 1)
    t = F.coalesce(F.try_divide(d - seg["cum"], seg["len"]), F.when(seg.isNotNull(), F.lit(0.0)))
    return j.select(*df.columns,
                    F.round(seg["lat"] + (seg["lat2"] - seg["lat"]) * t, 6).alias("exp_lat"),
                    F.round(seg["lon"] + (seg["lon2"] - seg["lon"]) * t, 6).alias("exp_lon"),
                    F.round(seg["bearing"], 1).alias("seg_bearing"))


def route_ends(waypoints: DataFrame) -> DataFrame:
    """route_id -> origin and destination coordinates."""
    return waypoints.groupBy("route_id").agg(
        F.min_by("lat", "seq").alias("o_lat"), F.min_by("lon", "seq").alias("o_lon"),
        F.max_by("lat", "seq").alias("d_lat"), F.max_by("lon", "seq").alias("d_lon"))


def distance_to_ends(df: DataFrame, waypoints: DataFrame,
                     settings: Settings = DEFAULT) -> DataFrame:
    """Great-circle km from the route origin and to the route destination."""
    ends = network.maybe_broadcast(route_ends(waypoints), settings)
    j = df.join(ends, "route_id", "left")
    return j.select(
        *df.columns,
        F.round(geo.haversine_km("o_lat", "o_lon", "lat", "lon", settings), 6).alias("km_from_origin"),
        F.round(geo.haversine_km("lat", "lon", "d_lat", "d_lon", settings), 6).alias("km_to_destination"))


def bearing_to_destination(df: DataFrame, waypoints: DataFrame,
                           settings: Settings = DEFAULT) -> DataFrame:
    ends = network.maybe_broadcast(route_ends(waypoints), settings)
    j = df.join(ends, "route_id", "left")
    return j.select(*df.columns,
                    F.round(geo.bearing_deg("lat", "lon", "d_lat", "d_lon"), 1)
                    .alias("bearing_to_destination"))


def lateral_offset(df: DataFrame, km: float = 2.0, heading_col: str = "heading") -> DataFrame:
    """The point ``km`` to the right of the heading (a detour position)."""
    perp = F.radians(F.col(heading_col) + F.lit(90.0))
    dx = F.lit(km) * F.sin(perp)
    dy = F.lit(km) * F.cos(perp)
    return df.select(*df.columns,
                     F.round(geo.offset_lat("lat", dy), 6).alias("off_lat"),
                     F.round(geo.offset_lon("lat", "lon", dx), 6).alias("off_lon"))


def route_coverage(silver: DataFrame, waypoints: DataFrame,
                   settings: Settings = DEFAULT) -> DataFrame:
    """Per route seen in the pings: waypoint count, route length (cumulative
    great-circle km over the waypoints), ping count and furthest progress."""
    lengths = (network.route_lengths(waypoints, settings).groupBy("route_id")
               .agg(F.count(F.lit(1)).alias("n_waypoints"),
                    F.max("route_km").alias("route_km")))
    per_route = silver.groupBy("route_id").agg(F.count(F.lit(1)).alias("pings"),
                                               F.max("dist_km").alias("max_dist_km"))
    j = per_route.join(network.maybe_broadcast(lengths, settings), "route_id", "left")
    return j.select("route_id", F.coalesce("n_waypoints", F.lit(0)).cast("bigint").alias("n_waypoints"),
                    F.round("route_km", 4).alias("route_km"),
                    "pings", "max_dist_km",
                    F.round(F.try_divide("max_dist_km", "route_km") * F.lit(100.0), 1)
                    .alias("coverage_pct"))
