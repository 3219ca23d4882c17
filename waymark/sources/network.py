"""Route network and facilities as dimension DataFrames.

The dimensions are small, so the Silver enrichment attaches them without a
shuffle: route segments through a broadcast hash join on ``route_id`` and the
facility list as a literal array.  Both paths check the dimension size first
and fall back to shuffle / grid joins when it outgrows the bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.config import DEFAULT, Settings
from waymark.functions import geo

# Planned routes as ordered (lat, lon) waypoints.
ROUTES = {
    "R-PORT-TUAS": [(1.2644, 103.8400), (1.2800, 103.8000), (1.3000, 103.7400),
                    (1.3200, 103.6800), (1.3300, 103.6300)],
    "R-SIN-JHB": [(1.2830, 103.8510), (1.3340, 103.8470), (1.3900, 103.8400),
                  (1.4310, 103.7690), (1.4640, 103.7660)],
    "R-CHANGI-JURONG": [(1.3560, 103.9880), (1.3500, 103.9300), (1.3380, 103.8500),
                        (1.3300, 103.7600), (1.3290, 103.7180)],
    "R-WOODLANDS-SELETAR": [(1.4360, 103.7860), (1.4200, 103.8200), (1.4100, 103.8500),
                            (1.4050, 103.8680)],
}

# Facilities (geofence centres), in lookup order.
FACILITIES = [
    ("PSA Port", 1.2644, 103.8400),
    ("Tuas Megaport", 1.3300, 103.6300),
    ("Singapore CBD", 1.2830, 103.8510),
    ("JB Sentral", 1.4640, 103.7660),
    ("Changi Air Cargo", 1.3560, 103.9880),
    ("Jurong Industrial", 1.3290, 103.7180),
    ("Woodlands", 1.4360, 103.7860),
    ("Seletar Aerospace", 1.4050, 103.8680),
]

WAYPOINT_SCHEMA = T.StructType([
    T.StructField("route_rank", T.LongType(), False),
    T.StructField("route_id", T.StringType(), False),
    T.StructField("seq", T.LongType(), False),
    T.StructField("lat", T.DoubleType(), False),
    T.StructField("lon", T.DoubleType(), False),
])

FACILITY_SCHEMA = T.StructType([
    T.StructField("ord", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("lat", T.DoubleType(), False),
    T.StructField("lon", T.DoubleType(), False),
])


def _values(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A small constant table as a JVM-side VALUES relation (LocalRelation):
    no Python worker is involved when it is scanned, and the optimizer knows
    its exact size."""
    def lit(v, t):
        if isinstance(t, T.StringType):
            return "'" + str(v).replace("'", "''") + "'"
        if isinstance(t, T.DoubleType):
            return f"{float(v)!r}D"
        return f"{int(v)}L"
    body = ", ".join("(" + ", ".join(lit(v, f.dataType) for v, f in zip(r, schema.fields)) + ")"
                     for r in rows)
    names = ", ".join(f.name for f in schema.fields)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")


def waypoints(spark: SparkSession) -> DataFrame:
    rows = [(rk, rid, i, lat, lon)
            for rk, (rid, pts) in enumerate(ROUTES.items())
            for i, (lat, lon) in enumerate(pts)]
    return _values(spark, rows, WAYPOINT_SCHEMA)


def facilities(spark: SparkSession) -> DataFrame:
    rows = [(i, n, lat, lon) for i, (n, lat, lon) in enumerate(FACILITIES)]
    return _values(spark, rows, FACILITY_SCHEMA)


def segments(wp: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row per route segment (waypoint i -> i+1) with length, cumulative
    start distance, route total, bearing and projected end points."""
    by_route = Window.partitionBy("route_id").orderBy("seq")
    running = by_route.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seg = (wp.withColumn("lat2", F.lead("lat").over(by_route))
             .withColumn("lon2", F.lead("lon").over(by_route))
             .where(F.col("lat2").isNotNull())
             .withColumn("len_km", geo.haversine_km("lat", "lon", "lat2", "lon2", settings)))
    seg = (seg.withColumn("run_km", F.sum("len_km").over(running))
              .withColumn("cum_km", F.col("run_km") - F.col("len_km"))
              .withColumn("total_km", F.max("run_km").over(Window.partitionBy("route_id")))
              .withColumn("is_last", F.row_number().over(
                  Window.partitionBy("route_id").orderBy(F.desc("seq"))) == 1)
              .withColumn("bearing", geo.bearing_deg("lat", "lon", "lat2", "lon2"))
              .withColumn("ax", geo.project_x("lon", settings))
              .withColumn("ay", geo.project_y("lat", settings))
              .withColumn("bx", geo.project_x("lon2", settings))
              .withColumn("by", geo.project_y("lat2", settings)))
    return seg


def route_lengths(wp: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Cumulative km at every waypoint (first = 0) and the route total."""
    by_route = Window.partitionBy("route_id").orderBy("seq")
    prev_lat, prev_lon = F.lag("lat").over(by_route), F.lag("lon").over(by_route)
    step = F.coalesce(geo.haversine_km(prev_lat, prev_lon, "lat", "lon", settings), F.lit(0.0))
    out = wp.withColumn("step_km", step).withColumn(
        "cum_km", F.sum("step_km").over(
            by_route.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return out.withColumn("route_km", F.max("cum_km").over(Window.partitionBy("route_id")))


def route_segment_arrays(seg: DataFrame) -> DataFrame:
    """route_id -> array<struct<ax,ay,bx,by>>: one small row per route."""
    return seg.groupBy("route_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("seq", "ax", "ay", "bx", "by"))),
                    lambda s: F.struct(s["ax"].alias("ax"), s["ay"].alias("ay"),
                                       s["bx"].alias("bx"), s["by"].alias("by")))
        .alias("segs"))


def cached_dimension(df: DataFrame) -> DataFrame:
    """Keep a small derived dimension in executor memory.

    The route geometry is recomputed from the waypoint table by several
    windows; every plan that joins it would otherwise re-run those stages.
    A lost cache block is recomputed from lineage, so this is safe on a
    cluster; the size is bounded by the (checked) dimension size.
    """
    return df.persist()


def bounded_rows(df: DataFrame, max_rows: int) -> int | None:
    """Row count of a dimension if it is at most ``max_rows``, else None.

    Reads at most max_rows + 1 rows, so the check itself is bounded.
    """
    n = df.limit(max_rows + 1).count()
    return n if n <= max_rows else None


def collect_bounded(df: DataFrame, max_rows: int, order_by=None) -> list | None:
    """The rows of a small dimension, or None when it has more than
    ``max_rows`` rows.  One job that reads at most max_rows + 1 rows."""
    if order_by is not None:
        df = df.orderBy(order_by)
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def row_bytes(df: DataFrame):
    """About the bytes of a row: those of its JSON text, which holds arrays whole."""
    return F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))


def maybe_broadcast(dim: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Broadcast hint only behind a checked size bound, in rows and in bytes (a row can hold a
    polyline or a dense cell); otherwise leave the join to Catalyst/AQE (sort-merge with
    skew splitting).  The check reads at most one row more than the bound."""
    n, size = dim.limit(settings.broadcast_max_rows + 1).select(row_bytes(dim).alias("b")) \
        .agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    if n <= settings.broadcast_max_rows and size <= settings.broadcast_max_bytes:
        return F.broadcast(dim)
    return dim
