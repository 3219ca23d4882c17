"""Table summaries, per-group counts and top-k samples of the lake tables.

Counts are global or low-cardinality aggregates (partial aggregation before
a tiny shuffle); samples are ``orderBy(...).limit(k)``, which Spark plans as a
per-partition top-k (TakeOrderedAndProject) instead of a full sort.  Every
sample has a total order so the k rows are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bronze_summary(bronze: DataFrame) -> DataFrame:
    """Counts, distinct ids and times.  Rows are combined by (shipment, route) first, so the two
    distinct counts work on that many rows, each by its own key, and no row is expanded."""
    seen = bronze.groupBy("shipment_id", "route_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_time").alias("lo"), F.max("event_time").alias("hi"))
    ships = seen.groupBy("shipment_id").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    routes = seen.where("route_id IS NOT NULL").groupBy("route_id").count().agg(F.count(F.lit(1)).alias("routes"))
    return ships.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_pings"), F.count("shipment_id").alias("shipments"),
                     F.min("lo").alias("earliest_event"), F.max("hi").alias("latest_event")).select(
        "total_pings", "shipments", routes.scalar().alias("routes"), "earliest_event", "latest_event")


def pings_per_route(bronze: DataFrame) -> DataFrame:
    return (bronze.groupBy("route_id").agg(F.count(F.lit(1)).alias("pings"))
                  .orderBy(F.col("route_id").asc_nulls_first()))


def silver_summary(silver: DataFrame) -> DataFrame:
    return silver.agg(F.count(F.lit(1)).alias("rows"),
                      F.countDistinct("shipment_id").alias("shipments"))


def events_by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def bronze_sample(bronze: DataFrame, n: int = 10) -> DataFrame:
    """Earliest ingested rows (ties broken by partition and offset)."""
    order = [c for c in ("ingest_time", "kafka_partition", "kafka_offset") if c in bronze.columns]
    return (bronze.orderBy(*order).limit(n)
                  .select("shipment_id", "route_id", "lat", "lon", "speed_kmh", "seq",
                          "event_time", "kafka_partition", "kafka_offset"))


def silver_sample(silver: DataFrame, n: int = 10) -> DataFrame:
    return (silver.orderBy(F.col("event_time").desc(), "shipment_id", "seq").limit(n)
                  .select("shipment_id", "route_id", "progress_pct", "is_moving",
                          "dist_to_route_km", "at_facility", "event_time"))


def status_sample(status: DataFrame, n: int = 10) -> DataFrame:
    return (status.orderBy(F.col("event_time").desc(), "shipment_id", "event_type").limit(n)
                  .select("shipment_id", "event_type", "detail", "lat", "lon", "event_time"))


def exceptions_sample(exceptions: DataFrame, n: int = 10) -> DataFrame:
    return (exceptions.orderBy(F.col("window_start").desc(), "shipment_id").limit(n)
                      .select("shipment_id", "event_type", "window_start", "window_end",
                              "moved_km", "max_speed", "at_facility"))


def bronze_quality(bronze: DataFrame) -> DataFrame:
    """Data-quality counts of the Bronze table in one aggregation: rows whose
    JSON did not parse (every ping field NULL), missing id / coordinates /
    event time, coordinates out of range, and rows Silver validation keeps."""
    fields = ["shipment_id", "vehicle_id", "route_id", "lat", "lon", "speed_kmh", "dist_km",
              "total_km", "seq"]
    unparsed = F.lit(True)
    for c in fields:
        unparsed = unparsed & F.col(c).isNull()
    in_range = F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)
    valid = F.col("shipment_id").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull() & in_range
    return bronze.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(unparsed).alias("unparseable"),
        F.count_if(F.col("shipment_id").isNull()).alias("missing_id"),
        F.count_if(F.col("lat").isNull() | F.col("lon").isNull()).alias("missing_coords"),
        F.count_if(~in_range).alias("out_of_range"),
        F.count_if(F.col("event_time").isNull()).alias("missing_event_time"),
        F.count_if(valid).alias("valid"))
