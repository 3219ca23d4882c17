"""Silver: validate, de-duplicate and enrich pings.

Each function is ``DataFrame -> DataFrame`` and works unchanged on a batch or
a streaming DataFrame (only the de-duplication branches on ``isStreaming``).

Scale notes
-----------
* Validation and enrichment are narrow (no shuffle).  A small (size-checked)
  route network and facility list are compiled into codegen'd expressions
  (``CASE route_id ... least(...)``; ``least(struct(d, ord, name) ...)``), no
  join at all.  Larger networks attach the geometry with a size-checked
  broadcast hash join on ``route_id`` and ``array_min(transform(...))``;
  facility sets above 256 use a grid-cell equi-join.
* De-duplication shuffles on ``(shipment_id, seq)``, so even a shipment that
  holds a third of all pings spreads over every reducer.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.config import DEFAULT, Settings
from waymark.functions import geo, telemetry
from waymark.session import scratch_path
from waymark.sources import network

DEDUP_KEYS = ("shipment_id", "seq")


def validate(df: DataFrame, require_event_time: bool = False) -> DataFrame:
    """Keep pings with an id and coordinates inside the valid ranges (inclusive).
    NaN coordinates fail the range test and are dropped too.

    Rows without an event time pass by default (they are written once and
    never fall into a window); ``require_event_time`` rejects them as well.
    """
    ok = (F.col("shipment_id").isNotNull()
          & F.col("lat").isNotNull() & F.col("lon").isNotNull()
          & F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))
    if require_event_time:
        ok = ok & F.col("event_time").isNotNull()
    return df.where(ok)


def with_watermark(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Event-time watermark, applied after validation so rejected rows cannot
    advance it.  A no-op for batch DataFrames."""
    return df.withWatermark("event_time", settings.watermark)


def dedup(df: DataFrame, keys=DEDUP_KEYS, arrival=None) -> DataFrame:
    """Keep the first arrival of each ``(shipment_id, seq)``.

    Streaming: ``dropDuplicatesWithinWatermark`` so the dedup state is evicted
    once the watermark passes (plain ``dropDuplicates`` keeps every key
    forever, and a producer restart re-using ids would then be dropped).
    Batch: the row of least ``arrival`` (default: ingest time, Kafka partition and
    offset, as far as present; the whole row breaks ties), an aggregate with
    map-side combine whose result doesn't depend on the partitioning.

    A NULL key says nothing about identity, so rows with one are all kept.
    """
    keys = list(keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    if df.isStreaming:
        # Rows without a key are told apart by their content.
        own = F.when(~known, F.xxhash64(*df.columns))
        return df.withColumn("_own", own).dropDuplicatesWithinWatermark([*keys, "_own"]).drop("_own")
    order = [c for c in (arrival or ("ingest_time", "kafka_partition", "kafka_offset")) if c in df.columns]
    row = F.struct(*df.columns)
    first = df.where(known).groupBy(*keys).agg(
        F.min_by(row, F.struct(*order, *[c for c in df.columns if c not in order])).alias("_first"))
    return first.select("_first.*").unionByName(df.where(~known))


def _nan_to_null(c: str) -> Column:
    return F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c)


def normalise_nan(df: DataFrame, cols=("speed_kmh", "dist_km", "total_km")) -> DataFrame:
    """NaN measurements become NULL so threshold tests treat them as unknown."""
    present = [c for c in cols if c in df.columns]
    return df.select(*[_nan_to_null(c) if c in present else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- route distance

def dist_to_route(df: DataFrame, route_segments: DataFrame,
                  settings: Settings = DEFAULT, out: str = "dist_to_route_km") -> DataFrame:
    """Shortest distance (km, 3 dp) from each ping to its route's polyline.

    ``route_segments`` is ``route_id -> segs array<struct<ax,ay,bx,by>>``.
    Unknown route or missing coordinates give NULL.

    A small network (size-checked) is compiled into one expression,
    ``CASE route_id WHEN r THEN least(d(seg1), d(seg2), ...)``: no join, and
    whole-stage codegen covers it (array lambdas are interpreted).  Medium
    networks use a broadcast join and ``array_min(transform(...))``; networks
    of long polylines use the exact cell index (:func:`dist_to_route_indexed`).
    The number of segments is counted before anything is collected.
    """
    n_segs = route_segments.select(F.sum(F.size("segs"))).first()[0] or 0
    rows = route_segments.collect() if n_segs <= settings.unroll_max_segments else None
    if rows is not None:
        # Project the ping and look up its route's segments once; the per-segment terms are then
        # plain arithmetic.  Terms for the segments of every route would make a method that is
        # too long for the JVM to compile (8,000 bytes), and Spark would run it interpreted.
        segs, longest = _unrolled_route_segments(rows)
        return (df.withColumn("_px", geo.project_x("lon", settings))
                  .withColumn("_py", geo.project_y("lat", settings))
                  .withColumn("_segs", segs)
                  .withColumn(out, F.round(_unrolled_route_distance(longest), 3))
                  .drop("_px", "_py", "_segs"))
    if n_segs >= settings.segment_index_min:
        return dist_to_route_indexed(df, route_segments, settings, out)
    return _dist_to_route_join(df, route_segments, settings, out)


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _unrolled_route_segments(rows) -> tuple[Column, int]:
    """CASE route_id WHEN r THEN its segments END, as one parsed SQL expression over constant
    arrays, and the number of segments of the longest route.  A segment is its start, its extent
    and its squared length; one of no length counts as a segment of length 1 that leads nowhere,
    whose distance is that of its start."""
    rows = [r for r in rows if r["segs"] and r["route_id"] is not None]
    branches = []
    for r in sorted(rows, key=lambda r: r["route_id"]):
        structs = []
        for s in r["segs"]:
            dx, dy = s["bx"] - s["ax"], s["by"] - s["ay"]
            parts = {"ax": s["ax"], "ay": s["ay"], "dx": dx, "dy": dy, "len2": dx * dx + dy * dy or 1.0}
            structs.append("named_struct(" + ", ".join(f"'{k}', {geo.sql_num(v)}" for k, v in parts.items()) + ")")
        branches.append(f"WHEN route_id = {_sql_str(r['route_id'])} THEN array({', '.join(structs)})")
    if not branches:
        return F.lit(None), 0
    return F.expr("CASE " + " ".join(branches) + " END"), max(len(r["segs"]) for r in rows)


def _unrolled_route_distance(longest: int) -> Column:
    """least(distance to the ping's route's first segment, second, ...); a route that has fewer
    gives NULLs, which least() passes over."""
    if not longest:
        return F.lit(None).cast("double")
    ds = [geo.point_segment_sql("_px", "_py", f"get(_segs, {i})") for i in range(longest)]
    return F.expr(ds[0] if longest == 1 else "least(" + ", ".join(ds) + ")")


def _dist_to_route_join(df: DataFrame, route_segments: DataFrame, settings: Settings,
                        out: str) -> DataFrame:
    segs = network.maybe_broadcast(route_segments.select("route_id", F.col("segs").alias("_segs")),
                                   settings)
    px, py = geo.project_x("lon", settings), geo.project_y("lat", settings)
    joined = df.join(segs, on="route_id", how="left")
    dist = F.array_min(F.transform(
        F.col("_segs"), lambda s: geo.point_segment_km(px, py, s["ax"], s["ay"], s["bx"], s["by"])))
    cols = [c for c in df.columns]
    return joined.select(*cols, F.round(dist, 3).alias(out))


def _crossed(segs: DataFrame, size: float) -> DataFrame:
    """``segs`` with the grid cells (cx, cy) that each segment runs through, column by column of
    the grid: their number grows with the segment's length, not with its bounding box."""
    e = 1e-6                                            # km; a cell too many does no harm
    lo_x, hi_x = F.least("ax", "bx"), F.greatest("ax", "bx")
    cols = segs.withColumn("cx", F.explode(F.sequence(F.floor((lo_x - e) / size), F.floor((hi_x + e) / size))))

    def y_at(x: Column) -> Column:
        x = F.least(F.greatest(x, lo_x), hi_x)
        slope = F.try_divide(F.col("by") - F.col("ay"), F.col("bx") - F.col("ax"))
        return F.col("ay") + (x - F.col("ax")) * slope
    steep = F.abs(F.col("bx") - F.col("ax")) <= e       # within one column, or on a border of two
    y1 = F.when(steep, F.col("ay")).otherwise(y_at(F.col("cx") * size - e))
    y2 = F.when(steep, F.col("by")).otherwise(y_at((F.col("cx") + 1) * size + e))
    return cols.withColumn("cy", F.explode(F.sequence(F.floor((F.least(y1, y2) - e) / size),
                                                      F.floor((F.greatest(y1, y2) + e) / size))))


def _around(df: DataFrame, r: int) -> DataFrame:
    """Rows copied to all cells at most ``r`` from theirs in both directions."""
    step = F.sequence(F.lit(-r), F.lit(r))
    return df.withColumn("cx", F.explode(F.transform(step, lambda d: F.col("cx") + d))) \
             .withColumn("cy", F.explode(F.transform(step, lambda d: F.col("cy") + d)))


def segment_index(route_segments: DataFrame, size: float) -> DataFrame:
    """(route_id, cx, cy, cand) for the cells of ``size`` km that the route runs through and
    those beside them; ``cand`` holds every segment that is nearest to some point of the cell.

    From a cell beside the route no point is farther than sqrt(8) cells from it, so its
    candidates run through cells at most 3 away.  A point is at most half a diagonal from the
    cell's centre, so a segment that is a whole diagonal farther from the centre than the nearest
    one is nobody's nearest.
    """
    segs = route_segments.select("route_id", F.explode("segs").alias("s")).select("route_id", "s.*")
    runs = _crossed(segs, size)
    beside = _around(runs.select("route_id", "cx", "cy").distinct(), 1).distinct()
    near = _around(runs, 3).join(beside, ["route_id", "cx", "cy"], "left_semi").distinct()
    mx, my = (F.col("cx") + F.lit(0.5)) * size, (F.col("cy") + F.lit(0.5)) * size
    d = geo.point_segment_km(mx, my, F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    near = near.withColumn("d", d)
    least = near.groupBy("route_id", "cx", "cy").agg(F.min("d").alias("least"))
    reach = F.lit(size * math.sqrt(2.0) * (1 + 1e-9) + 1e-9)
    return near.join(least, ["route_id", "cx", "cy"]).where(F.col("d") <= F.col("least") + reach) \
        .groupBy("route_id", "cx", "cy").agg(F.collect_list(F.struct("ax", "ay", "bx", "by")).alias("cand"))


#: Cell sizes of the index grow by this factor up to ``_WORLD_KM``, more than the projection's width.
_COARSER, _WORLD_KM = 4, 25_000.0


def dist_to_route_indexed(df: DataFrame, route_segments: DataFrame,
                          settings: Settings = DEFAULT,
                          out: str = "dist_to_route_km") -> DataFrame:
    """Route distance for networks with long polylines, exact.

    Grids of growing cells, each only on the route and beside it (``segment_index``).  A
    ping takes its candidates from the finest grid whose cell it is in: on its route that is a
    few segments, and the farther off it is, the coarser the cell; no ping meets its whole route
    unless it is about as far from it as the route is long.  Every grid is one equi-join on
    (route, cell), whose key is null once a finer one has answered; each is a written table,
    broadcast behind a size check, so the plan also serves a stream.
    """
    spark = route_segments.sparkSession
    keyed = df.withColumn("_px", geo.project_x("lon", settings)).withColumn("_py", geo.project_y("lat", settings)) \
              .withColumn("_cand", F.lit(None).cast("array<struct<ax:double,ay:double,bx:double,by:double>>"))
    size = settings.segment_cell_km
    while True:
        path = scratch_path(spark, "segment-index")
        segment_index(route_segments, size).write.parquet(path)
        grid = spark.read.parquet(path).select(F.col("route_id").alias("_r"), F.col("cx").alias("_x"), F.col("cy").alias("_y"),
                                               F.col("cand").alias("_found"))
        open_ = F.col("_cand").isNull()
        keyed = keyed.withColumn("_kx", F.when(open_, F.floor(F.col("_px") / size))) \
            .withColumn("_ky", F.when(open_, F.floor(F.col("_py") / size)))
        keyed = keyed.join(network.maybe_broadcast(grid, settings), (F.col("route_id") == F.col("_r")) & (F.col("_kx") == F.col("_x"))
                           & (F.col("_ky") == F.col("_y")), "left") \
            .withColumn("_cand", F.coalesce("_cand", "_found")).drop("_r", "_x", "_y", "_found", "_kx", "_ky")
        if size >= _WORLD_KM:
            break
        size *= _COARSER
    px, py = F.col("_px"), F.col("_py")
    d = F.array_min(F.transform("_cand", lambda s: geo.point_segment_km(px, py, s["ax"], s["ay"], s["bx"], s["by"])))
    return keyed.select(*df.columns, F.round(d, 3).alias(out))


# ---------------------------------------------------------------- facility lookup

def _facility_array(rows) -> Column:
    return F.array(*[
        F.struct(F.lit(int(r["ord"])).cast("bigint").alias("ord"), F.lit(r["name"]).alias("name"),
                 F.lit(float(r["lat"])).alias("lat"), F.lit(float(r["lon"])).alias("lon"))
        for r in rows])


def _nearest_within(facs: Column, lat: Column, lon: Column, radius: float,
                    settings: Settings) -> Column:
    best = F.array_min(F.transform(facs, lambda f: F.struct(
        geo.haversine_km(lat, lon, f["lat"], f["lon"], settings).alias("d"),
        f["ord"].alias("ord"), f["name"].alias("name"))))
    return F.when(best["d"] <= F.lit(radius), best["name"])


def nearest_facility(df: DataFrame, facilities: DataFrame, settings: Settings = DEFAULT,
                     out: str = "at_facility") -> DataFrame:
    """Name of the nearest facility when within the geofence radius (inclusive),
    else NULL.  Ties go to the facility listed first (``ord``).

    Small facility sets (checked size) become a literal array: no join, no
    shuffle.  Larger sets use :func:`nearest_facility_grid`.
    """
    rows = network.collect_bounded(facilities, settings.facility_array_max, order_by="ord")
    if rows is None:
        return nearest_facility_grid(df, facilities, settings, out)
    n = len(rows)
    if not rows:
        return df.withColumn(out, F.lit(None).cast("string"))
    lat, lon = F.col("lat"), F.col("lon")
    if n <= settings.unroll_max_facilities:
        best = _nearest_unrolled(rows, lat, lon, settings)
    else:
        best = _nearest_array(_facility_array(rows), lat, lon, settings)
    # The nearest candidate is used twice in one projection, so Spark computes it once, in a
    # method of its own: written inline, the method of the whole enrichment would be too long for
    # the JVM to compile.  Its distance is tested twice lest the projections become one, which
    # would compute it anew in each branch.
    return (df.withColumns({"_near_km": best["d"], "_near": best["name"]})
              .withColumn(out, F.when(F.col("_near_km").between(0.0, settings.facility_radius_km), F.col("_near")))
              .drop("_near_km", "_near"))


def _nearest_unrolled(rows, lat: Column, lon: Column, settings: Settings) -> Column:
    """least(struct(d_i, ord_i, name_i)) over a small facility list, compiled
    into the generated code instead of an interpreted array lambda (one parsed
    SQL expression; same arithmetic as :func:`geo.haversine_km`)."""
    df_lat, df_lon = "lat", "lon"
    cands = [f"named_struct('d', {geo.haversine_sql(df_lat, df_lon, geo.sql_num(r['lat']), geo.sql_num(r['lon']), settings)}, "
             f"'ord', CAST({int(r['ord'])} AS BIGINT), 'name', {_sql_str(r['name'])})" for r in rows]
    return F.expr(cands[0] if len(cands) == 1 else "least(" + ", ".join(cands) + ")")


def _nearest_array(facs: Column, lat: Column, lon: Column, settings: Settings) -> Column:
    return F.array_min(F.transform(facs, lambda f: F.struct(
        geo.haversine_km(lat, lon, f["lat"], f["lon"], settings).alias("d"),
        f["ord"].alias("ord"), f["name"].alias("name"))))


def nearest_facility_grid(df: DataFrame, facilities: DataFrame, settings: Settings = DEFAULT,
                          out: str = "at_facility") -> DataFrame:
    """Facility lookup for large facility sets as an equi-join on grid cells.

    Cells are ``g`` degrees square, ``g`` <= the radius as an angle and
    dividing 360 so longitude cells wrap at +-180 (cell index pmod 360/g).  A
    facility is copied into every cell its geofence can touch: latitude
    +- the radius angle, longitude +- the haversine bound for its latitude
    band.  Each cell holds an array of candidates and a ping joins exactly
    one cell (its own), so the nearest-within-radius test stays an array
    expression and no per-ping aggregation (shuffle) is needed.  The cell
    table is broadcast behind a size check; otherwise AQE splits hot cells of
    the sort-merge join.
    """
    radius = settings.facility_radius_km
    ang = radius / settings.earth_km                      # radians
    c = math.degrees(ang)                                  # geofence angle in degrees
    n_lon = math.ceil(360.0 / c)
    g = 360.0 / n_lon                                      # cell size, divides 360
    flat, flon = F.col("lat"), F.col("lon")
    # Longitude half-width of the geofence at the facility's latitude band.
    cos_far = F.cos(F.radians(F.least(F.abs(flat) + F.lit(c), F.lit(89.9))))
    half_lon = F.degrees(F.lit(2.0) * F.asin(F.least(
        F.lit(1.0), F.lit(math.sin(ang / 2)) / F.sqrt(F.cos(F.radians(flat)) * cos_far))))
    cells = (facilities
             .withColumn("cy", F.explode(F.sequence(F.floor((flat - F.lit(c)) / F.lit(g)),
                                                    F.floor((flat + F.lit(c)) / F.lit(g)))))
             .withColumn("cx", F.explode(F.sequence(F.floor((flon - half_lon) / F.lit(g)),
                                                    F.floor((flon + half_lon) / F.lit(g)))))
             .withColumn("cx", F.pmod(F.col("cx"), F.lit(n_lon)))
             .groupBy("cx", "cy")
             .agg(F.collect_list(F.struct(F.col("ord").cast("bigint").alias("ord"), "name",
                                          "lat", "lon")).alias("_facs")))
    cells = network.maybe_broadcast(cells, settings)
    keyed = df.withColumn("_cx", F.pmod(F.floor(F.col("lon") / F.lit(g)), F.lit(n_lon))) \
              .withColumn("_cy", F.floor(F.col("lat") / F.lit(g)))
    joined = keyed.join(cells, (F.col("_cx") == F.col("cx")) & (F.col("_cy") == F.col("cy")),
                        "left")
    res = _nearest_within(F.col("_facs"), F.col("lat"), F.col("lon"), radius, settings)
    return joined.select(*df.columns, res.alias(out))


# ---------------------------------------------------------------- enrichment

def enrich(df: DataFrame, route_segments: DataFrame, facilities: DataFrame,
           settings: Settings = DEFAULT) -> DataFrame:
    """progress %, is_moving, dist_to_route_km (3 dp) and at_facility."""
    df = (normalise_nan(df)
          .withColumn("progress_pct", telemetry.progress_pct())
          .withColumn("is_moving", telemetry.is_moving(settings=settings)))
    df = dist_to_route(df, route_segments, settings)
    return nearest_facility(df, facilities, settings)


def silver(pings: DataFrame, route_segments: DataFrame, facilities: DataFrame,
           settings: Settings = DEFAULT) -> DataFrame:
    """validate -> watermark -> dedup -> enrich (the Silver job)."""
    return enrich(dedup(with_watermark(validate(pings), settings)),
                  route_segments, facilities, settings)
