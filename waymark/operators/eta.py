"""ETA data jobs: training set from completed trips, serving features, request
validation/defaults, fallback scoring, regression metrics and the
champion / challenger gate.

Scale notes
-----------
* The trip label needs each trip's arrival time: a ``groupBy`` (partial
  aggregation) joined back on ``shipment_id``.  The aggregated side is one row
  per trip; AQE turns the join into a broadcast when its runtime size is small
  and splits skewed partitions otherwise, so no window over a whole trip.
* Trailing speeds use :mod:`waymark.operators.rolling` (per time bucket).
* Metrics are single-pass aggregates (R2 from sums), no second scan.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.config import DEFAULT, Settings
from waymark.functions import telemetry
from waymark.operators import fleet, rolling
from waymark.session import scratch_path

# Feature, target and column names of the training table.
NUMERIC = ["hour", "dow", "dist_remaining_km", "progress_pct", "speed_kmh", "avg_speed_kmh",
           "dist_to_route_km", "is_stopped"]
TARGET = "minutes_to_arrival"
TRAINING_COLUMNS = ["shipment_id", "seq", "route_id"] + NUMERIC + [TARGET]


def hash_unit(*parts) -> Column:
    """A deterministic uniform number in [0, 1) from the md5 of the parts."""
    text = F.concat_ws("#", *[p if isinstance(p, Column) else F.col(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def holdout_flag(trip_col: str = "shipment_id", pct: int = 20) -> Column:
    """True for the held-out share of trips: whole trips fall on one side."""
    bucket = F.conv(F.substring(F.md5(F.col(trip_col)), 1, 8), 16, 10).cast("bigint") % 100
    return bucket < pct


def arrivals(silver: DataFrame) -> DataFrame:
    """Completed trips: the first ping at or beyond the route length."""
    arrival = F.min(F.when(F.col("dist_km") >= F.col("total_km"), F.col("event_time")))
    return (silver.groupBy("shipment_id").agg(arrival.alias("arrival_time"))
                  .where(F.col("arrival_time").isNotNull()))


def training_set(silver: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One labelled row per ping of a completed trip, up to its arrival.

    Features mirror serving: hour / weekday (Monday = 0) of the ping, km left
    (3 dp), progress, speed, mean of the last 5 speeds (1 dp), distance to
    route (NULL -> 0), stopped flag (speed < 3); label = minutes to arrival
    (2 dp).
    """
    base = silver.select("shipment_id", "seq", "route_id", "event_time", "dist_km", "total_km",
                         "progress_pct", "speed_kmh", "dist_to_route_km")
    rolled = rolling.trailing_mean(base, "shipment_id", "event_time", "seq", "speed_kmh",
                                   "_avg_speed", settings.trailing_pings, settings)
    j = rolled.join(arrivals(silver), "shipment_id").where(
        F.col("event_time") <= F.col("arrival_time"))
    minutes = (F.unix_seconds("arrival_time") - F.unix_seconds("event_time")) / F.lit(60.0)
    return j.select(
        "shipment_id", "seq", "route_id",
        telemetry.hour_of("event_time").alias("hour"),
        telemetry.weekday_of("event_time").alias("dow"),
        F.round(telemetry.dist_remaining_km(), 3).alias("dist_remaining_km"),
        "progress_pct", "speed_kmh",
        F.round("_avg_speed", 1).alias("avg_speed_kmh"),
        telemetry.zero_if_null("dist_to_route_km").alias("dist_to_route_km"),
        telemetry.is_stopped(settings=settings).alias("is_stopped"),
        F.round(minutes, 2).alias(TARGET))


def label_summary(training: DataFrame) -> DataFrame:
    return training.agg(F.count(F.lit(1)).alias("rows"),
                        F.countDistinct("route_id").alias("routes"),
                        F.min(TARGET).alias("label_min"),
                        F.round(F.avg(TARGET), 6).alias("label_mean"),
                        F.max(TARGET).alias("label_max"))


def shipment_features(silver: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Serving features of every shipment from its latest ping and the mean of
    its last 5 speeds (one job for the whole fleet)."""
    last = fleet.latest_state(silver, ["route_id", "dist_km", "total_km", "progress_pct",
                                       "speed_kmh", "dist_to_route_km", "event_time"])
    avg = rolling.latest_trailing_mean(silver, "shipment_id", "event_time", "seq", "speed_kmh",
                                       "avg_speed_kmh", settings.trailing_pings, settings)
    j = last.join(avg, "shipment_id", "left")
    return j.select(
        "shipment_id", "route_id",
        telemetry.hour_of("event_time").alias("hour"),
        telemetry.weekday_of("event_time").alias("dow"),
        telemetry.dist_remaining_km().alias("dist_remaining_km"),
        "progress_pct", "speed_kmh", "avg_speed_kmh",
        telemetry.zero_if_null("dist_to_route_km").alias("dist_to_route_km"),
        telemetry.is_stopped(settings=settings).alias("is_stopped"),
        "event_time")


# ------------------------------------------------------------------ requests

REQUEST_COLUMNS = ["request_id", "route_id", "dist_remaining_km", "progress_pct", "speed_kmh",
                   "avg_speed_kmh", "dist_to_route_km", "hour", "dow", "as_of"]


#: Schema of request files.
REQUEST_SCHEMA = ("request_id string, route_id string, dist_remaining_km double, progress_pct double, speed_kmh double, "
                  "avg_speed_kmh double, dist_to_route_km double, hour int, dow int, as_of timestamp")


def requests_from_pings(silver: DataFrame, shifted: bool = False) -> DataFrame:
    """Prediction requests as a client sends them: every ping asks for an ETA.

    ``shifted`` applies the congestion shift of the load generator (distance
    x U(0.1, 0.3), speed x U(0.3, 0.5)) with per-row factors from a hash, so
    the drifted traffic is deterministic.
    """
    return _requests(silver, [shifted]).drop("traffic")


def requests_from_board(status: DataFrame) -> DataFrame:
    """One request for each shipment of the board (``fleet.with_status``), as the board asks
    for its ETAs: the current speed stands for the trailing mean, and the time is that of
    the shipment's last ping."""
    return status.select(
        F.col("shipment_id").alias("request_id"), "route_id", "dist_remaining_km", "progress_pct", "speed_kmh",
        F.col("speed_kmh").alias("avg_speed_kmh"), "dist_to_route_km", F.lit(None).cast("int").alias("hour"),
        F.lit(None).cast("int").alias("dow"), F.col("event_time").alias("as_of"))


def traffic_from_pings(silver: DataFrame) -> DataFrame:
    """Plain and shifted requests of every ping from one scan; ``traffic`` is "live" or "shifted"."""
    return _requests(silver, [False, True])


def _requests(silver: DataFrame, kinds: list[bool]) -> DataFrame:
    rid = F.concat_ws("#", F.col("shipment_id"), F.col("seq").cast("string"))

    def asked(shifted: bool) -> Column:
        dist, speed = telemetry.dist_remaining_km(), F.col("speed_kmh")
        if shifted:
            dist = dist * (F.lit(0.1) + F.lit(0.2) * hash_unit(rid, F.lit("dist")))
            speed = speed * (F.lit(0.3) + F.lit(0.2) * hash_unit(rid, F.lit("speed")))
        return F.struct(F.lit("shifted" if shifted else "live").alias("traffic"),
                        F.round(dist, 2).alias("dist_remaining_km"), F.round(speed, 1).alias("speed_kmh"))

    r = silver.select(rid.alias("request_id"), "route_id", "progress_pct", F.col("event_time").alias("as_of"),
                      F.inline(F.array(*[asked(k) for k in kinds])))
    return r.select(
        "traffic", "request_id", "route_id", "dist_remaining_km", "progress_pct", "speed_kmh",
        F.lit(None).cast("double").alias("avg_speed_kmh"), F.lit(0.0).alias("dist_to_route_km"),
        F.lit(None).cast("int").alias("hour"), F.lit(None).cast("int").alias("dow"), "as_of")


def _valid_request() -> Column:
    return (F.col("route_id").isNotNull() & F.col("dist_remaining_km").isNotNull()
            & ~F.isnan(F.col("dist_remaining_km").cast("double")) & (F.col("dist_remaining_km") >= 0))


def reject_requests(requests: DataFrame) -> DataFrame:
    """Requests a client gets an error for: missing route or distance, or a
    negative remaining distance."""
    reason = (F.when(F.col("route_id").isNull(), F.lit("route_id missing"))
               .when(F.col("dist_remaining_km").isNull() | F.isnan(F.col("dist_remaining_km").cast("double")),
                     F.lit("dist_remaining_km missing"))
               .otherwise(F.lit("dist_remaining_km must be >= 0")))
    return requests.where(~F.coalesce(_valid_request(), F.lit(False))) \
                   .select("request_id", "route_id", "dist_remaining_km", reason.alias("reason"))


def request_features(requests: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Valid requests with defaults filled: hour / weekday from ``as_of``,
    trailing speed <- current speed, other numerics 0, stopped = speed < 3."""
    r = requests.where(F.coalesce(_valid_request(), F.lit(False)))

    def number(c: str) -> Column:
        """NaN counts as missing."""
        return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))

    speed = F.coalesce(number("speed_kmh"), F.lit(0.0))
    return r.select(
        *(["traffic"] if "traffic" in r.columns else []), "request_id", "route_id",
        F.coalesce(F.col("hour"), telemetry.hour_of("as_of")).alias("hour"),
        F.coalesce(F.col("dow"), telemetry.weekday_of("as_of")).alias("dow"),
        "dist_remaining_km",
        F.coalesce(number("progress_pct"), F.lit(0.0)).alias("progress_pct"),
        speed.alias("speed_kmh"),
        F.coalesce(number("avg_speed_kmh"), speed).alias("avg_speed_kmh"),
        F.coalesce(number("dist_to_route_km"), F.lit(0.0)).alias("dist_to_route_km"),
        (speed < F.lit(settings.stopped_speed_kmh)).cast("int").alias("is_stopped"))


def score(features: DataFrame, model=None, settings: Settings = DEFAULT,
          model_version: int | None = None) -> DataFrame:
    """Adds predicted_eta_min (1 dp), method and model_version.

    With a fitted ``PipelineModel`` the model predicts every row in one
    distributed ``transform``.  Rows with a missing (NULL or NaN) feature, which the
    trees would still put in some leaf, and every row when no model is given use the
    distance / speed fallback; their model_version is NULL.
    """
    fallback = telemetry.fallback_eta_min("dist_remaining_km", "avg_speed_kmh", settings)
    if model is None:
        return features.withColumn("predicted_eta_min", fallback) \
                       .withColumn("method", F.lit("fallback")) \
                       .withColumn("model_version", F.lit(None).cast("bigint"))
    cols = features.columns
    complete = F.lit(True)
    for c in NUMERIC:
        complete = complete & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    from waymark.operators.boosting import predicted
    pred = predicted(model, features).withColumn("_p", F.when(complete, F.col("prediction")))
    by_model = F.col("_p").isNotNull()
    return pred.select(
        *cols,
        F.coalesce(F.round("_p", 1), fallback).alias("predicted_eta_min"),
        F.when(by_model, F.lit("model")).otherwise(F.lit("fallback")).alias("method"),
        F.when(by_model, F.lit(model_version)).cast("bigint").alias("model_version"))


# ------------------------------------------------------------------ evaluation

def regression_metrics(df: DataFrame, pred: str, label: str = TARGET) -> DataFrame:
    """MAE, RMSE and R2 (= 1 - SSE / SST) in one aggregation pass.

    SST comes from ``var_pop``, whose running form doesn't cancel on large labels; a
    constant label has no R2 (NULL)."""
    err = F.col(pred) - F.col(label)
    n = F.count(F.lit(1))
    return df.where(F.col(pred).isNotNull() & F.col(label).isNotNull()).agg(
        n.alias("n"),
        F.round(F.avg(F.abs(err)), 6).alias("mae"),
        F.round(F.sqrt(F.avg(err * err)), 6).alias("rmse"),
        F.round(F.lit(1.0) - F.try_divide(F.avg(err * err), F.var_pop(label)), 6).alias("r2"))


def promotion_gate(df: DataFrame, champion: str | None, challenger: str,
                   label: str = TARGET, settings: Settings = DEFAULT) -> DataFrame:
    """Promote the challenger iff there is no champion or its MAE is at least
    1 % below the champion's, both measured on the same held-out rows."""
    chal_mae = F.avg(F.abs(F.col(challenger) - F.col(label)))
    champ_mae = (F.avg(F.abs(F.col(champion) - F.col(label))) if champion
                 else F.lit(None).cast("double"))
    g = df.agg(F.count(F.lit(1)).alias("n_holdout"), champ_mae.alias("champion_mae"),
               chal_mae.alias("challenger_mae"))
    promote = (F.col("champion_mae").isNull()
               | (F.col("challenger_mae") < F.col("champion_mae")
                  * F.lit(1.0 - settings.champion_margin)))
    return g.select("n_holdout", F.round("champion_mae", 6).alias("champion_mae"),
                    F.round("challenger_mae", 6).alias("challenger_mae"),
                    F.coalesce(promote, F.lit(False)).alias("promote"))


# ------------------------------------------------------------------ sampling

def thin(df: DataFrame, keep: float = 0.5, seed: int = 42, key=("shipment_id", "seq")) -> DataFrame:
    """Bernoulli thinning: keep each row with probability ``keep``, decided by a
    hash of its key, so the result does not depend on partitioning or retries."""
    u = F.pmod(F.xxhash64(*[F.col(k) for k in key], F.lit(seed)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    return df.where(u < F.lit(keep))


#: Rows that share a cell of the bootstrap, ranges whose counts the driver splits, draws of a chunk.
CELL_ROWS, RANGES, CHUNK = 20_000, 4096, 10_000


def _split(n: int, counts: list[int], seed: int) -> list[int]:
    """n draws among ``counts`` rows each, multinomial: a binomial of what is left at a time."""
    rng, left, out = np.random.default_rng(seed), sum(counts), []
    for c in counts:
        k = int(rng.binomial(n, c / left)) if n and left else 0
        out.append(k)
        n, left = n - k, left - c
    return out


def _under(starts: DataFrame, draws: DataFrame, by: list[str], what: list[str], pos: str) -> DataFrame:
    """``draws`` with the columns ``what`` of the last start at or before their ``pos``, within ``by``."""
    names = [c for c in draws.columns if c not in by and c != pos]
    none = F.lit(None)
    a = starts.select(*by, F.col("start").alias(pos), F.struct("start", *what).alias("_at"),
                      *[none.cast(draws.schema[c].dataType).alias(c) for c in names], F.lit(0).alias("_kind"))
    b = draws.select(*by, pos, none.cast(a.schema["_at"].dataType).alias("_at"), *names, F.lit(1).alias("_kind"))
    last = Window.partitionBy(*by).orderBy(pos, "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return a.unionByName(b).withColumn("_at", F.last("_at", ignorenulls=True).over(last)) \
        .where("_kind = 1").select(*by, pos, *names, "_at.*")


def bootstrap_sample(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows drawn with replacement; the same rows from any partitioning of ``df``.

    Rows are dealt by their hash into ranges, at most ``RANGES``, and those into cells of about
    ``CELL_ROWS``; both are counted with map-side combining.  The n draws are split over the
    ranges by an exact multinomial.  Each draw is a hashed position within its range; running
    counts tell the cell under it, and in the drawn cells only, the row.  Equal rows are one
    row with a count, so a row that makes up a third of the table is no hot group; draws are
    worked off in chunks, so neither is a cell that many of them fall into.
    """
    total = df.count()
    if total == 0 or n <= 0:
        return df.limit(0)
    spark, own = df.sparkSession, df.columns
    cells = -(-total // CELL_ROWS)
    ranges = min(RANGES, cells)
    cols = [F.col(f"`{c}`") for c in own]
    row = F.struct(*cols)
    keyed = df.select(row.alias("_row"), F.pmod(F.xxhash64(*cols), F.lit(ranges)).cast("int").alias("_a"),
                      F.pmod(F.xxhash64(F.lit("cell"), *cols), F.lit(-(-cells // ranges))).cast("int").alias("_b"))
    path = scratch_path(spark, "bootstrap-cells")
    keyed.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("w")).write.parquet(path)
    sizes = spark.read.parquet(path)
    per = sorted((r["_a"], r["w"]) for r in sizes.groupBy("_a").agg(F.sum("w").alias("w")).collect())   # at most RANGES
    plan = [(a, w, m) for (a, w), m in zip(per, _split(n, [w for _, w in per], seed)) if m]
    plan = spark.createDataFrame(plan, "_a int, w long, m long")
    chunks = F.ceil(F.col("m") / CHUNK).cast("int")
    size = F.least(F.lit(CHUNK), F.col("m") - F.col("_c") * F.lit(CHUNK)).cast("int")
    draws = plan.select("_a", "w", "m", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("_c")) \
        .repartition("_a", "_c").select("_a", "_c", "w", F.explode(F.sequence(F.lit(0), size - 1)).alias("_j")) \
        .select("_a", "_c", "_j", F.pmod(F.xxhash64(F.lit(seed), "_a", "_c", "_j"), F.col("w")).alias("pos"))
    before = Window.partitionBy("_a").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    starts = sizes.withColumn("start", F.sum("w").over(before) - F.col("w")) \
        .join(plan.select("_a", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("_c")), "_a")
    path = scratch_path(spark, "bootstrap-draws")
    _under(starts, draws, ["_a", "_c"], ["_b"], "pos").select(
        "_a", "_b", "_c", "_j", (F.col("pos") - F.col("start")).alias("at")).write.parquet(path)
    drawn = spark.read.parquet(path)

    busy = drawn.groupBy("_a", "_b").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("k"))
    held = keyed.join(busy, ["_a", "_b"], "left_semi").groupBy("_a", "_b", "_row").agg(F.count(F.lit(1)).alias("w"))
    upto = Window.partitionBy("_a", "_b").orderBy(F.xxhash64("_row"), "_row").rowsBetween(Window.unboundedPreceding, 0)
    held = held.withColumn("start", F.sum("w").over(upto) - F.col("w"))
    held = held.join(busy, ["_a", "_b"]).withColumn("_d", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    asked = drawn.join(busy, ["_a", "_b"]).withColumn("_d", F.pmod(F.xxhash64("_c", "_j"), F.col("k")).cast("int"))
    found = _under(held, asked.select("_a", "_b", "_d", "_c", "_j", "at"), ["_a", "_b", "_d"], ["_row"], "at")
    return found.select("_row.*")


def shipment_eta(silver: DataFrame, shipment_id: str, model=None,
                 settings: Settings = DEFAULT, model_version: int | None = None) -> DataFrame:
    """ETA of one shipment; the id filter reaches the Silver scan.  An unknown
    id gives an empty DataFrame (the caller reports "not found")."""
    one = silver.where(F.col("shipment_id") == F.lit(shipment_id))
    feats = shipment_features(one, settings)
    return score(feats.drop("event_time"), model, settings, model_version).select(
        "shipment_id", "route_id", "dist_remaining_km", "speed_kmh", "predicted_eta_min", "method",
        "model_version", "progress_pct")
