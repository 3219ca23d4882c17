"""Registry of the named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query derives its inputs from the tables under ``sf_dir`` and returns a
lazy DataFrame whose column names match the SQL in ``waymark.plans.oracle``.
Timestamps are emitted as TIMESTAMP_NTZ (UTC wall clock).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import telemetry
from waymark.operators import eta, fleet, geometry, reports, silver as silver_ops
from waymark.plans.lake import Lake, as_ntz
from waymark.sources import envelope

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Callable[[Lake], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return as_ntz(fn(Lake(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


# ------------------------------------------------------------------ bronze

@query("bronze_parse")
def _bronze_parse(lk: Lake) -> DataFrame:
    """Envelope -> decoded Bronze rows (ingest_time left out: it is wall-clock)."""
    return envelope.decode_envelope(lk.envelopes, with_ingest_time=False)


@query("keyed_envelope")
def _keyed_envelope(lk: Lake) -> DataFrame:
    return lk.envelopes


@query("peek_messages")
def _peek(lk: Lake) -> DataFrame:
    return envelope.peek(lk.envelopes, 15)


@query("bronze_summary")
def _bronze_summary(lk: Lake) -> DataFrame:
    return reports.bronze_summary(lk.bronze)


@query("bronze_quality")
def _bronze_quality(lk: Lake) -> DataFrame:
    return reports.bronze_quality(lk.bronze)


@query("pings_per_route")
def _pings_per_route(lk: Lake) -> DataFrame:
    return reports.pings_per_route(lk.bronze)


@query("bronze_sample")
def _bronze_sample(lk: Lake) -> DataFrame:
    return reports.bronze_sample(lk.bronze)


# ------------------------------------------------------------------ silver

@query("silver_valid")
def _silver_valid(lk: Lake) -> DataFrame:
    return lk.valid


@query("silver_dedup")
def _silver_dedup(lk: Lake) -> DataFrame:
    return lk.deduped


@query("silver_enrich")
def _silver_enrich(lk: Lake) -> DataFrame:
    """The Silver job itself: validate, dedup and enrich the Bronze table."""
    return lk.silver_plan


@query("silver_summary")
def _silver_summary(lk: Lake) -> DataFrame:
    return reports.silver_summary(lk.silver)


@query("silver_sample")
def _silver_sample(lk: Lake) -> DataFrame:
    return reports.silver_sample(lk.silver)


@query("dist_to_route")
def _dist_to_route(lk: Lake) -> DataFrame:
    """Distance to the planned route for every raw ping (invalid ones included)."""
    p = lk.pings.select("event_id", "copy", "route_id", "lat", "lon")
    return silver_ops.dist_to_route(p, lk.route_arrays, lk.settings) \
        .select("event_id", "copy", "dist_to_route_km")


@query("nearest_facility")
def _nearest_facility(lk: Lake) -> DataFrame:
    p = lk.pings.select("event_id", "copy", "lat", "lon")
    return silver_ops.nearest_facility(p, lk.facilities, lk.settings) \
        .select("event_id", "copy", "at_facility")


@query("expected_position")
def _expected_position(lk: Lake) -> DataFrame:
    s = lk.deduped.select("event_id", "route_id", "dist_km")
    return geometry.expected_position(s, lk.segments, lk.settings) \
        .select("event_id", "exp_lat", "exp_lon", "seg_bearing")


@query("haversine")
def _haversine(lk: Lake) -> DataFrame:
    s = lk.deduped.select("event_id", "route_id", "lat", "lon")
    return geometry.distance_to_ends(s, lk.waypoints, lk.settings) \
        .select("event_id", "km_from_origin", "km_to_destination")


@query("bearing")
def _bearing(lk: Lake) -> DataFrame:
    s = lk.deduped.select("event_id", "route_id", "lat", "lon")
    return geometry.bearing_to_destination(s, lk.waypoints, lk.settings) \
        .select("event_id", "bearing_to_destination")


@query("offset_point")
def _offset_point(lk: Lake) -> DataFrame:
    s = lk.deduped.select("event_id", "lat", "lon", "heading")
    return geometry.lateral_offset(s, 2.0).select("event_id", "off_lat", "off_lon")


@query("route_lengths")
def _route_lengths(lk: Lake) -> DataFrame:
    return geometry.route_coverage(lk.silver, lk.waypoints, lk.settings)


# ------------------------------------------------------------------ gold

@query("gold_status")
def _gold_status(lk: Lake) -> DataFrame:
    return lk.status_events


@query("gold_exceptions")
def _gold_exceptions(lk: Lake) -> DataFrame:
    return lk.exceptions


@query("status_by_type")
def _status_by_type(lk: Lake) -> DataFrame:
    return reports.events_by_type(lk.status_events)


@query("exceptions_by_type")
def _exceptions_by_type(lk: Lake) -> DataFrame:
    return reports.events_by_type(lk.exceptions)


@query("status_sample")
def _status_sample(lk: Lake) -> DataFrame:
    return reports.status_sample(lk.status_events)


@query("exceptions_sample")
def _exceptions_sample(lk: Lake) -> DataFrame:
    return reports.exceptions_sample(lk.exceptions)


# ------------------------------------------------------------------ fleet state

def _status_out(df: DataFrame) -> DataFrame:
    return df.withColumn("color", F.array_join(F.col("color"), ","))


@query("latest_state")
def _latest_state(lk: Lake) -> DataFrame:
    return lk.latest_state


@query("latest_nonnull")
def _latest_nonnull(lk: Lake) -> DataFrame:
    return lk.latest_nonnull


@query("shipment_status")
def _shipment_status(lk: Lake) -> DataFrame:
    """Status on the latest non-NULL value per column (facility is sticky)."""
    return _status_out(lk.status)


@query("shipment_status_latest")
def _shipment_status_latest(lk: Lake) -> DataFrame:
    """Status on the latest ping as a whole."""
    return _status_out(fleet.with_status(lk.latest_state, lk.settings))


@query("shipment_board")
def _shipment_board(lk: Lake) -> DataFrame:
    return lk.board


@query("fleet_kpis")
def _fleet_kpis(lk: Lake) -> DataFrame:
    return fleet.kpis(lk.board)


@query("exception_feed")
def _exception_feed(lk: Lake) -> DataFrame:
    return fleet.exception_feed(lk.status_events, lk.exceptions, settings=lk.settings)


# ------------------------------------------------------------------ ETA

@query("training_set")
def _training_set(lk: Lake) -> DataFrame:
    """The training-set job over the Silver table."""
    return lk.training_plan


@query("label_summary")
def _label_summary(lk: Lake) -> DataFrame:
    return eta.label_summary(lk.training)


@query("eta_features")
def _eta_features(lk: Lake) -> DataFrame:
    return lk.features


@query("eta_for_shipment")
def _eta_for_shipment(lk: Lake) -> DataFrame:
    """ETA of every shipment from its latest ping (fallback estimator)."""
    s = eta.score(lk.features.drop("event_time"), None, lk.settings)
    return s.select("shipment_id", "predicted_eta_min", "method", "progress_pct")


@query("fallback_eta")
def _fallback_eta(lk: Lake) -> DataFrame:
    t = lk.training
    return t.select("shipment_id", "seq", telemetry.fallback_eta_min(
        "dist_remaining_km", "avg_speed_kmh", lk.settings).alias("eta_min"))


@query("score_requests")
def _score_requests(lk: Lake) -> DataFrame:
    return lk.scored_requests().select(
        "request_id", "route_id", "hour", "dow", "dist_remaining_km", "speed_kmh",
        "avg_speed_kmh", "is_stopped", "predicted_eta_min", "method")


@query("score_rejects")
def _score_rejects(lk: Lake) -> DataFrame:
    """Requests with defects a client may send: some routes and distances missing,
    some distances negative."""
    return eta.reject_requests(_defective(lk.requests()))


def _defective(r: DataFrame) -> DataFrame:
    n = F.regexp_extract("request_id", "#([0-9]+)$", 1).cast("bigint") % 20
    return (r.withColumn("route_id", F.when(n != 3, F.col("route_id")))
             .withColumn("dist_remaining_km", F.when(n == 5, -1.0 - F.col("dist_remaining_km"))
                         .when(n != 7, F.col("dist_remaining_km"))))


@query("regression_metrics")
def _regression_metrics(lk: Lake) -> DataFrame:
    """Fallback estimator against the trip labels."""
    t = lk.training.withColumn("pred", telemetry.fallback_eta_min(
        "dist_remaining_km", "avg_speed_kmh", lk.settings))
    return eta.regression_metrics(t, "pred")


@query("score_requests_model")
def _score_requests_model(lk: Lake) -> DataFrame:
    """The requests scored by the fitted champion."""
    return lk.scored_requests(model=lk.model()).select(
        "request_id", "route_id", "dist_remaining_km", "speed_kmh", "predicted_eta_min", "method")


@query("eta_for_shipment_model")
def _eta_for_shipment_model(lk: Lake) -> DataFrame:
    """ETA of every shipment from its latest ping by the fitted champion."""
    s = eta.score(lk.features.drop("event_time"), lk.model(), lk.settings)
    return s.select("shipment_id", "predicted_eta_min", "method", "progress_pct")


@query("shipment_board_model")
def _shipment_board_model(lk: Lake) -> DataFrame:
    """The shipment board with the fitted champion's ETAs."""
    return lk.board_by(lk.model())


@query("promotion_gate")
def _promotion_gate(lk: Lake) -> DataFrame:
    """Two fitted models, champion and challenger, on the held-out trips."""
    from waymark.operators import model as mdl
    scored = mdl.both_predictions(lk.model("champion"), lk.model("challenger"), mdl.split(lk.training)[1])
    return eta.promotion_gate(scored, "champion", "challenger", settings=lk.settings)


@query("promotion_gate_fallback")
def _promotion_gate_fallback(lk: Lake) -> DataFrame:
    """Champion = fallback on the trailing mean speed, challenger = fallback on
    the current speed; both on the held-out trips."""
    t = lk.training.where(eta.holdout_flag("shipment_id"))
    t = (t.withColumn("champion", telemetry.fallback_eta_min("dist_remaining_km", "avg_speed_kmh",
                                                             lk.settings))
          .withColumn("challenger", telemetry.fallback_eta_min("dist_remaining_km", "speed_kmh",
                                                               lk.settings)))
    return eta.promotion_gate(t, "champion", "challenger", settings=lk.settings)


@query("eta_model_metrics")
def _eta_model_metrics(lk: Lake) -> DataFrame:
    """Gradient-boosted trees fitted on 80 % of the trips, scored on the rest."""
    from waymark.operators import model as mdl
    return mdl.metrics_of(lk.model(), lk.training)


@query("eta_feature_vector")
def _eta_feature_vector(lk: Lake) -> DataFrame:
    """The assembled model input of every shipment, one column per slot; a route that
    no training trip has is all zeros."""
    from pyspark.ml.functions import vector_to_array
    from waymark.operators import model as mdl
    known = lk.training.select("route_id").distinct()
    prep = mdl.feature_pipeline().fit(known.select("route_id", *[F.lit(0.0).alias(c) for c in eta.NUMERIC]))
    levels = prep.stages[0].labels           # one per route of the network
    x = vector_to_array(F.col("features"))
    slots = [*eta.NUMERIC, *[f"route_{i + 1}" for i in range(len(levels))]]
    return prep.transform(lk.features.drop("event_time")).select(
        "shipment_id", *[F.get(x, F.lit(i)).alias(c) for i, c in enumerate(slots)])


@query("psi_empty_live")
def _psi_empty_live(lk: Lake) -> DataFrame:
    """Drift against a live window that nothing was scored in."""
    drift, ref, cuts, counts = _traffic(lk)
    none = lk.scored_requests().where(F.col("dist_remaining_km") < 0)
    r = drift.report(drift.psi(drift.histogram(ref, none, settings=lk.settings, cuts=cuts, counts=counts)), lk.settings)
    return r.select("max_psi", "alert", "features_checked", "recommendation")


@query("regression_metrics_constant")
def _regression_metrics_constant(lk: Lake) -> DataFrame:
    """Metrics on a constant label: no R2, no abort."""
    t = lk.training.withColumn(eta.TARGET, F.lit(100000000.0)) \
        .withColumn("pred", F.lit(100000000.0) + F.col("is_stopped"))
    return eta.regression_metrics(t, "pred")


@query("feature_importance")
def _feature_importance(lk: Lake) -> DataFrame:
    from waymark.operators import model as mdl
    return mdl.permutation_importance(lk.model(), mdl.split(lk.training)[1])


# ------------------------------------------------------------------ drift

def _traffic(lk: Lake):
    from waymark.operators import drift
    ref = lk.training
    counts = drift.reference_counts(ref)
    return drift, ref, drift.cut_points(ref, settings=lk.settings, counts=counts), counts


@query("psi_cuts")
def _psi_cuts(lk: Lake) -> DataFrame:
    drift, ref, cuts, counts = _traffic(lk)
    pe = F.posexplode("cuts").alias("cut", "value")
    out = cuts.select("feature", pe)
    return out.select("feature", F.col("cut").cast("int").alias("cut"),
                      F.when(F.abs("value") == F.lit(float("inf")), F.col("value"))
                       .otherwise(F.round("value", 6)).alias("value"))


@query("psi_histogram")
def _psi_histogram(lk: Lake) -> DataFrame:
    drift, ref, cuts, counts = _traffic(lk)
    return drift.histogram(ref, lk.scored_requests(), settings=lk.settings, cuts=cuts, counts=counts)


def _psi_all(lk: Lake) -> DataFrame:
    """PSI of the live traffic and of the shifted traffic against one
    reference, counted in a single pass."""
    drift, ref, cuts, counts = _traffic(lk)
    both = eta.request_features(eta.traffic_from_pings(lk.silver), lk.settings)
    return drift.psi(drift.histograms(ref, both, settings=lk.settings, cuts=cuts, counts=counts))


@query("psi")
def _psi(lk: Lake) -> DataFrame:
    from waymark.operators import drift
    p = _psi_all(lk)
    return p.select("traffic", "feature", F.round("psi", 6).alias("psi"),
                    drift.classify(F.col("psi"), lk.settings).alias("status"))


@query("drift_report")
def _drift_report(lk: Lake) -> DataFrame:
    from waymark.operators import drift
    r = drift.report(_psi_all(lk), lk.settings, by=["traffic"])
    return r.select("traffic", F.round("max_psi", 6).alias("max_psi"), "alert",
                    "features_checked", "recommendation")


@query("method_mix")
def _method_mix(lk: Lake) -> DataFrame:
    """Scores the requests without a model, as before the first training, and then those
    of moving shipments with it, appends both to the JSON-lines prediction log in the
    shared checkpoint folder, reads the log back and counts by method."""
    from waymark.session import scratch_path
    from waymark.sources import tables
    path = scratch_path(lk.spark, "prediction-log")
    tables.append_predictions(lk.scored_requests(), path)
    tables.append_predictions(lk.scored_requests(model=lk.model()).where("is_stopped = 0"), path)
    log = tables.read_predictions(lk.spark, path)
    return log.groupBy("method").agg(F.count(F.lit(1)).alias("predictions"))


# ------------------------------------------------------------------ streaming

def _stream_run(lk: Lake, name: str, df: DataFrame) -> DataFrame:
    """Run a streaming job to completion (availableNow) into a fresh table in
    the shared checkpoint folder and return a batch scan of its output."""
    from waymark.session import scratch_path
    from waymark.streaming import jobs
    target = jobs.StreamTarget(path=scratch_path(lk.spark, f"{name}-out"),
                               checkpoint=scratch_path(lk.spark, f"{name}-ckpt"))
    jobs.run(df, target, available_now=True, query_name=None)
    return lk.spark.read.schema(df.schema).parquet(target.path)


@query("stream_bronze")
def _stream_bronze(lk: Lake) -> DataFrame:
    """Envelope files -> Bronze stream (ingest_time dropped from the output)."""
    from waymark.session import scratch_path
    from waymark.streaming import jobs
    src = scratch_path(lk.spark, "envelopes")
    envelope.publish(lk.envelopes, path=src, mode="overwrite")
    raw = jobs.file_stream(lk.spark, src, envelope.ENVELOPE_SCHEMA, max_files_per_trigger=16)
    out = _stream_run(lk, "bronze", jobs.bronze_stream(raw))
    return out.drop("ingest_time")


@query("stream_silver")
def _stream_silver(lk: Lake) -> DataFrame:
    """Bronze table as a file stream -> Silver stream (watermark + dedup within
    the watermark + enrichment)."""
    from waymark.sources import recipe
    from waymark.streaming import jobs
    bronze = jobs.file_stream(lk.spark, lk.table_path("bronze_pings"), lk.pings.schema)
    s = jobs.silver_stream(bronze.select("event_id", *recipe.PING_COLUMNS), lk.route_arrays,
                           lk.facilities, lk.settings)
    return _stream_run(lk, "silver", s)


@query("stream_silver_late")
def _stream_silver_late(lk: Lake) -> DataFrame:
    """Bronze and Silver as chained streams over four batches of arrivals (``recipe.arrival_batch``),
    some of them late by one batch or two.  Events come minutes apart, so this replay's
    watermark is a day: rows that are later are dropped, others and their re-deliveries absorbed."""
    from dataclasses import replace
    from waymark.session import scratch_path
    from waymark.sources import recipe
    from waymark.streaming import jobs
    pings = lk.pings.withColumn("arrival", recipe.arrival_batch())
    batches = (envelope.keyed_envelope(pings.where(F.col("arrival") == b)) for b in range(recipe.ARRIVALS))
    bronze, silver = (jobs.StreamTarget(scratch_path(lk.spark, f"late-{n}-out"), scratch_path(lk.spark, f"late-{n}-ckpt"))
                      for n in ("bronze", "silver"))
    jobs.replay(batches, scratch_path(lk.spark, "late-envelopes"), bronze, silver, lk.route_arrays, lk.facilities,
                replace(lk.settings, watermark=recipe.LATE_WATERMARK))
    return lk.spark.read.parquet(silver.path).select(
        *recipe.PING_COLUMNS, "progress_pct", "is_moving", "dist_to_route_km", "at_facility")


@query("stream_current_state")
def _stream_current_state(lk: Lake) -> DataFrame:
    """Silver as a file stream merged batch by batch into the current-state table; its
    latest row of each shipment."""
    from waymark.session import scratch_path
    from waymark.streaming import jobs, state
    path = scratch_path(lk.spark, "state")
    src = jobs.file_stream(lk.spark, lk.table_path("silver"), lk.silver.schema, max_files_per_trigger=4)
    state.run(src, path, scratch_path(lk.spark, "state-ckpt"), settings=lk.settings)
    return fleet.latest_state(state.read(lk.spark, path))


@query("stream_status")
def _stream_status(lk: Lake) -> DataFrame:
    from waymark.streaming import jobs
    src = jobs.file_stream(lk.spark, lk.table_path("silver"), lk.silver.schema, max_files_per_trigger=4)
    return _stream_run(lk, "status", jobs.status_stream(src, lk.settings))


@query("stream_exceptions")
def _stream_exceptions(lk: Lake) -> DataFrame:
    """Windowed exceptions as a stream: only windows closed by the watermark
    are emitted (append mode)."""
    from waymark.streaming import jobs
    src = jobs.file_stream(lk.spark, lk.table_path("silver"), lk.silver.schema)
    return _stream_run(lk, "exceptions", jobs.exceptions_stream(src, lk.settings))
