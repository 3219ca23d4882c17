"""Structured Streaming: late / too-late / duplicate pings, restart from the
checkpoint, bounded dedup state, and closed-window emission."""
import os
import time

import pytest
from pyspark.sql import functions as F

from waymark.session import scratch_path
from waymark.streaming import jobs


@pytest.fixture(scope="module")
def pings6(spark):
    """20 shipments x 50 rounds of 6 s on the first route; every 50th event is delivered twice."""
    eid = F.col("event_id")
    p = spark.range(1000).withColumnRenamed("id", "event_id").select(
        eid, F.concat(F.lit("SHP-"), eid % 20).alias("shipment_id"), F.lit("VEH").alias("vehicle_id"),
        F.lit("R-SIN-JHB").alias("route_id"), F.lit(1.283).alias("lat"), F.lit(103.851).alias("lon"),
        F.lit(40.0).alias("speed_kmh"), F.lit(0.0).alias("heading"), F.lit(1.0).alias("dist_km"),
        F.lit(20.0).alias("total_km"), (F.floor(eid / 20) + 1).cast("bigint").alias("seq"),
        F.timestamp_seconds(F.lit(1704067200) + F.floor(eid / 20) * 6).alias("event_time"))
    return p.unionByName(p.where("event_id % 50 = 7"))


def _arrival_files(spark, valid, rounds_per_file=10):
    """Pings, one parquet file per 10 arrival rounds, written in arrival order.
    Late: id % 10 == 3 arrives 1-3 rounds later; too late: id % 1000 == 77 (event time
    18 s) arrives 60 rounds (6 min) later, after the watermark has passed it."""
    rows = valid.withColumn("r", F.col("seq") - 1)
    eid = F.col("event_id")
    arrival = (F.when(eid % 1000 == 77, F.col("r") + 60)
                .when(eid % 10 == 3, F.col("r") + 1 + eid % 3)
                .otherwise(F.col("r")))
    rows = rows.withColumn("f", F.floor(arrival / rounds_per_file)).cache()
    src = scratch_path(spark, "arrivals")
    files = sorted(r.f for r in rows.select("f").distinct().collect())
    for f in files:
        (rows.where(F.col("f") == f).drop("r", "f").coalesce(1)
             .write.mode("append").parquet(src))
        time.sleep(0.02)
    rows.unpersist()
    return src, len(files)


@pytest.fixture(scope="module")
def arrivals(spark, pings6):
    src, n = _arrival_files(spark, pings6)
    return src, n, pings6.schema


def test_stream_silver_drops_duplicates_and_too_late(spark, lake001, pings6, arrivals):
    src, n_files, schema = arrivals
    stream = jobs.file_stream(spark, src, schema, max_files_per_trigger=1)
    s = jobs.silver_stream(stream, lake001.route_arrays, lake001.facilities)
    target = jobs.StreamTarget(scratch_path(spark, "s-out"), scratch_path(spark, "s-ckpt"))
    q = jobs.run(s, target)
    out = spark.read.parquet(target.path)
    assert out.count() == 1000 - 1                     # event 77 arrived 6 min late
    assert out.where("event_id % 1000 = 77").count() == 0
    assert out.groupBy("shipment_id", "seq").count().where("count > 1").count() == 0
    late = pings6.where("event_id % 10 = 3 AND event_id % 1000 != 77").select("event_id").distinct()
    assert out.join(late, "event_id").count() == late.count()   # 6-18 s late: kept
    assert jobs.last_progress_metric(q, "numRowsDroppedByWatermark") >= 1


def test_restart_reads_only_new_files(spark, pings6):
    rows = pings6
    src = scratch_path(spark, "restart-src")
    rows.where("seq <= 25").coalesce(1).write.mode("append").parquet(src)
    target = jobs.StreamTarget(scratch_path(spark, "r-out"), scratch_path(spark, "r-ckpt"))
    s = jobs.status_stream
    def start():
        st = jobs.file_stream(spark, src, rows.schema)
        return jobs.run(st.select("event_id", "shipment_id", "seq"), target)
    start()
    first = spark.read.parquet(target.path).count()
    time.sleep(0.05)
    rows.where("seq > 25").coalesce(1).write.mode("append").parquet(src)
    q = start()
    total = spark.read.parquet(target.path).count()
    assert first == rows.where("seq <= 25").count()
    assert total == rows.count()                      # nothing read twice
    assert sum(p["numInputRows"] for p in q.recentProgress) == rows.count() - first


def test_within_watermark_dedup_state_is_bounded(spark, arrivals):
    src, n_files, schema = arrivals
    def state_rows(within: bool):
        st = jobs.file_stream(spark, src, schema, max_files_per_trigger=1)
        st = st.withWatermark("event_time", "2 minutes")
        d = (st.dropDuplicatesWithinWatermark(["shipment_id", "seq"]) if within
             else st.dropDuplicates(["shipment_id", "seq"]))
        t = jobs.StreamTarget(scratch_path(spark, "d-out"), scratch_path(spark, "d-ckpt"))
        q = jobs.run(d, t)
        last = [p for p in q.recentProgress if p["stateOperators"]][-1]
        return last["stateOperators"][0]["numRowsTotal"], spark.read.parquet(t.path).count()
    within_state, within_rows = state_rows(True)
    plain_state, plain_rows = state_rows(False)
    assert within_rows == plain_rows == 999
    assert plain_state == 999                    # every key kept forever
    # Keys expire once the watermark passes event_time + 2 min; the fixture
    # spans 5 minutes, so roughly the first fifth has been evicted.
    assert within_state < plain_state * 0.9


def test_stream_exceptions_emit_closed_windows_only(spark, lake001):
    from waymark.operators import gold
    path = lake001.table_path("silver")
    st = jobs.file_stream(spark, path, lake001.silver.schema)
    t = jobs.StreamTarget(scratch_path(spark, "e-out"), scratch_path(spark, "e-ckpt"))
    jobs.run(jobs.exceptions_stream(st), t)
    out = spark.read.parquet(t.path)
    expected = gold.closed_windows(lake001.exceptions, lake001.silver)
    assert out.count() == expected.count() > 100
    assert out.exceptAll(expected.select(*out.columns)).count() == 0


def test_producer_restart_reusing_ids_survives(spark):
    """A producer restart reuses (shipment_id, seq) an hour later.  Within-
    watermark dedup keeps the new pings once the old keys expired; plain
    dropDuplicates keeps every key forever and drops them."""
    from datetime import datetime, timedelta
    t0 = datetime(2024, 1, 1)
    def rows(sid, seqs, base):
        return [(sid, s, base + timedelta(seconds=6 * s)) for s in seqs]
    files = [rows("SHP-A", range(1, 11), t0),
             rows("SHP-B", range(1, 6), t0 + timedelta(hours=1)),
             rows("SHP-B", range(6, 11), t0 + timedelta(hours=1)),
             rows("SHP-A", range(1, 11), t0 + timedelta(hours=1, minutes=2))]
    src = scratch_path(spark, "restart-ids")
    for f in files:
        spark.createDataFrame(f, "shipment_id string, seq bigint, event_time timestamp") \
             .coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)
    schema = "shipment_id string, seq bigint, event_time timestamp"
    def run(within: bool) -> int:
        st = jobs.file_stream(spark, src, schema, max_files_per_trigger=1)
        st = st.withWatermark("event_time", "2 minutes")
        d = (st.dropDuplicatesWithinWatermark(["shipment_id", "seq"]) if within
             else st.dropDuplicates(["shipment_id", "seq"]))
        t = jobs.StreamTarget(scratch_path(spark, "ri-out"), scratch_path(spark, "ri-ckpt"))
        jobs.run(d, t)
        return spark.read.parquet(t.path).count()
    assert run(True) == 30
    assert run(False) == 20


def test_two_jobs_in_one_session(spark, lake001):
    """Status and exceptions run side by side; await_any returns when one of them stops."""
    path = lake001.table_path("silver")
    spark.streams.resetTerminated()                    # earlier queries of the session don't count
    qs = []
    for name, f in (("status", jobs.status_stream), ("exceptions", jobs.exceptions_stream)):
        st = jobs.file_stream(spark, path, lake001.silver.schema)
        t = jobs.StreamTarget(scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt"))
        qs.append(jobs.run(f(st), t, query_name=f"two_{name}", wait=False))
    jobs.await_any(spark, 120)
    assert any(not q.isActive for q in qs)
    for q in qs:
        q.awaitTermination(120)
        assert q.exception() is None
    spark.streams.resetTerminated()
