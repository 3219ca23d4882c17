"""The evolving append sink, the current-state table and the late-arrival replay."""
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from waymark.operators import eta, fleet
from waymark.session import scratch_path
from waymark.sources import commits
from waymark.streaming import jobs, sink, state

T0 = datetime(2024, 1, 1)


# ------------------------------------------------------------------ commit records

def test_create_once(spark, tmp_path):
    assert commits.create_once(spark, f"{tmp_path}/claims/v1")
    assert not commits.create_once(spark, f"file://{tmp_path}/claims/v1")
    assert commits.names(spark, f"{tmp_path}/claims") == ["v1"]
    assert commits.names(spark, f"{tmp_path}/absent") == []


def test_records_are_whole(spark, tmp_path):
    folder = f"{tmp_path}/records"
    commits.write_record(spark, folder, "a", {"x": 1})
    commits.write_record(spark, folder, "b", {"y": "é"})
    assert commits.names(spark, folder) == ["a", "b"]
    assert commits.read_record(spark, folder, "b") == {"y": "é"}
    assert commits.writer_id(spark, f"{tmp_path}/ck") == commits.writer_id(spark, f"{tmp_path}/ck")
    assert commits.writer_id(spark, f"{tmp_path}/ck") != commits.writer_id(spark, f"{tmp_path}/ck2")


# ------------------------------------------------------------------ evolving sink

def test_new_column_is_null_before_and_filled_after(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert sink.read(spark, path) is None
    sink.append_batch(spark.createDataFrame([(1, "a")], "id bigint, name string"), path, "w", 0)
    sink.append_batch(spark.createDataFrame([(2, "b", 2.5)], "id int, name string, speed double"), path, "w", 1)
    sink.append_batch(spark.createDataFrame([(3,)], "id bigint"), path, "w", 2)
    got = sink.read(spark, path)
    assert got.dtypes == [("id", "bigint"), ("name", "string"), ("speed", "double")]
    assert {tuple(r) for r in got.collect()} == {(1, "a", None), (2, "b", 2.5), (3, None, None)}
    with pytest.raises(ValueError, match="doesn't fit"):
        sink.append_batch(spark.createDataFrame([("x",)], "id string"), path, "w", 3)
    with pytest.raises(ValueError, match="doesn't fit"):
        sink.append_batch(spark.createDataFrame([(1.5,)], "id double"), path, "w", 3)
    assert sink.read(spark, path).count() == 3


def test_replayed_batches_add_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(1,), (2,)], "id bigint")
    assert sink.append_batch(rows, path, "w", 0)
    assert not sink.append_batch(rows, path, "w", 0)            # crash after the record, before the checkpoint
    def lost(*a):
        raise OSError("lost")
    with monkeypatch.context() as m:                            # crash between the write and the record
        m.setattr(commits, "write_record", lost)
        with pytest.raises(OSError):
            sink.append_batch(spark.createDataFrame([(3,), (4,)], "id bigint"), path, "w", 1)
    assert sorted(r.id for r in sink.read(spark, path).collect()) == [1, 2]     # uncommitted rows aren't seen
    assert sink.append_batch(spark.createDataFrame([(3,), (4,)], "id bigint"), path, "w", 1)
    assert sink.append_batch(rows, path, "other", 0)            # another stream counts its own batches
    assert sorted(r.id for r in sink.read(spark, path).collect()) == [1, 1, 2, 2, 3, 4]


def test_stream_with_a_column_added_midway(spark, tmp_path, monkeypatch):
    """A stream into the sink, restarted with one more column, and once killed before its checkpoint."""
    src, path, ck = (f"{tmp_path}/{x}" for x in ("src", "t", "ck"))
    spark.createDataFrame([(1, 10.0)], "seq bigint, lat double").write.mode("append").parquet(src)
    old = "seq bigint, lat double"
    sink.run(jobs.file_stream(spark, src, old), path, ck)
    new = "seq bigint, lat double, heading double"
    spark.createDataFrame([(2, 11.0, 90.0)], new).write.mode("append").parquet(src)
    real = sink.append_batch

    def killed(*a):
        real(*a)
        raise RuntimeError("killed after the commit")
    with monkeypatch.context() as m:
        m.setattr(sink, "append_batch", killed)
        with pytest.raises(Exception, match="killed"):
            sink.run(jobs.file_stream(spark, src, new), path, ck)
    sink.run(jobs.file_stream(spark, src, new), path, ck)       # the same batch once more
    assert {tuple(r) for r in sink.read(spark, path).collect()} == {(1, 10.0, None), (2, 11.0, 90.0)}


# ------------------------------------------------------------------ current state

def _silver(spark, n, seed, hot=False):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        ship = "SHP-HOT" if hot and i % 3 else f"SHP-{rng.randint(1, 12):03d}"
        t = None if rng.random() < .03 else T0 + timedelta(minutes=rng.randint(0, 400))
        data.append((ship, i, f"R-{rng.randint(1, 3)}", 1.3, 103.8, rng.choice([None, 0.0, 10.0, 33.3]), rng.random() * 100,
                     rng.choice([None, 0.4, 2.0]), rng.choice([None, "Yard"]), rng.random() * 20, 25.0, t))
    return spark.createDataFrame(data, "shipment_id string, seq bigint, route_id string, lat double, lon double, speed_kmh double, "
                                 "progress_pct double, dist_to_route_km double, at_facility string, dist_km double, total_km double, "
                                 "event_time timestamp")


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_state_equals_the_whole_history(spark, tmp_path):
    """Late rows (times are random over all batches), repeated rows, rows without a time."""
    path = f"{tmp_path}/state"
    whole = _silver(spark, 400, 1).union(_silver(spark, 400, 1).limit(40)).cache()
    assert state.read(spark, path) is None
    for b in range(5):
        part = whole.where(F.col("seq") % 5 == b)
        assert state.merge_batch(part, path, "w", b, buckets=4)
        assert not state.merge_batch(part, path, "w", b, buckets=4)     # replayed
    got = state.read(spark, path)
    assert _rows(fleet.latest_state(got)) == _rows(fleet.latest_state(whole))
    assert _rows(eta.shipment_features(got)) == _rows(eta.shipment_features(whole))
    for ship in ("SHP-001", "SHP-007", "nobody"):
        one = eta.shipment_eta(state.read(spark, path, ship), ship)
        assert _rows(one) == _rows(eta.shipment_eta(whole, ship))
    assert got.groupBy("shipment_id").count().agg(F.max("count")).first()[0] == 5
    with pytest.raises(ValueError, match="buckets"):
        state.merge_batch(whole, path, "w", 9, buckets=8)


def test_one_shipment_reads_one_bucket(spark, tmp_path):
    path = f"{tmp_path}/state"
    state.merge_batch(_silver(spark, 300, 2), path, "w", 0, buckets=8)
    one = state.read(spark, path, "SHP-003")
    assert len({f.rsplit("/", 1)[0] for f in one.inputFiles()}) == 1
    assert len({f.rsplit("/", 1)[0] for f in state.read(spark, path).inputFiles()}) > 3
    plan = eta.shipment_eta(one, "SHP-003")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(shipment_id,SHP-003)" in plan               # pushed to that bucket's files


def test_a_batch_rewrites_only_its_buckets_and_a_crash_leaves_the_table(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/state"
    state.merge_batch(_silver(spark, 300, 3), path, "w", 0, buckets=8)
    before = commits.read_record(spark, f"{path}/commits", commits.names(spark, f"{path}/commits")[-1])
    part = _silver(spark, 300, 4).where("shipment_id = 'SHP-005'")
    def lost(*a):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(commits, "write_record", lost)
        with pytest.raises(OSError):
            state.merge_batch(part, path, "w", 1, buckets=8)
    assert _rows(state.read(spark, path)) == _rows(state.last_rows(_silver(spark, 300, 3).select(*state.COLUMNS), 5))
    assert state.merge_batch(part, path, "w", 1, buckets=8)
    after = commits.read_record(spark, f"{path}/commits", commits.names(spark, f"{path}/commits")[-1])
    assert sum(after["buckets"][b] != v for b, v in before["buckets"].items()) == 1
    assert state.vacuum(spark, path, keep=1) == 0               # both versions are still named
    state.merge_batch(_silver(spark, 300, 5), path, "w", 2, buckets=8)
    whole = _rows(state.read(spark, path))
    assert state.vacuum(spark, path, keep=1) >= 1
    assert _rows(state.read(spark, path)) == whole
    assert state.merge_batch(spark.createDataFrame([], _silver(spark, 1, 1).schema), path, "w", 3, buckets=8)
    assert _rows(state.read(spark, path)) == whole              # an empty batch


def test_a_hot_shipment_sends_a_few_rows_a_task(spark):
    plan = state.last_rows(_silver(spark, 50, 6, hot=True).repartition(4), 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2                  # before and after the shuffle


def test_state_stream(spark, tmp_path):
    src, path, ck = (f"{tmp_path}/{x}" for x in ("src", "state", "ck"))
    whole = _silver(spark, 300, 7, hot=True)
    for b in range(3):
        whole.where(F.col("seq") % 3 == b).coalesce(1).write.mode("append").parquet(src)
        if b != 1:                                              # two files in the second run
            state.run(jobs.file_stream(spark, src, whole.schema, max_files_per_trigger=1), path, ck, buckets=4)
    assert _rows(fleet.latest_state(state.read(spark, path))) == _rows(fleet.latest_state(whole))
    assert _rows(eta.shipment_features(state.read(spark, path))) == _rows(eta.shipment_features(whole))


# ------------------------------------------------------------------ late arrivals

def test_replay_drops_what_the_watermark_passed(spark, lake001):
    """By hand: times in minutes, watermark 2 minutes.  The second batch's rows at or before
    the first one's latest time less two minutes go, later ones and re-deliveries are absorbed."""
    from waymark.sources import envelope
    def batch(rows):
        df = spark.createDataFrame([(i, 0, "S", "V", "R-SIN-JHB", 1.3, 103.8, float(sp), 0.0, 1.0, 20.0, seq, T0 + timedelta(minutes=m))
                                    for i, (seq, m, sp) in enumerate(rows)],
                                   "event_id bigint, copy int, shipment_id string, vehicle_id string, route_id string, lat double, "
                                   "lon double, speed_kmh double, heading double, dist_km double, total_km double, seq bigint, event_time timestamp")
        return envelope.keyed_envelope(df.coalesce(1))
    batches = [batch([(1, 0, 1), (2, 10, 1), (3, 20, 1)]),
               batch([(3, 20, 9), (4, 18, 1), (5, 18.5, 1), (6, 17, 1), (7, 30, 1)]),      # 3 again; 4 at the mark; 6 past it
               batch([(8, 27, 1), (9, 29, 1)])]
    b, s = (jobs.StreamTarget(scratch_path(spark, f"hand-{n}"), scratch_path(spark, f"hand-{n}-ck")) for n in "bs")
    jobs.replay(batches, scratch_path(spark, "hand-src"), b, s, lake001.route_arrays, lake001.facilities)
    assert {(r.seq, r.speed_kmh) for r in spark.read.parquet(s.path).collect()} == {
        (1, 1.0), (2, 1.0), (3, 1.0), (5, 1.0), (7, 1.0), (9, 1.0)}
    assert spark.read.parquet(b.path).count() == 10              # Bronze keeps everything
