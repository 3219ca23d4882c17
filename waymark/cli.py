"""Command line: the pipeline's jobs as Spark applications.

    python -m waymark bronze     --source ENVELOPES --out BRONZE --checkpoint CKPT [--once]
    python -m waymark silver     --bronze BRONZE --out SILVER --checkpoint CKPT [--once]
    python -m waymark gold       --silver SILVER --status STATUS --exceptions EXC --checkpoint CKPT [--once]
    python -m waymark state      --silver SILVER --state STATE --checkpoint CKPT [--once]
    python -m waymark query-bronze --bronze BRONZE
    python -m waymark query-gold --silver SILVER --status STATUS --exceptions EXC
    python -m waymark training   --silver SILVER --out TRAINING
    python -m waymark train      --training TRAINING --registry REG [--max-iter N --max-depth N]
    python -m waymark retrain    --training TRAINING --registry REG [--max-iter N --max-depth N]
    python -m waymark score      --requests REQUESTS.json --registry REG --log LOG [--rejects PATH]
    python -m waymark eta        --silver SILVER | --state STATE --shipment ID [--log LOG --registry REG]
    python -m waymark drift      --training TRAINING --log LOG
    python -m waymark board      --silver SILVER [--registry REG --out PATH --status STATUS --exceptions EXC]

``state`` keeps the table of current rows that ``eta --state`` reads one bucket of, instead of
the shipment's history in Silver.  A prediction is logged where ``--log`` says so; without it
``eta`` only shows it.  Rejected requests and the board are written whole (``--rejects``, default LOG-rejects;
``--out``); what is shown is only an extract.  Streams take at most ``--max-files`` files
or ``--max-offsets`` Kafka offsets a batch, so the watermark moves while a backlog is read.

Streaming jobs run continuously (processing-time trigger) unless ``--once``
(availableNow).  ``--bootstrap/--topic`` make the Bronze source Kafka.
``--format delta`` needs the Delta jars on the classpath.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from waymark.config import DEFAULT
from waymark.session import use_utc
from waymark.sources.tables import read_table


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _session(args) -> SparkSession:
    b = SparkSession.builder.appName(f"waymark-{args.cmd}")
    if args.master:
        b = b.master(args.master)
    spark = b.getOrCreate()
    use_utc(spark)
    if args.cmd in ("silver", "gold") and args.state_store == "rocksdb":
        # Dedup keys and open windows live in the state store; RocksDB keeps
        # them off the JVM heap.  The provider is recorded in a new checkpoint.
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def _dims(spark):
    from waymark.sources import network
    seg = network.cached_dimension(network.segments(network.waypoints(spark)))
    return network.route_segment_arrays(seg), network.facilities(spark)


def _run(df, path, ckpt, once, fmt, name):
    from waymark.streaming import jobs
    return jobs.run(df, jobs.StreamTarget(path, ckpt, fmt), available_now=once,
                    processing_time=None if once else "2 seconds", query_name=name,
                    wait=once)


def cmd_bronze(spark, a):
    from waymark.sources import envelope
    from waymark.streaming import jobs
    raw = envelope.read_envelopes(spark, a.source, streaming=True, bootstrap=a.bootstrap, topic=a.topic,
                                  max_files_per_trigger=a.max_files, max_offsets_per_trigger=a.max_offsets)
    q = _run(jobs.bronze_stream(raw), a.out, a.checkpoint, a.once, a.format, "bronze")
    if not a.once:
        q.awaitTermination()


def cmd_silver(spark, a):
    from waymark.streaming import jobs
    schema = read_table(spark, a.bronze, a.format).schema
    src = jobs.file_stream(spark, a.bronze, schema, a.format, a.max_files)
    arrays, fac = _dims(spark)
    q = _run(jobs.silver_stream(src, arrays, fac), a.out, a.checkpoint, a.once, a.format, "silver")
    if not a.once:
        q.awaitTermination()


def cmd_gold(spark, a):
    from waymark.streaming import jobs
    schema = read_table(spark, a.silver, a.format).schema
    src = lambda: jobs.file_stream(spark, a.silver, schema, a.format, a.max_files)
    _run(jobs.status_stream(src()), a.status, f"{a.checkpoint}/status", a.once, a.format, "gold_status")
    _run(jobs.exceptions_stream(src()), a.exceptions, f"{a.checkpoint}/exceptions", a.once,
         a.format, "gold_exceptions")
    if not a.once:
        jobs.await_any(spark)


def cmd_state(spark, a):
    from waymark.streaming import jobs, state
    schema = read_table(spark, a.silver, a.format).schema
    q = state.run(jobs.file_stream(spark, a.silver, schema, a.format, a.max_files), a.state, a.checkpoint,
                  available_now=a.once)
    if not a.once:
        q.awaitTermination()


def cmd_query_bronze(spark, a):
    from waymark.operators import reports
    b = read_table(spark, a.bronze, a.format)
    reports.bronze_summary(b).show(truncate=False)
    reports.pings_per_route(b).show(truncate=False)
    reports.bronze_sample(b).show(truncate=False)


def cmd_query_gold(spark, a):
    from waymark.operators import reports
    from waymark.sources.tables import read_table_or_none
    s = read_table_or_none(spark, a.silver, a.format)
    if s is not None:
        reports.silver_summary(s).show(truncate=False)
        reports.silver_sample(s).show(truncate=False)
    st = read_table_or_none(spark, a.status, a.format)
    if st is not None:
        reports.events_by_type(st).show(truncate=False)
        reports.status_sample(st).show(truncate=False)
    ex = read_table_or_none(spark, a.exceptions, a.format)
    if ex is not None:
        reports.events_by_type(ex).show(truncate=False)
        reports.exceptions_sample(ex).show(truncate=False)


def cmd_training(spark, a):
    from waymark.operators import eta
    t = eta.training_set(read_table(spark, a.silver, a.format))
    t.write.mode("overwrite").parquet(a.out)
    eta.label_summary(spark.read.parquet(a.out)).show(truncate=False)


def _params(a) -> dict:
    given = {"maxIter": a.max_iter, "maxDepth": a.max_depth}
    return {k: int(v) for k, v in given.items() if v}


def cmd_train(spark, a):
    from waymark.operators import model
    print(json.dumps(model.train_and_register(spark, spark.read.parquet(a.training), a.registry, params=_params(a)),
                     default=str))


def cmd_retrain(spark, a):
    from waymark.operators import model
    model.champion_challenger(spark, spark.read.parquet(a.training), a.registry, params=_params(a)).show(truncate=False)


def _model(spark, a):
    from waymark.operators import model
    return model.resolve_version(spark, a.registry) if a.registry else (None, None)


def cmd_score(spark, a):
    from waymark.operators import eta
    from waymark.sources import tables
    req = spark.read.schema(eta.REQUEST_SCHEMA).json(a.requests)
    req = req.withColumn("as_of", F.coalesce("as_of", F.current_timestamp()))
    m, version = _model(spark, a)
    eta.reject_requests(req).write.mode("append").json(a.rejects or f"{a.log.rstrip('/')}-rejects")
    tables.append_predictions(eta.score(eta.request_features(req), m, model_version=version), a.log)
    tables.read_predictions(spark, a.log).groupBy("method", "model_version").count().show()


def cmd_eta(spark, a):
    from waymark.operators import eta
    from waymark.sources import tables
    m, version = _model(spark, a)
    if a.state:
        from waymark.streaming import state
        rows = state.read(spark, a.state, a.shipment)
        if rows is None:
            print(f"no state table at {a.state}")
            return
    else:
        rows = read_table(spark, a.silver, a.format)
    one = eta.shipment_eta(rows, a.shipment, m, model_version=version).cache()
    if one.isEmpty():
        print(f"shipment {a.shipment} not found")
        return
    if a.log:
        tables.append_predictions(one, a.log)
    one.show(truncate=False)


def cmd_drift(spark, a):
    from waymark.operators import drift
    from waymark.sources import tables
    ref = spark.read.parquet(a.training)
    live = drift.recent(tables.read_predictions(spark, a.log), since=a.since,
                        last_n=int(a.last_n) if a.last_n else None)
    p = drift.psi(drift.histogram(ref, live))
    p.withColumn("status", drift.classify(F.col("psi"))).show(truncate=False)
    live.groupBy("method", "model_version").count().show()
    drift.report(p).show(truncate=False)


def cmd_board(spark, a):
    from waymark.operators import eta, fleet
    from waymark.sources.tables import read_table_or_none
    silver = read_table(spark, a.silver, a.format)
    m, version = _model(spark, a)
    by_model = None
    if m is not None:
        feats = eta.shipment_features(silver, DEFAULT).drop("event_time")
        by_model = eta.score(feats, m, DEFAULT, version).select("shipment_id", F.col("predicted_eta_min").alias("eta_min"))
    board = fleet.board(fleet.with_status(fleet.latest_nonnull(silver), DEFAULT), DEFAULT, by_model)
    if a.out:
        board.write.mode("overwrite").parquet(a.out)
        board = spark.read.parquet(a.out)
    fleet.kpis(board).show(truncate=False)
    board.orderBy(F.col("eta_min").asc_nulls_last(), "shipment_id").show(20, truncate=False)
    feed = fleet.exception_feed(read_table_or_none(spark, a.status, a.format) if a.status else None,
                                read_table_or_none(spark, a.exceptions, a.format) if a.exceptions else None)
    if feed is not None:
        feed.show(25, truncate=False)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="waymark")
    ap.add_argument("--master", default=None)
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--state-store", default="rocksdb", choices=["rocksdb", "hdfs"],
                    help="state store provider for the stateful stream jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    def add(name, fn, *opts):
        p = sub.add_parser(name)
        for o in opts:
            p.add_argument(f"--{o.replace('_', '-')}", dest=o, default=None)
        p.add_argument("--max-files", default="1000")
        p.add_argument("--max-offsets", default="1000000")
        p.add_argument("--once", action="store_true")
        p.set_defaults(fn=fn)
    add("bronze", cmd_bronze, "source", "bootstrap", "topic", "out", "checkpoint")
    add("silver", cmd_silver, "bronze", "out", "checkpoint")
    add("state", cmd_state, "silver", "state", "checkpoint")
    add("gold", cmd_gold, "silver", "status", "exceptions", "checkpoint")
    add("query-bronze", cmd_query_bronze, "bronze")
    add("query-gold", cmd_query_gold, "silver", "status", "exceptions")
    add("training", cmd_training, "silver", "out")
    add("train", cmd_train, "training", "registry", "max_iter", "max_depth")
    add("retrain", cmd_retrain, "training", "registry", "max_iter", "max_depth")
    add("score", cmd_score, "requests", "registry", "log", "rejects")
    add("eta", cmd_eta, "silver", "state", "shipment", "registry", "log")
    add("drift", cmd_drift, "training", "log", "since", "last_n")
    add("board", cmd_board, "silver", "registry", "out", "status", "exceptions")
    a = ap.parse_args(argv)
    spark = _session(a)
    a.fn(spark, a)


if __name__ == "__main__":
    main()
