"""Structured Streaming jobs of the medallion chain.

Each job is a stream-to-table writer with its own checkpoint, built from the
same ``DataFrame -> DataFrame`` operators as the batch path:

* Bronze: envelope stream -> decoded rows (append)
* Silver: Bronze stream -> validate -> watermark -> dedup within watermark
  -> enrich (append; stream-static broadcast join for the route geometry)
* Gold status: Silver stream -> per-ping status events (stateless append)
* Gold exceptions: Silver stream -> watermark -> 30 s windows per shipment
  (stateful; append emits a window once the watermark passes its end)

``run`` starts a job with ``trigger(availableNow=True)`` (process what is
there, then stop) or a processing-time trigger for a long-running service.
A restarted job resumes from its checkpoint and reads only new files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from waymark.config import DEFAULT, Settings
from waymark.operators import gold, silver as silver_ops
from waymark.sources import envelope


@dataclass
class StreamTarget:
    path: str
    checkpoint: str
    fmt: str = "parquet"


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def bronze_stream(raw: DataFrame) -> DataFrame:
    """Envelope stream -> Bronze rows (JSON expanded, Kafka metadata kept,
    ingest_time stamped per micro-batch)."""
    return envelope.decode_envelope(raw, with_ingest_time=True)


def silver_stream(bronze: DataFrame, route_segments: DataFrame, facilities: DataFrame,
                  settings: Settings = DEFAULT) -> DataFrame:
    """The Silver job on a stream: dedup state is bounded by the watermark."""
    return silver_ops.silver(bronze, route_segments, facilities, settings)


def status_stream(silver: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return gold.status_events(silver, settings)


def exceptions_stream(silver: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return gold.window_exceptions(silver_ops.with_watermark(silver, settings), settings)


def run(df: DataFrame, target: StreamTarget, *, available_now: bool = True,
        processing_time: str | None = None, query_name: str | None = None,
        wait: bool = True) -> StreamingQuery:
    """Start an append-mode file sink with a checkpoint; wait for it when
    ``available_now``."""
    w = (df.writeStream.format(target.fmt).outputMode("append")
         .option("checkpointLocation", target.checkpoint).option("path", target.path))
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    q = w.start()
    return finished(q) if wait and available_now else q


def finished(q: StreamingQuery) -> StreamingQuery:
    """Wait for a query that stops by itself; raise what it failed with."""
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def replay(batches, source: str, bronze: StreamTarget, silver: StreamTarget, route_segments: DataFrame,
           facilities: DataFrame, settings: Settings = DEFAULT) -> None:
    """Play envelope batches (DataFrames, in order of arrival) through the chained streams:
    each is published to ``source``, then the Bronze stream reads what is new and the Silver
    stream reads what Bronze wrote.  Every step restarts both from their checkpoints.  A
    run ends with the watermark at the latest valid event time so far less the delay, so a
    later batch's rows at or before that are dropped."""
    for b in batches:
        spark = b.sparkSession
        envelope.publish(b, path=source)
        run(bronze_stream(file_stream(spark, source, envelope.ENVELOPE_SCHEMA)), bronze)
        decoded = spark.read.parquet(bronze.path).schema
        run(silver_stream(file_stream(spark, bronze.path, decoded), route_segments, facilities, settings), silver)


def await_any(spark: SparkSession, timeout_s: float | None = None) -> None:
    """Block until any running query of the session stops (several jobs per
    session, one process)."""
    spark.streams.awaitAnyTermination(timeout_s)


def last_progress_metric(q: StreamingQuery, name: str) -> int:
    """Sum of a state-operator metric (e.g. numRowsDroppedByWatermark) over all
    progress reports of the query."""
    total = 0
    for p in q.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            v = op.get(name) if isinstance(op, dict) else getattr(op, name, 0)
            total += int(v or 0)
    return total
