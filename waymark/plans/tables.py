"""Materialised lake tables in the shared checkpoint folder.

Bronze and Silver are tables in the medallion design: the ingest job writes
Bronze, the Silver job writes Silver, and every downstream job scans them
(parquet, with predicate pushdown and column pruning) instead of re-running
their lineage.  ``materialize`` writes a table once per session and input
version under ``spark.checkpoint.dir`` and returns a scan of it; the key
includes the input files' names, sizes and modification times, so changed inputs
are rebuilt.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.session import scratch_path

_LOCK = threading.RLock()
_TABLES: dict[tuple, str] = {}


def _input_version(spark: SparkSession, path: str) -> str:
    """Hash of the input's files (name, length, time), listed by Spark's own filesystem."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True)
    seen = []
    while files.hasNext():
        f = files.next()
        seen.append(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.sha1("\n".join(sorted(seen)).encode()).hexdigest()


def table_key(spark: SparkSession, name: str, source: str, salt: str = "") -> tuple:
    app = spark.sparkContext.applicationId
    ver = _input_version(spark, source)
    h = hashlib.sha1(f"{source}|{ver}|{salt}".encode()).hexdigest()[:12]
    return (app, name, h)


def materialize(spark: SparkSession, key: tuple, build: Callable[[], DataFrame],
                partitions: int | None = None) -> DataFrame:
    """Write ``build()`` to the shared folder once per key; return a scan.

    ``partitions`` round-robin splits the output into that many files so
    downstream scans parallelise even when the source is a single file (no
    key is used, so a hot shipment cannot skew the write).
    """
    with _LOCK:
        path = _TABLES.get(key)
        if path is None:
            path = scratch_path(spark, f"{key[1]}-{key[2]}")
            df = build()
            if partitions:
                # By event, so the deliveries of one event keep their order in one file.
                df = df.repartition(partitions, "event_id") if "event_id" in df.columns else df.repartition(partitions)
            df.write.mode("overwrite").parquet(path)
            _TABLES[key] = path
    return spark.read.parquet(path)


def saved_model(spark: SparkSession, key: tuple, build: Callable[[], object]) -> str:
    """Save ``build()`` (a fitted pipeline) once per key; return its folder."""
    with _LOCK:
        path = _TABLES.get(key)
        if path is None:
            path = scratch_path(spark, f"{key[1]}-{key[2]}")
            build().write().save(path)
            _TABLES[key] = path
    return path


def data_version(events: DataFrame) -> str:
    """The input's version in terms that SQL can compute from its rows."""
    n, ids, users = events.agg(F.count(F.lit(1)), F.coalesce(F.sum("event_id"), F.lit(0)),
                               F.coalesce(F.sum("user_id"), F.lit(0))).first()
    return f"{n}-{ids}-{users}"


def oracle_copy() -> str:
    """Where a local session leaves a model's node table for the SQL oracle, which only
    reads files by path.  A cluster session writes nothing there."""
    return f"{tempfile.gettempdir()}/waymark-ensembles-{os.getuid()}"


def path_of(key: tuple) -> str | None:
    with _LOCK:
        return _TABLES.get(key)


def forget(spark: SparkSession | None = None) -> None:
    """Drop the registry (the files stay in the checkpoint folder)."""
    with _LOCK:
        if spark is None:
            _TABLES.clear()
        else:
            app = spark.sparkContext.applicationId
            for k in [k for k in _TABLES if k[0] == app]:
                del _TABLES[k]
