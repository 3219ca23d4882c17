"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it.  A local folder is created only when the
session runs in local mode and no checkpoint folder is configured.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "waymark", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Event-time features (hour, weekday) and window bounds are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (set one only in local mode)."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: streams and lineage cuts need a "
                "folder every executor can reach")
        base = tempfile.mkdtemp(prefix="waymark-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)         # for DataFrame.checkpoint
        base = sc.getCheckpointDir() or base
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused name below the checkpoint root; Spark's writers create it."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application (what ``--py-files`` does)."""
    sc = spark.sparkContext
    if getattr(sc, "_waymark_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="waymark-py-"), "waymark_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(archive)
    sc._waymark_shipped = True
