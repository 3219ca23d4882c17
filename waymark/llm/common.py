"""Helpers shared by the operators: shared-folder tables and safe column handling."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prefix of the columns that operators add for their own use.
PRIVATE = "_wm_"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``.

    Only Spark's writers create it.  Without that setting a local session gets
    a temporary folder; a cluster session is refused, because a folder that
    only one machine sees cannot hold tables.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that every executor sees")
        root = tempfile.mkdtemp(prefix="waymark-llm-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application (what
    ``--py-files`` does), so that they need no copy of their own."""
    sc = spark.sparkContext
    if getattr(sc, "_waymark_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="waymark-py-"), "waymark_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(archive)
    sc._waymark_shipped = True


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and return a scan of it.

    Cuts the lineage: lost executors cost a re-read, and later stages see the
    same rows and Spark knows the table's size.
    """
    ship(df.sparkSession)
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sampled(df: DataFrame, rows: int, n: int, *key: str) -> DataFrame:
    """About ``rows`` (never more) of ``n`` rows, chosen by the hash of ``key``.  Tasks send
    on only what is chosen, however many tasks there are."""
    if n > rows:
        df = df.where(F.pmod(F.xxhash64(*key), F.lit(1 << 40)) < F.lit(int((1 << 40) * rows / n)))
    return df.limit(rows)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` less the columns an operator is about to add (its own win)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
