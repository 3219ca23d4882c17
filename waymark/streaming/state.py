"""The fleet's current state as a table that every Silver batch is merged into.

The table holds the last ``trailing_pings`` rows of each shipment, which is all that its
latest state, its trailing speed and its ETA need.  It is dealt by the hash of the shipment
into ``buckets`` folders.  A batch is first reduced to its own last rows of each shipment (a
row number that Spark limits before the shuffle, so a hot shipment sends a few rows a
task), then merged with the stored rows of the buckets it touches; only those are
written again, as a new version.  The record that commits a version names the current
version of every bucket, so readers see a whole batch or nothing, a replayed batch changes
nothing, and one shipment costs one bucket, whatever the history.

Late rows take their place by event time.  Repeated rows (one shipment, time and seq) count as
often as Silver holds them, as in ``fleet.latest_state`` and the trailing mean over Silver.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.config import DEFAULT, Settings
from waymark.operators.fleet import STATE_COLUMNS
from waymark.sources import commits

BUCKETS = 64
COLUMNS = ["shipment_id", "seq", *STATE_COLUMNS]


def bucket_of(shipment, buckets: int):
    return F.pmod(F.xxhash64(shipment), F.lit(buckets)).cast("int")


def last_rows(rows: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows of each shipment by (event_time, seq); the whole row breaks ties."""
    order = Window.partitionBy("shipment_id").orderBy(
        F.col("event_time").desc(), F.col("seq").desc(), F.xxhash64(*rows.columns))
    return rows.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= n).drop("_nth")


def _last(spark: SparkSession, path: str) -> dict | None:
    done = commits.names(spark, f"{path}/commits")
    return commits.read_record(spark, f"{path}/commits", done[-1]) if done else None


def _folders(path: str, record: dict, wanted) -> list[str]:
    return [f"{path}/data/version={record['buckets'][str(b)]}/bucket={b}" for b in wanted if str(b) in record["buckets"]]


def merge_batch(batch: DataFrame, path: str, writer: str, batch_id: int, buckets: int = BUCKETS,
                settings: Settings = DEFAULT) -> bool:
    """Merge one Silver batch; False when it was merged before."""
    spark = batch.sparkSession
    at = _last(spark, path)
    if at is not None:
        if at["size"] != buckets:
            raise ValueError(f"the state table has {at['size']} buckets, not {buckets}")
        if at["merged"].get(writer, -1) >= batch_id:
            return False
    n = settings.trailing_pings
    new = last_rows(batch.where("shipment_id IS NOT NULL").select(*COLUMNS), n).withColumn("bucket", bucket_of("shipment_id", buckets))
    version = (at["version"] if at else 0) + 1
    stage = f"{path}/data/batch={version}"
    new.write.mode("overwrite").partitionBy("bucket").parquet(stage)
    schema = T.StructType([*new.schema[:-1]])
    touched = sorted(int(x.split("=")[1]) for x in commits.names(spark, stage) if x.startswith("bucket="))
    current = dict(at["buckets"]) if at else {}
    if touched:
        rows = spark.read.schema(new.schema).option("basePath", stage).parquet(stage).select(*schema.names)
        old = _folders(path, at, touched) if at else []
        if old:
            rows = rows.unionByName(spark.read.schema(schema).parquet(*old))
        out = last_rows(rows, n).withColumn("bucket", bucket_of("shipment_id", buckets))
        out.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/version={version}")
        current.update({str(b): version for b in touched})
    commits.write_record(spark, f"{path}/commits", f"{version:019d}", {
        "version": version, "size": buckets, "buckets": current, "columns": schema.json(),
        "merged": {**(at["merged"] if at else {}), writer: batch_id}})
    commits.remove(spark, stage)
    return True


def merging(path: str, writer: str, buckets: int = BUCKETS, settings: Settings = DEFAULT) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, path, writer, batch_id, buckets, settings)
    return merge


def read(spark: SparkSession, path: str, shipment_id: str | None = None) -> DataFrame | None:
    """The stored rows of all shipments, or of one (its bucket is all that is listed and
    read); None before the first batch."""
    at = _last(spark, path)
    if at is None:
        return None
    schema = T.StructType.fromJson(json.loads(at["columns"]))
    wanted = range(at["size"])
    if shipment_id is not None:
        one = spark.range(1).select(bucket_of(F.lit(shipment_id), at["size"]).alias("b"))
        wanted = [one.first().b]
    folders = _folders(path, at, wanted)
    rows = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    return rows if shipment_id is None else rows.where(F.col("shipment_id") == F.lit(shipment_id))


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove the versions that none of the last ``keep`` records names, and older records;
    returns how many versions went."""
    done = commits.names(spark, f"{path}/commits")
    named = {v for name in done[-keep:] for v in commits.read_record(spark, f"{path}/commits", name)["buckets"].values()}
    newest = max((int(name) for name in done), default=0)
    gone = 0
    for folder in commits.names(spark, f"{path}/data"):
        if folder.startswith("version=") and int(folder.split("=")[1]) not in named and int(folder.split("=")[1]) <= newest:
            commits.remove(spark, f"{path}/data/{folder}")
            gone += 1
    for name in done[:-keep]:
        commits.remove(spark, f"{path}/commits/{name}")
    return gone


def run(silver: DataFrame, path: str, checkpoint: str, *, buckets: int = BUCKETS, settings: Settings = DEFAULT,
        available_now: bool = True, wait: bool = True):
    """Start the stream that keeps the table at ``path`` current."""
    from waymark.streaming.jobs import finished
    writer = commits.writer_id(silver.sparkSession, checkpoint)
    w = silver.writeStream.foreachBatch(merging(path, writer, buckets, settings)).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w).start()
    return finished(q) if wait and available_now else q
