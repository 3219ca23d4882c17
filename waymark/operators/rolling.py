"""Trailing (last-n rows) means that do not put a whole key into one task.

A plain ``avg().over(partitionBy(key).orderBy(t).rowsBetween(-(n-1), 0))``
sends every row of a key to one task; a shipment holding a third of all
pings would then be sorted by a single executor.  Here the window runs per
``(key, bucket)`` instead, and only the rows that need rows of an
earlier bucket are re-windowed per key:

* rows at position >= n inside their bucket have their n-1 predecessors in
  the same bucket, so the bucket window is exact for them;
* the first n-1 rows of a bucket ("head") need the last rows of earlier
  buckets.  The "edge" set keeps the first and last n-1 rows of every
  bucket.  A head row's n-1 true predecessors are all edge rows and edge
  rows keep the global order, so the same frame over the edge set (per key)
  is exact for them.

A bucket is an hour of a key.  One that holds more than ``rolling_bucket_rows`` rows (a dense
shipment, or all its rows without a time) is split: the rows of such buckets are dealt into range
partitions by (key, time, tie), written, and the partition's number becomes a part of their
bucket.  Ranges keep the order, so the argument above holds for them, and no task windows more
than a range partition.  The count that finds them combines map-side; without such buckets
there is nothing to write.

The per-key window therefore sees at most 2(n-1) rows per bucket, a volume
bounded by the key's time span and by its rows over the bucket size.  Both branches
read the same shuffle of the input on (key, bucket): AQE reuses the exchange
(``ReusedExchange`` in the executed plan, pinned by a test), so the big input
is shuffled once and only the edge rows are shuffled again by key.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.config import DEFAULT, Settings
from waymark.session import scratch_path


def _bucket(ts_col: str, seconds: int):
    return F.floor(F.unix_seconds(F.col(ts_col)) / F.lit(seconds))


def _bucketed(df: DataFrame, key: str, ts_col: str, tie_col: str, settings: Settings) -> DataFrame:
    """``df`` with ``_bkt`` (hour) and ``_part`` (0, or the range partition within a large bucket)."""
    rows = df.withColumn("_bkt", _bucket(ts_col, settings.rolling_bucket_seconds))
    large = rows.groupBy(key, "_bkt").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > settings.rolling_bucket_rows)
    spark = df.sparkSession
    path = scratch_path(spark, "large-buckets")
    large.select(F.col(key).alias("_lk"), F.col("_bkt").alias("_lb"), "_n").write.parquet(path)
    large = spark.read.parquet(path)
    total = large.agg(F.sum("_n")).first()[0]
    if not total:
        return rows.withColumn("_part", F.lit(0))
    same = F.col(key).eqNullSafe(F.col("_lk")) & F.col("_bkt").eqNullSafe(F.col("_lb"))
    parts = -(-total // settings.rolling_bucket_rows) + 1
    dealt = rows.join(large, same, "left_semi").repartitionByRange(parts, key, ts_col, tie_col) \
        .withColumn("_part", F.spark_partition_id())
    path = scratch_path(spark, "dealt-buckets")
    dealt.write.parquet(path)
    return rows.join(large, same, "left_anti").withColumn("_part", F.lit(0)).unionByName(spark.read.parquet(path))


def trailing_mean(df: DataFrame, key: str, ts_col: str, tie_col: str, value: str, out: str,
                  n: int | None = None, settings: Settings = DEFAULT) -> DataFrame:
    """Mean of ``value`` over the current row and up to n-1 preceding rows of the
    same ``key`` in (ts_col, tie_col) order.  Returns all input columns + ``out``."""
    n = n or settings.trailing_pings
    cols = list(df.columns)
    order: Sequence = (F.col(ts_col), F.col(tie_col))
    in_bucket = Window.partitionBy(key, "_bkt", "_part").orderBy(*order)
    in_bucket_desc = Window.partitionBy(key, "_bkt", "_part").orderBy(*[c.desc() for c in order])
    w = (_bucketed(df, key, ts_col, tie_col, settings)
           .withColumn("_rn", F.row_number().over(in_bucket))
           .withColumn("_rn_desc", F.row_number().over(in_bucket_desc))
           .withColumn("_m", F.avg(value).over(in_bucket.rowsBetween(-(n - 1), 0))))
    body = w.where(F.col("_rn") >= n).select(*cols, F.col("_m").alias(out))
    edge = w.where((F.col("_rn") < n) | (F.col("_rn_desc") < n))
    per_key = Window.partitionBy(key).orderBy(*order).rowsBetween(-(n - 1), 0)
    head = (edge.withColumn("_m2", F.avg(value).over(per_key))
                .where(F.col("_rn") < n)
                .select(*cols, F.col("_m2").alias(out)))
    return body.unionByName(head)


def latest_trailing_mean(df: DataFrame, key: str, ts_col: str, tie_col: str, value: str,
                         out: str, n: int | None = None,
                         settings: Settings = DEFAULT) -> DataFrame:
    """Per key: the mean of ``value`` over its last n rows (one row per key).

    Spark limits the row number to n in each task before the shuffle, so a key sends at
    most n rows a task.  The n rows are added up in their order, as the window does.
    """
    n = n or settings.trailing_pings
    latest = Window.partitionBy(key).orderBy(F.col(ts_col).desc(), F.col(tie_col).desc())
    tail = (df.select(key, ts_col, tie_col, value).withColumn("_rn", F.row_number().over(latest))
              .where(F.col("_rn") <= n))
    held = F.filter(F.sort_array(F.collect_list(F.struct(-F.col("_rn"), F.col(value).cast("double").alias("v")))),
                    lambda s: s["v"].isNotNull())
    total = F.aggregate(F.transform(held, lambda s: s["v"]), F.lit(0.0), lambda a, x: a + x)
    return tail.groupBy(key).agg(F.try_divide(total, F.size(held)).alias(out))
