"""Exact quantiles whose work is spread over range partitions.

The values of each group are counted first (a hot value is then one row) and dealt by range
of (group, value) into partitions, as a written table.  The partitions' totals and
their running sums tell which partition holds which rank; only the few partitions that hold a
wanted rank are read again, each on its own, to find the value there.  So no task holds
a group's values; the largest group of a task is one range partition.  Linear interpolation between the
two neighbouring ranks, with the arithmetic of Spark's ``percentile``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.session import scratch_path


def ranged(counts: DataFrame, group: str, value: str, parts: int | None = None) -> DataFrame:
    """``counts`` written in range partitions, with the column ``part``; ascending parts hold
    ascending (group, value)."""
    spark = counts.sparkSession
    by = [F.col(group), F.col(value)]
    dealt = counts.repartitionByRange(parts, *by) if parts else counts.repartitionByRange(*by)
    path = scratch_path(spark, "quantile-counts")
    dealt.withColumn("part", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def exact_quantiles(counts: DataFrame, probs: Sequence[float], group: str = "feature", value: str = "value",
                    n: str = "n", parts: int | None = None) -> DataFrame:
    """(group, q array<double>) from rows (group, value, n), no null or NaN among the values."""
    t = ranged(counts.select(group, value, F.col(n).cast("bigint").alias("n")), group, value, parts)
    in_order = Window.partitionBy(group).orderBy("part")
    totals = t.groupBy(group, "part").agg(F.sum("n").alias("c")) \
        .withColumn("start", F.sum("c").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")) \
        .withColumn("total", F.sum("c").over(Window.partitionBy(group)))
    ranks = []
    for i, p in enumerate(probs):
        h = F.lit(float(p)) * (F.col("total") - 1)
        ranks += [F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), h.alias("h"), rank.cast("bigint").alias("rank"))
                  for side, rank in ((0, F.floor(h)), (1, F.ceil(h)))]
    wanted = totals.select(group, "part", "start", "c", F.inline(F.array(*ranks))) \
        .where((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("c"))).drop("c")
    # Two ranks for each probability and group, so the join sends no more rows than that.
    held = t.join(F.broadcast(wanted.select(group, "part", "start").distinct()), [group, "part"])
    within = Window.partitionBy(group, "part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    held = held.withColumn("end", F.col("start") + F.sum("n").over(within)).select(group, "part", value, "n", "end")
    found = held.join(F.broadcast(wanted.drop("start")), [group, "part"]) \
        .where((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n")))

    def at(side: int, c: str):
        return F.max(F.when(F.col("side") == side, F.col(c)))
    one = found.groupBy(group, "i").agg(F.max("h").alias("h"), at(0, value).alias("lo"), at(1, value).alias("hi"),
                                        at(0, "rank").alias("lo_rank"), at(1, "rank").alias("hi_rank"))
    between = (F.col("hi_rank") - F.col("h")) * F.col("lo") + (F.col("h") - F.col("lo_rank")) * F.col("hi")
    q = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(between)
    return one.groupBy(group).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", q.alias("q")))),
                                              lambda s: s["q"]).alias("q"))
