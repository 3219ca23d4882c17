"""An append sink whose schema may grow, and whose batches count once.

Each micro-batch is written to a folder of its own, ``data/writer=W/batch=N``, and then
committed by a record that holds the table's columns as of that batch.  Readers take
committed folders only.  So

* a batch that is replayed after a crash between its write and the stream's checkpoint finds
  its record and adds nothing; one that crashed before its record is written over;
* a column that appears in a batch is added to the table: earlier rows read as NULL.  A
  column that a batch lacks is NULL in its rows.  A type that widens without loss into the
  table's own is cast to it; any other change of type is refused, and the stream stops.

The reader's schema comes from the records, so no file footers are merged.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.sources import commits

#: Casts that lose nothing: from -> to.
_WIDER = {"tinyint": {"smallint", "int", "bigint", "double"}, "smallint": {"int", "bigint", "double"},
          "int": {"bigint", "double"}, "float": {"double"}, "date": {"timestamp"}}


def merged(table: T.StructType, batch: T.StructType) -> T.StructType:
    """``table`` with the columns that ``batch`` adds; raises on a change of type."""
    have = {f.name.lower(): f for f in table}
    out = list(table)
    for f in batch:
        old = have.get(f.name.lower())
        if old is None:
            out.append(T.StructField(f.name, f.dataType, True))
        elif old.dataType != f.dataType and old.dataType.simpleString() not in _WIDER.get(f.dataType.simpleString(), ()):
            raise ValueError(f"column {f.name}: {f.dataType.simpleString()} doesn't fit the table's {old.dataType.simpleString()}")
    return T.StructType(out)


def schema_of(spark: SparkSession, path: str) -> T.StructType | None:
    """The table's columns: those of all records (one distinct text for each version)."""
    if not commits.names(spark, f"{path}/commits"):
        return None
    versions = spark.read.schema("n bigint, columns string").json(f"{path}/commits") \
        .groupBy("columns").agg(F.min("n").alias("n")).orderBy("n", "columns").collect()
    out = T.StructType([])
    for v in versions:
        out = merged(out, T.StructType.fromJson(json.loads(v.columns)))
    return out


def append_batch(batch: DataFrame, path: str, writer: str, batch_id: int) -> bool:
    """Write and commit one batch; False when it was committed before."""
    spark = batch.sparkSession
    name = f"{writer}-{batch_id:019d}"
    if commits.exists(spark, f"{path}/commits/{name}"):
        return False
    table = merged(schema_of(spark, path) or T.StructType([]), batch.schema)
    kinds = {f.name.lower(): f.dataType for f in table}
    rows = batch.select(*[F.col(f"`{c}`").cast(kinds[c.lower()]).alias(c) for c in batch.columns])
    rows.write.mode("overwrite").parquet(f"{path}/data/writer={writer}/batch={batch_id}")
    commits.write_record(spark, f"{path}/commits", name, {
        "writer": writer, "batch": batch_id, "n": batch_id, "columns": table.json()})
    return True


def evolving(path: str, writer: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function."""
    def append(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, path, writer, batch_id)
    return append


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The committed rows under the table's columns, or None before the first commit."""
    schema = schema_of(spark, path)
    if schema is None:
        return None
    keyed = T.StructType([*schema, T.StructField("writer", T.StringType()), T.StructField("batch", T.LongType())])
    data = spark.read.schema(keyed).option("basePath", f"{path}/data").parquet(f"{path}/data")
    done = spark.read.schema("writer string, batch bigint").json(f"{path}/commits")
    return data.join(done, ["writer", "batch"], "left_semi").select(*[F.col(f"`{f.name}`") for f in schema])


def run(df: DataFrame, path: str, checkpoint: str, *, available_now: bool = True, wait: bool = True):
    """Start a stream into the table at ``path``."""
    from waymark.streaming.jobs import finished
    writer = commits.writer_id(df.sparkSession, checkpoint)
    w = df.writeStream.foreachBatch(evolving(path, writer)).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w).start()
    return finished(q) if wait and available_now else q
