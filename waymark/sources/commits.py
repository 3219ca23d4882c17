"""Commit records: small files that make a write count, exactly once.

``create_once`` is the one primitive that needs the file system: of several writers that
ask for the same name, one gets it.  Records are JSON text under a folder; a record becomes
visible whole (written under a hidden name, then renamed) or not at all.
"""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False when it was there already.  Atomic on file systems whose
    ``create`` without overwrite is (HDFS), and on a local folder."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getScheme() == "file":
        # Hadoop's local file system tests first and creates then; the operating system does both at once.
        try:
            os.close(os.open(urlparse(path).path if path.startswith("file:") else path, os.O_CREAT | os.O_EXCL))
            return True
        except FileExistsError:
            return False
    try:
        fs.create(p, False).close()
        return True
    except Exception as e:
        if fs.exists(p):
            return False
        raise e


def write_record(spark: SparkSession, folder: str, name: str, record: dict) -> None:
    """Write (or replace, by the same writer) one record."""
    fs, target = _fs(spark, f"{folder}/{name}")
    _, hidden = _fs(spark, f"{folder}/.{name}-{uuid.uuid4().hex[:8]}")
    fs.mkdirs(target.getParent())
    out = fs.create(hidden, True)
    out.write(bytearray((json.dumps(record, sort_keys=True) + "\n").encode()))
    out.close()
    if not fs.rename(hidden, target):
        raise OSError(f"could not publish {target}")


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the records, sorted; an absent folder has none."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if not n.startswith((".", "_")))


def read_record(spark: SparkSession, folder: str, name: str) -> dict:
    fs, p = _fs(spark, f"{folder}/{name}")
    stream = fs.open(p)
    try:
        data = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(data)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def writer_id(spark: SparkSession, checkpoint: str) -> str:
    """A name for the stream that owns ``checkpoint``: kept in the folder, so a stream that
    starts over from an empty one (and counts its batches from 0 again) is another writer."""
    folder = f"{checkpoint}/waymark-writer"
    found = names(spark, folder)
    if not found:
        write_record(spark, folder, uuid.uuid4().hex[:12], {})
        found = names(spark, folder)
    return found[0]
