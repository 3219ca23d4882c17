"""WARC archives with an embedded Zstandard dictionary, one frame per record.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, itself compressed; every record follows as a frame of its own, so a record
can be read from its offset alone with the dictionary at hand.  The dictionary is
trained on the records of at most ``SAMPLE_ROWS`` pages of at most ``SAMPLE_BYTES``
each (chosen by a hash; parameters bound what the driver sees); inputs too small
to train on use the sample itself as a dictionary, an empty input writes nothing.

Each task writes its partition to archives of at most ``ROLL_BYTES`` below
``spark.checkpoint.dir`` (or another folder), through ``pyarrow.fs``, under names no
other attempt uses, and returns the records' places; only the returned
manifest counts, so files of lost attempts are never read.  Equal payloads are written
once: the least page id of a (digest, length) is a response and the others
are revisits that refer to it.  The payloads themselves are never shuffled unless the
table of repeated digests is too large to broadcast.

Null html is the empty payload, null urls give records without a target, null
page ids records without an id (a null id is nobody's first).  Rows that repeat id and
payload are each a response, or each a revisit.  Long payloads are written whole.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import sampled, scratch, stored

# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"

ID_HEADER = "Waymark-Page-Id"
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 1 << 16, 1 << 16
ROLL_BYTES = 1 << 28
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
SPACE = uuid.UUID("5a0b4f0e-7d3c-4d57-9d3a-2f6f6f0c8d11")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page_id}|{digest}')}>"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record; a revisit (``refers_to`` given) carries the HTTP header without the body."""
    digest = payload_digest(payload)
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    lines = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}",
             f"WARC-Payload-Digest: sha1:{digest}", f"Content-Type: {HTTP_TYPE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + " ".join(url.split()))
    if page_id is not None:
        lines.append(f"{ID_HEADER}: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    else:
        block += payload
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode("utf-8", "surrogatepass")
    return head + block + b"\r\n\r\n"


def train(samples: list[bytes]) -> bytes:
    """Dictionary content from sample records."""
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstd.ZstdError:                       # too few or too small to train on
        return b"".join(samples)[-DICTIONARY_BYTES:]


def dictionary_frame(dictionary: bytes) -> bytes:
    body = zstd.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def _utf8(html: str | None) -> bytes:
    return (html or "").encode("utf-8", "surrogatepass")


def _writer(folder: str, dictionary: bytes, date: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") \
            else (fs.LocalFileSystem(), folder)
        store.create_dir(root, recursive=True)
        press = zstd.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True,
                                    dict_data=zstd.ZstdCompressionDict(dictionary) if dictionary else None)
        lead = dictionary_frame(dictionary)
        out, name, at = None, "", 0
        try:
            for b in batches:
                rows = []
                for page_id, url, html, refers in zip(b["page_id"], b["url"], b["html"], b["refers_to"]):
                    page_id, refers = (None if pd.isna(x) else int(x) for x in (page_id, refers))
                    frame = press.compress(record(page_id, url, _utf8(html), refers, date))
                    if out is None or at + len(frame) > ROLL_BYTES:
                        if out is not None:
                            out.close()
                        name = f"part-{uuid.uuid4().hex}.warc.zst"
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                        out.write(lead)
                        at = len(lead)
                    out.write(frame)
                    rows.append((name, at, len(frame)))
                    at += len(frame)
                yield pd.DataFrame(rows, columns=["archive", "offset", "length"])
        finally:
            if out is not None:
                out.close()
    return run


def write(pages: DataFrame, folder: str, min_payload: int = 0, date: str = DATE, key: str = "page_id",
          url: str = "url", html: str = "html") -> DataFrame:
    """Write every row of ``pages``; returns the manifest (archive, offset, length), itself a written table."""
    p = pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                     F.col(f"`{html}`").cast("string").alias("html"))
    sizes = F.octet_length(F.coalesce("html", F.lit("")))
    small = p.where(sizes <= SAMPLE_BYTES)
    sample = sampled(small, SAMPLE_ROWS, small.count(), "page_id", "url").collect()
    dictionary = train([record(r["page_id"], r["url"], _utf8(r["html"]), None, date) for r in sample])
    named = p.withColumn("sha", F.sha1(F.coalesce("html", F.lit("")).cast("binary"))).withColumn("size", sizes)
    repeated = stored(named.where(F.col("size") >= min_payload).groupBy("sha", "size")
                      .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                      .where("n > 1 AND first IS NOT NULL").drop("n"), "repeated-payloads")
    rows = named.join(repeated, ["sha", "size"], "left").select(
        "page_id", "url", "html", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))
    return stored(rows.mapInPandas(_writer(folder, dictionary, date), "archive string, offset long, length long"),
                  "warc-manifest")


def _records(store, path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of an archive's records, one at a time."""
    with store.open_input_stream(path, compression=None) as f:
        magic, size = struct.unpack("<II", f.read(8))
        if magic != SKIPPABLE_MAGIC:
            raise ValueError(f"{path}: no dictionary frame")
        dictionary = zstd.ZstdDecompressor().decompress(f.read(size))
        d = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(dictionary) if dictionary else None)
        with d.stream_reader(f, read_across_frames=True) as r:
            held = b""
            while True:
                while b"\r\n\r\n" not in held:
                    more = r.read(1 << 16)
                    if not more:
                        if held:
                            raise ValueError(f"{path}: ends inside a record")
                        return
                    held += more
                head, _, held = held.partition(b"\r\n\r\n")
                lines = head.decode("utf-8", "surrogatepass").split("\r\n")
                headers = dict(x.split(": ", 1) for x in lines[1:])
                n = int(headers["Content-Length"]) + 4
                parts = [held]
                have = len(held)
                while have < n:
                    more = r.read(max(1 << 16, n - have))
                    if not more:
                        raise ValueError(f"{path}: ends inside a record")
                    parts.append(more)
                    have += len(more)
                held = b"".join(parts)
                block, held = held[:n - 4], held[n:]
                yield headers, block


def _reader(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") \
            else (fs.LocalFileSystem(), folder)
        for b in batches:
            for name in b["archive"]:
                rows = []
                for h, block in _records(store, f"{root}/{name}"):
                    kind, digest = h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha1:")
                    _, _, body = block.partition(b"\r\n\r\n")
                    if kind == "response" and payload_digest(body) != digest:
                        raise ValueError(f"{name}: payload digest of {h['WARC-Record-ID']} differs")
                    rows.append((h["WARC-Record-ID"], int(h[ID_HEADER]) if ID_HEADER in h else None, kind, digest,
                                 len(body) if kind == "response" else None, h.get("WARC-Refers-To")))
                    if len(rows) == 4096:
                        yield _frame(rows)
                        rows = []
                if rows:
                    yield _frame(rows)
    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["record", "page_id", "record_type", "payload_digest", "payload_bytes", "refers"])
    return out.astype({"page_id": "Int64", "payload_bytes": "Int64"})


def read_back(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """The archives' records: page_id, payload_bytes, payload_digest, record_type, refers_to.
    Revisits take the payload's size from the response they refer to."""
    found = stored(manifest.select("archive").distinct().repartition("archive").mapInPandas(
        _reader(folder), "record string, page_id long, record_type string, payload_digest string, payload_bytes long, "
                         "refers string"), "warc-records")
    responses = found.where("record_type = 'response'")
    firsts = responses.select(F.col("record").alias("refers"), F.col("page_id").alias("refers_to"),
                              F.col("payload_bytes").alias("size")).dropDuplicates(["refers"])
    revisits = found.where("record_type = 'revisit'").drop("payload_bytes").join(firsts, "refers", "left")
    return responses.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")) \
        .unionByName(revisits.select("page_id", F.col("size").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))


def archive(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Write ``pages`` below ``spark.checkpoint.dir`` and return what the archives hold."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    return read_back(spark, write(pages, folder, min_payload), folder)


def oracle(min_payload: int = 0) -> str:
    """DuckDB SQL for ``archive`` over ``pages`` (base32 spelled out from the digest's bits)."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    digits = " || ".join(f"substr('{letters}', substr(bits, {5 * i + 1}, 5)::BIT::INTEGER + 1, 1)" for i in range(32))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, CAST(strlen(t) AS BIGINT) AS n, t, sha1(t) AS hex FROM p),
b AS (SELECT page_id, n, t, array_to_string([CASE substr(hex, CAST(i AS INTEGER), 1)
        WHEN '0' THEN '0000' WHEN '1' THEN '0001' WHEN '2' THEN '0010' WHEN '3' THEN '0011' WHEN '4' THEN '0100'
        WHEN '5' THEN '0101' WHEN '6' THEN '0110' WHEN '7' THEN '0111' WHEN '8' THEN '1000' WHEN '9' THEN '1001'
        WHEN 'a' THEN '1010' WHEN 'b' THEN '1011' WHEN 'c' THEN '1100' WHEN 'd' THEN '1101' WHEN 'e' THEN '1110'
        ELSE '1111' END FOR i IN range(1, 41)], '') AS bits FROM h),
d AS (SELECT page_id, n, t, {digits} AS digest FROM b),
f AS (SELECT *, min(page_id) OVER (PARTITION BY t) AS first FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= {min_payload} AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {min_payload} AND first <> page_id THEN first END AS refers_to
FROM f"""
