"""Periodic runs of words, by the dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) of at least ``max(LEAST, 2 q)`` words that no neighbouring word extends.  Words are
runs of bytes other than 0x20 and 0x09-0x0D, unchanged.

*Names.*  For each power of two m, every stretch of m words gets a number, equal for equal
stretches: that of m = 1 from the words, that of 2 m from the pairs of numbers of its two
halves.  Levels end where no stretch recurs.

*Periods.*  A run of period q, ``m <= q < 2 m``, repeats the m words at its start q words
later.  Occurrences of one stretch at most m / 2 apart lie in one arithmetic progression,
whose difference is the stretch's own period; progressions of one stretch are more
than m / 2 apart, so at most three later ones begin within 2 m words.  From a word to the
progressions after its own only two distances can be q: to the first member, or that
between the last members of both (any other is cut off where the one progression's period
ends before the other's).  These are proposed, at most six for each word and level.

*Runs.*  The numbers also tell how far two places agree to the right and to the left: one
comparison a level.  Each proposal is extended to both sides; those that reach the
least length are runs, once each, and of several periods of one stretch the smallest counts.

A word is redundant when some run contains it after that run's first q words.  Null text
has no words.  A text of n words takes ``4 n`` bytes a level, up to the longest recurring
stretch.  Rows are independent: repeated rows and ids give repeated results, an empty table
an empty one, ids pass as they are; no other column is used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import ship

LEAST = 12
#: Bytes of kept text of one emitted batch.
BATCH_BYTES = 8 << 20


def _named(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the distinct values of ``key``, and the places sorted by them."""
    order = np.argsort(key, kind="stable")
    s = key[order]
    new = np.empty(len(s), bool)
    new[:1] = False
    np.not_equal(s[1:], s[:-1], out=new[1:])
    ids = np.empty(len(s), np.int32)
    ids[order] = np.cumsum(new)
    return ids, order


def _proposed(ids: np.ndarray, order: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Places x and distances q, m <= q < 2 m, at which the m words of x may repeat as a run."""
    of = ids[order]
    same = of[1:] == of[:-1]
    recurs = np.zeros(len(of), bool)
    recurs[1:] |= same
    recurs[:-1] |= same
    pos, of = order[recurs], of[recurs]
    if not len(pos):
        return pos, pos
    close = (of[1:] == of[:-1]) & (2 * (pos[1:] - pos[:-1]) <= m)
    first = np.concatenate([[0], np.flatnonzero(~close) + 1])
    last = np.concatenate([first[1:] - 1, [len(pos) - 1]])
    prog = np.repeat(np.arange(len(first)), last - first + 1)
    first, last, name = pos[first], pos[last], of[first]
    xs, qs = [], []
    for step in (1, 2, 3):
        member = prog < len(first) - step
        x, later = pos[member], prog[member] + step
        q = first[later] - x
        ok = (name[later] == of[member]) & (q >= m) & (q < 2 * m)
        xs.append(x[ok])
        qs.append(q[ok])
        q = last[step:] - last[:-step]
        ok = (name[step:] == name[:-step]) & (q >= m) & (q < 2 * m)
        xs.append(last[:-step][ok])
        qs.append(q[ok])
    return np.concatenate(xs), np.concatenate(qs)


def _agree(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that agree from a and b (a < b) to the right, and before them to the left."""
    right, left = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        m, ids = 1 << k, levels[k]
        fits = b + right + m <= n
        x, y = (a + right)[fits], (b + right)[fits]
        right[fits] += m * (ids[x] == ids[y])
        fits = a - left - m >= 0
        x, y = (a - left - m)[fits], (b - left - m)[fits]
        left[fits] += m * (ids[x] == ids[y])
    return right, left


def runs(words: list[bytes], least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period."""
    none = np.empty((0, 3), np.int64)
    n = len(words)
    if n < max(2, least):
        return none
    number: dict[bytes, int] = {}
    ids, order = _named(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n))
    levels, xs, qs, m = [], [], [], 1
    while True:
        levels.append(ids)
        if 2 * m <= n:
            x, q = _proposed(ids, order, m)
            xs.append(x)
            qs.append(q)
        if len(ids) <= m or int(ids.max()) + 1 == len(ids):
            break                              # nothing longer can recur
        ids, order = _named(ids[:-m].astype(np.int64) * len(words) + ids[m:])
        m *= 2
    x, q = np.concatenate(xs), np.concatenate(qs)
    if not len(x):
        return none
    right, left = _agree(levels, x, x + q, n)
    start, length = x - left, left + right + q
    long = (length >= 2 * q) & (length >= least)
    found = np.stack([start[long], length[long], q[long]], axis=1)
    if not len(found):
        return none
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.concatenate([[True], (found[1:, :2] != found[:-1, :2]).any(axis=1)])
    found = found[new]                         # the smallest period of each stretch
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def collapsed(words: list[bytes], found: np.ndarray) -> bytes:
    """The words that aren't redundant, joined by one space."""
    if not len(found):
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, found[:, 0] + found[:, 2], 1)
    np.add.at(cover, found[:, 0] + found[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()])


def _batch(keys, spans: list[np.ndarray], kept: list[bytes]) -> pa.RecordBatch:
    flat = np.concatenate(spans) if spans else np.empty((0, 3), np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in spans])]).astype(np.int32)
    fields = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)],
                                        names=["start", "length", "period"])
    return pa.record_batch([keys, pa.ListArray.from_arrays(pa.array(offsets), fields), pa.array(kept, pa.binary())],
                           names=["key", "runs", "kept"])


def _found(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo, size, spans, kept = 0, 0, [], []
            for i, x in enumerate(b["text"]):
                words = (x.as_py() or b"").split()     # cuts at exactly those bytes
                spans.append(runs(words, least))
                kept.append(collapsed(words, spans[-1]))
                size += len(kept[-1])
                if size >= BATCH_BYTES or i + 1 == b.num_rows:
                    yield _batch(b.column(0).slice(lo, i + 1 - lo), spans, kept)
                    lo, size, spans, kept = i + 1, 0, [], []
    return run


def find(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = LEAST) -> DataFrame:
    """Per row of ``docs``: the key, ``runs`` (start, length and period of each, by start and
    period) and ``collapsed``, the text without redundant words."""
    ship(docs.sparkSession)
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    d = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    out = d.mapInArrow(_found(least), f"key {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, kept binary")
    return out.select(F.col("key").alias(key), "runs", F.col("kept").cast("string").alias("collapsed"))


def with_planted(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` (key and text) with a periodic tail in one text of ten: where
    ``h = crc32(key)`` divides by 10, word i from a on is word ``a + (i - a) % p``."""
    words = F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit("([^ \\t-\\r]+)"), F.lit(1))
    h = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    g = F.floor(h / 10)
    d = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string").alias(text), h.alias("_wm_h"), g.alias("_wm_g"))
    d = d.withColumn("_wm_words", F.when(F.col("_wm_h") % 10 == 0, words))
    n = F.nullif(F.size("_wm_words"), F.lit(0))
    a = F.col("_wm_g") % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("_wm_g") % 8))
    d = d.withColumn("_wm_at", F.when(n > 0, F.struct(a.cast("int").alias("a"), p.cast("int").alias("p"))))

    def word(w: Column, i: Column) -> Column:
        a, p = F.col("_wm_at.a"), F.col("_wm_at.p")
        return F.when(i < a, w).otherwise(F.get("_wm_words", a + (i - a) % p))
    new = F.array_join(F.transform("_wm_words", word), " ")
    return d.select(key, F.when(F.col("_wm_at").isNotNull(), new).otherwise(F.col(text)).alias(text))


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, the longest run and digests of what ``find`` returns."""
    top = F.array_max(F.transform("runs", lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    d = found.withColumn("_wm_top", top)
    length, period = F.col("_wm_top.length"), -F.col("_wm_top.period")
    return d.select(key, F.size("runs").cast("long").alias("n_runs"), (-F.col("_wm_top.start")).alias("start"),
                    length.alias("length"), period.alias("period"),
                    F.call_function("div", 1000 * length, period).alias("exponent_milli"),
                    F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
