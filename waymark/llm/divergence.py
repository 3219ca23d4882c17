"""How far the sources of a language diverge, by a translate-table tokenizer.

*Terms.*  One ``bytes.translate`` lower-cases A-Z and blanks every other ASCII byte
that isn't a letter; ``bytes.split`` cuts there, so a term is a run of ASCII letters
and of any characters beyond ASCII.  A ``Counter`` for each document gives its
frequencies; a task adds them up for each (lang, source) and hands on what it has
counted every ``FLUSH`` entries, so its memory doesn't grow with its input.

*Shares.*  A language keeps the terms that ``MIN_DOCS`` or more of its documents
hold (V of them).  In a group of N occurrences of kept terms, one with ``count``
occurrences has the share ``p = 1 + floor(SCALE (count + PRIOR) / (N + PRIOR V))``.
Two shares differ by ``f(p, q) = floor((p - q)^2 / (p + q))``.  Products are decimals, so
all of it is exact.

*Sources against each other.*  The sum of f over all V terms, most of which a source
doesn't have, is put together from what it has.  With a0 and b0 the shares of a
term that isn't there::

    V f(a0, b0) + U(a, b) + U(b, a) + W(a, b)
    U(a, b) = sum over terms of a of f(p, b0) - f(a0, b0)
    W(a, b) = sum over common terms of f(p, q) - f(p, b0) - f(a0, q) + f(a0, b0)

U comes from the histogram of a's shares, W from the terms' own lists of sources, added
up by pair of sources inside the tasks.  A task holds a batch of terms, a term as many
entries as its language has sources; the result itself holds that number squared.

Null text, lang and source are read as ''.  Every row is a document, repeated ids
and repeated rows too.  A group without terms has its rows with the smoothed shares;
a language without kept terms has value 0 for each pair.  Ties rank by the bytes of
the item.  An empty table gives an empty result.  Only text, lang and source are used.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import stored

MIN_DOCS, TOP, PRIOR, SCALE = 10, 10, 2, 1_000_000_000
#: Entries that a task counts before it hands them on; rows of one batch it emits.
FLUSH, ROWS = 400_000, 50_000
_BLANKED = bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
TABLE = bytes.maketrans(bytes(range(0x41, 0x5B)) + _BLANKED,
                        bytes(range(0x61, 0x7B)) + b" " * len(_BLANKED))
_COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()),
                      ("n", pa.int64()), ("docs", pa.int64())])


def terms(data: bytes) -> list[bytes]:
    return data.translate(TABLE).split()


def _emitted(groups: dict) -> Iterator[pa.RecordBatch]:
    """The counts of each group, after a row without a term for the group itself."""
    for (lang, source), (docs, more) in groups.items():
        names = list(docs)
        for lo in range(0, len(names) + 1, ROWS):
            part = ([None] if lo == 0 else []) + names[lo:lo + ROWS]
            yield pa.record_batch([
                pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                pa.array(part, pa.binary()),
                pa.array([docs[t] + more[t] if t is not None else 0 for t in part], pa.int64()),
                pa.array([docs[t] if t is not None else 0 for t in part], pa.int64())], schema=_COUNTED)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    entries = 0
    for b in batches:
        for lang, source, data in zip(b["lang"].to_pylist(), b["source"].to_pylist(), b["text"]):
            docs, more = groups.setdefault((lang, source), (Counter(), Counter()))
            here = Counter(terms(data.as_py()))
            entries -= len(docs)
            docs.update(here.keys())
            entries += len(docs)
            for t, k in here.items():
                if k > 1:                     # occurrences beyond one a document
                    more[t] += k - 1
            if entries > FLUSH:
                yield from _emitted(groups)
                groups, entries = {}, 0
    yield from _emitted(groups)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _summed(a: np.ndarray, b: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b, v = a[order], b[order], v[order]
    at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.empty(0, np.int64)
    return a[at], b[at], np.add.reduceat(v, at) if len(a) else v


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """W of the terms of each batch: every entry with the one 1, 2, ... places later in
    its term's list, added up by pair of groups."""
    for batch in batches:
        at = batch["at"]
        flat = at.flatten()
        g, p, zero = (np.asarray(flat.field(i)) for i in range(3))
        row = np.repeat(np.arange(len(at)), at.value_lengths().to_numpy(zero_copy_only=False))
        order = np.lexsort((g, row))
        g, p, zero, row = g[order], p[order], zero[order], row[order]
        a = b = v = np.empty(0, np.int64)
        for d in range(1, len(g)):
            x = np.flatnonzero(row[d:] == row[:-d])
            if not len(x):
                break
            y = x + d
            w = _f(p[x], p[y]) - _f(p[x], zero[y]) - _f(zero[x], p[y]) + _f(zero[x], zero[y])
            a, b, v = _summed(np.concatenate([a, g[x]]), np.concatenate([b, g[y]]), np.concatenate([v, w]))
        yield pa.record_batch({"a": a, "b": b, "w": v})


def _share(count: Column, total: Column) -> Column:
    wide = (F.lit(SCALE).cast("decimal(10,0)") * (count + F.lit(PRIOR)).cast("decimal(20,0)")).cast("decimal(38,0)")
    return F.lit(1) + F.call_function("div", wide, F.nullif(total, F.lit(0)).cast("decimal(20,0)"))


def _differ(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _ranked(df: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return df.withColumn("rank", F.row_number().over(order))


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
               min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` has every other source of the
    language, part ``term`` the ``top`` terms that the source has more of than its language."""
    def column(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
    d = docs.select(column(lang).alias("lang"), column(source).alias("source"), column(text).cast("binary").alias("text"))
    counted = d.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long") \
        .groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counted = stored(counted, "term-counts")

    kept = stored(counted.where("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("at"))
        .where(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    held = kept.select("lang", "term", "lang_n", F.inline("at"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = counted.where("term IS NULL").select("lang", "source") \
        .join(held.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left") \
        .join(langs, "lang", "left").na.fill(0, ["total", "v", "lang_total"])
    total, lang_total = F.col("total") + PRIOR * F.col("v"), F.col("lang_total") + PRIOR * F.col("v")
    groups = stored(groups.select("lang", "source", "v", total.alias("total"), lang_total.alias("lang_total"),
                                  _share(F.lit(0), total).alias("zero"),
                                  F.monotonically_increasing_id().alias("g")), "divergence-groups")

    entries = held.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "g", "zero", _share(F.col("n"), F.col("total")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total")).alias("q"))
    entries = stored(entries, "divergence-entries")
    by_term = _ranked(entries.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                                    _differ(F.col("p"), F.col("q")).alias("value"))).where(F.col("rank") <= top)

    one = groups.select("lang", "source", "v", F.col("g").alias("a"), F.col("zero").alias("a0"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("g").alias("b"), F.col("zero").alias("b0"))
    shares = entries.groupBy("lang", F.col("g").alias("a"), F.col("zero").alias("a0"), "p").agg(F.count(F.lit(1)).alias("c"))
    a0, b0 = F.col("a0"), F.col("b0")
    single = stored(shares.join(other, "lang").where("a <> b").groupBy("a", "b")
                    .agg(F.sum(F.col("c") * (_differ(F.col("p"), b0) - _differ(a0, b0))).alias("u")), "divergence-single")
    lists = entries.groupBy("lang", "term").agg(F.collect_list(F.struct("g", "p", "zero")).alias("at")).where("size(at) > 1")
    common = stored(lists.select("at").mapInArrow(_common, "a long, b long, w long")
                    .groupBy("a", "b").agg(F.sum("w").alias("w")), "divergence-common")
    both = common.unionByName(common.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))
    back = single.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("u").alias("back"))
    value = F.coalesce(F.col("v") * _differ(a0, b0), F.lit(0))
    for c in ("u", "back", "w"):
        value = value + F.coalesce(c, F.lit(0))
    pairs = one.join(other, "lang").where("a <> b") \
        .join(single, ["a", "b"], "left").join(back, ["a", "b"], "left").join(both, ["a", "b"], "left")
    by_pair = _ranked(pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value")))
    return by_pair.unionByName(by_term)


def oracle() -> str:
    """DuckDB SQL for ``divergence`` over documents: every kept term in every group."""
    return f"""
WITH docs AS (SELECT row_number() OVER () AS k, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
                     coalesce(source, '') AS source FROM documents),
words AS (SELECT k, lang, source, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY lang, term HAVING count(DISTINCT k) >= {MIN_DOCS}),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
counts AS (SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total
           FROM groups g LEFT JOIN counts c USING (lang, source) GROUP BY ALL),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                  1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + {PRIOR}) // (t.total + {PRIOR} * v.v) AS p,
                  1 + {SCALE}::HUGEINT * (k.n + {PRIOR}) // (v.total + {PRIOR} * v.v) AS q
           FROM groups g JOIN kept k USING (lang) JOIN v USING (lang) JOIN totals t USING (lang, source)
           LEFT JOIN counts c USING (lang, source, term)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
         FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
more AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
         FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM more))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
