"""Poisson replication: mix sources to target weights.

Source ``s`` with ``n_s`` of ``N`` rows and target share ``w_s`` gets the mean
repetition rate ``epochs * N * w_s / n_s``.  Every document draws its number of
copies from a Poisson distribution of that mean by inverting the distribution
function at a uniform number hashed from (seed, document id), is exploded by it,
and every copy goes to a partition and a place in it given by another hash: a
global shuffle that a rerun repeats exactly.

A rate above ``MAX_RATE`` is split into equal parts, each with its own draw
(a sum of independent Poisson draws is Poisson), so the table of the
distribution function has a fixed length however rare a source is.

Only built-in functions.  Counting sources is a map-side-combined aggregate of
one column; its result is a written table, which Spark broadcasts when its
size allows and otherwise joins with skew splitting.  The only shuffle of texts
is the shuffle asked for, on a unique key.

Null sources are a source of their own.  Sources that ``weights`` leaves out, or
gives zero, get no copies.  Rows with equal ids (or null ids) share their draw.
Texts, null or empty too, are only carried.  An empty table gives an empty one.
Input columns named ``part``, ``copy`` or ``shuffle_key`` are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import stored, without

#: Largest rate of a single draw, and entries of its distribution function
#: (at rate 16 the tail beyond 80 is under 2^-53).
MAX_RATE = 16
TERMS = 80
ADDED = ("part", "copy", "shuffle_key")


def hashed(*parts: Column | str) -> Column:
    """52 bits of the MD5 of the parts joined by '|' (nulls as 'null')."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def cdf(rate: Column) -> Column:
    """Array of P(X <= k), k = 0 .. TERMS, for a Poisson X of this rate."""
    p0 = F.exp(-rate)
    start = F.struct(p0.alias("p"), p0.alias("c"), F.array(p0).alias("all"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * rate / k
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.concat(s["all"], F.array(s["c"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda s: s["all"])


def rates(docs: DataFrame, source: str, weights: Mapping[str, float] | None, epochs: float) -> DataFrame:
    """One row per source: ``_wm_source, n, parts, rate, cdf``; target shares are
    ``weights``, or proportional to the square root of the source's size."""
    sizes = docs.groupBy(F.col(f"`{source}`").alias("_wm_source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        share = F.sqrt(F.col("n").cast("double"))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        known = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
        share = F.coalesce(F.get(F.map_values(F.map_filter(known, lambda k, v: k == F.col("_wm_source"))), F.lit(0)),
                           F.lit(0.0))
    total = sizes.agg(F.sum("n").alias("all_n"), F.sum(share).alias("all_w"))
    mean = F.lit(float(epochs)) * F.col("all_n") * share / F.col("all_w") / F.col("n")
    parts = F.greatest(F.lit(1), F.ceil(F.col("mean") / MAX_RATE)).cast("int")
    return (sizes.crossJoin(F.broadcast(total))          # one row of totals
            .where((F.col("all_w") > 0) & (share > 0))
            .withColumn("mean", mean).withColumn("parts", parts)
            .withColumn("rate", F.col("mean") / F.col("parts"))
            .select("_wm_source", "n", "parts", "rate", cdf(F.col("rate")).alias("cdf")))


def replicate(docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = 1.0,
              seed: int = 0, source: str = "source", key: str = "doc_id") -> DataFrame:
    """The shuffled copies: columns of ``docs`` plus ``part``, ``copy`` (int) and ``shuffle_key`` (long)."""
    docs = without(docs, ADDED)
    table = stored(rates(docs, source, weights, epochs), "source-rates") \
        .select(F.col("_wm_source"), F.col("parts").alias("_wm_parts"), F.col("cdf").alias("_wm_cdf"))
    own = docs.columns
    joined = docs.join(table, F.col(f"`{source}`").eqNullSafe(F.col("_wm_source")))
    # The draws are exploded with their parts, so each is hashed once.
    draw = F.transform(F.sequence(F.lit(1), F.col("_wm_parts")), lambda p: F.struct(
        p.alias("part"), (hashed(F.lit(seed), F.col(f"`{key}`"), p) / F.lit(float(2 ** 52))).alias("u")))
    drawn = joined.select("*", F.explode(draw).alias("_wm_draw")).withColumn("part", F.col("_wm_draw.part")) \
        .withColumn("_wm_n", F.size(F.filter("_wm_cdf", lambda c: c <= F.col("_wm_draw.u"))))
    copies = drawn.where("_wm_n > 0") \
        .select(*[F.col(f"`{c}`") for c in own], "part",
                F.explode(F.sequence(F.lit(1), F.col("_wm_n"))).alias("copy")) \
        .withColumn("shuffle_key", hashed(F.lit(f"{seed}-order"), F.col(f"`{key}`"), F.col("part"), F.col("copy")))
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def oracle(docs: str = "documents", epochs: float = 1.0, seed: int = 0) -> str:
    """DuckDB SQL for ``replicate`` with default weights, over a table or subquery ``docs``."""
    def h(text: str) -> str:
        return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"

    return f"""
WITH RECURSIVE d AS (SELECT * FROM {docs}),
sizes AS (SELECT source AS s, count(*) AS n FROM d GROUP BY source),
total AS (SELECT sum(n) AS all_n, sum(sqrt(CAST(n AS DOUBLE))) AS all_w FROM sizes),
mean AS (SELECT s, CAST({epochs!r} AS DOUBLE) * all_n * sqrt(CAST(n AS DOUBLE)) / all_w / n AS mean FROM sizes, total),
rate AS (SELECT s, greatest(1, CAST(ceil(mean / {MAX_RATE}) AS INTEGER)) AS parts,
                mean / greatest(1, CAST(ceil(mean / {MAX_RATE}) AS INTEGER)) AS r FROM mean),
law AS (SELECT s, 0 AS k, r, exp(-r) AS p, exp(-r) AS c FROM rate
        UNION ALL SELECT s, k + 1, r, p * r / (k + 1), c + p * r / (k + 1) FROM law WHERE k < {TERMS}),
draws AS (SELECT d.*, rate.parts, unnest(range(1, rate.parts + 1)) AS part
          FROM d JOIN rate ON d.source IS NOT DISTINCT FROM rate.s),
hashed AS (SELECT *, {h(f"'{seed}|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || CAST(part AS VARCHAR)")}
                     / CAST({2 ** 52} AS DOUBLE) AS u FROM draws),
counted AS (SELECT hashed.*, (SELECT count(*) FROM law WHERE law.s IS NOT DISTINCT FROM hashed.source
                                      AND law.c <= hashed.u) AS m FROM hashed),
copies AS (SELECT * EXCLUDE (parts, u, m, part), CAST(part AS INTEGER) AS part,
                  CAST(unnest(range(1, m + 1)) AS INTEGER) AS copy FROM counted WHERE m > 0)
SELECT *, {h(f"'{seed}-order|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || CAST(part AS VARCHAR) || '|' || CAST(copy AS VARCHAR)")} AS shuffle_key
FROM copies"""
