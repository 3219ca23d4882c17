"""Benchmark decontamination with spaced seeds.

A text is contaminated by a benchmark item when on one alignment of the two
``NEED`` of ``WIDTH`` consecutive tokens are equal: substitutions are tolerated.
Tokens are runs of letters and digits of the lower-cased text.  An item of
``n < WIDTH`` tokens must match in ``n - max(0, n // 5 - 1)`` places of itself;
items under ``MIN_TOKENS`` tokens say too little to identify anything and match
nothing.

Seeds are fixed masks over consecutive token positions; a seed's hash covers the
positions the mask selects and ignores the others.  ``MASKS`` is lossless for
the rule: however the three substitutions fall in a window of 18, one of the two
masks fits somewhere between them (``tests/llm`` tries every placement), and a
run of five is lossless for the shorter items.  So hashing loses no match, and
every hit is verified token by token on its whole alignment.

Only built-in functions.  One pass hashes every position of every text and looks
the hashes up in the benchmark's seeds: a broadcast table when its counted rows
are at most ``BROADCAST_SEEDS``, a shuffled join beyond.  Only (document,
item, diagonal) hits are shuffled, made distinct map-side first; the verification
joins them to the texts, and skewed keys there are split by the adaptive join.

Null and empty texts match nothing; long texts are used whole; rows that repeat
give repeated verdicts; empty tables give empty results.  Other columns of either
table are not used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import stored, unused

WIDTH, NEED, MIN_TOKENS = 18, 15, 8
#: Selected positions; the first two serve items of at least WIDTH tokens.
MASKS = ((0, 1, 3, 4, 5, 6), (0, 1, 2, 3, 5, 6))
SHORT_MASK = (0, 1, 2, 3, 4)
BROADCAST_SEEDS = 1_000_000


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _seed(hashes: Column, i: Column, mask: tuple[int, ...], tag: int) -> Column:
    """The seed's hash at position i, or null where the mask sticks out."""
    parts = [F.get(hashes, i + o) for o in mask]
    return F.when(i + mask[-1] < F.size(hashes), F.xxhash64(F.lit(tag), *parts))


def _seeds(hashes: Column, mask: tuple[int, ...], tag: int) -> Column:
    """Array over positions 0 .. n-1: the seed's hash there."""
    return F.transform(hashes, lambda _, i: _seed(hashes, i, mask, tag))


def _token_hashes(text: Column) -> Column:
    return F.transform(tokens(text), lambda t: F.xxhash64(t))


def need(n: Column) -> Column:
    """Equal tokens that an item of ``n`` tokens needs within WIDTH positions."""
    return F.when(n >= WIDTH, F.lit(NEED)).otherwise(n - F.greatest(F.lit(0), F.floor(n / 5).cast("int") - 1))


def benchmark_seeds(bench: DataFrame, text: str, item: str) -> DataFrame:
    """Distinct (seed, item_id, item_n, item_pos) of the items' masks; item_n counts the item's tokens."""
    t = bench.select(F.col(f"`{item}`").alias("item_id"), F.col(f"`{text}`").alias("_wm_text")) \
        .withColumn("h", _token_hashes(F.col("_wm_text"))).where(F.size("h") >= MIN_TOKENS)
    long = [t.where(F.size("h") >= WIDTH).select("item_id", F.size("h").alias("item_n"), F.posexplode(_seeds(F.col("h"), m, k)).alias("item_pos", "seed"))
            for k, m in enumerate(MASKS)]
    short = t.where(F.size("h") < WIDTH) \
        .select("item_id", F.size("h").alias("item_n"),
                F.posexplode(_seeds(F.col("h"), SHORT_MASK, len(MASKS))).alias("item_pos", "seed"))
    return reduce(DataFrame.unionByName, [*long, short]).where("seed IS NOT NULL").distinct()


def contaminated(docs: DataFrame, bench: DataFrame, text: str = "text", key: str = "doc_id",
                 item_text: str = "text", item: str = "item_id") -> DataFrame:
    """One row per contaminated (``key``, ``item_id``): ``n_equal``, the most equal
    tokens on a qualifying alignment.  Rows that share key and text count once."""
    seeds = stored(benchmark_seeds(bench, item_text, item), "benchmark-seeds")
    if seeds.count() <= BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    d = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("_wm_text")).where("_wm_text IS NOT NULL")
    # explode(array(x)) keeps Spark from computing x anew for each of its uses.
    hashed = d.select("doc_id", F.xxhash64("_wm_text").alias("text_hash"),
                      F.explode(F.array(_token_hashes(F.col("_wm_text")))).alias("h")) \
        .where(F.size("h") > SHORT_MASK[-1])
    # A row for each position, within the stage that hashes it: compiled, unlike a lambda over the array.
    at = hashed.select("doc_id", "text_hash", "h", F.explode(F.sequence(F.lit(0), F.size("h") - 1)).alias("at"))
    every = F.array(*[_seed(F.col("h"), F.col("at"), m, k) for k, m in enumerate([*MASKS, SHORT_MASK])])
    placed = at.select("doc_id", "text_hash", "at", F.explode(every).alias("seed")).where("seed IS NOT NULL")
    hits = placed.join(seeds, "seed") \
        .select("doc_id", "text_hash", "item_id", "item_n",
                (F.col("at") - F.col("item_pos")).alias("diagonal")).distinct()
    per_text = hits.groupBy("doc_id", "text_hash") \
        .agg(F.collect_list(F.struct("item_id", "item_n", "diagonal")).alias("hits"))
    texts = d.withColumn("text_hash", F.xxhash64("_wm_text")).alias("d")
    hit_texts = texts.join(per_text.alias("p"), F.col("d.doc_id").eqNullSafe(F.col("p.doc_id"))
                           & (F.col("d.text_hash") == F.col("p.text_hash"))) \
        .select("d.doc_id", F.explode(F.array(tokens(F.col("_wm_text")))).alias("t"), "hits")
    # Each hit carries only the tokens it is aligned with, from position max(diagonal, 0) of the text.
    aligned = F.transform("hits", lambda h: F.struct(
        h["item_id"].alias("item_id"), h["item_n"].alias("item_n"), h["diagonal"].alias("diagonal"),
        F.slice(F.col("t"), F.greatest(h["diagonal"], F.lit(0)) + 1,
                h["item_n"] + F.least(h["diagonal"], F.lit(0))).alias("t")))
    hit = hit_texts.select("doc_id", F.explode(aligned).alias("hit"))
    items = bench.select(F.col(f"`{item}`").alias("item_id"), tokens(F.col(f"`{item_text}`")).alias("it")) \
        .where(F.size("it") >= MIN_TOKENS)
    pairs = hit.join(items.alias("s"), F.col("hit.item_id").eqNullSafe(F.col("s.item_id"))
                     & (F.col("hit.item_n") == F.size("it")))
    before = F.least(F.col("hit.diagonal"), F.lit(0))
    equal = F.filter(F.sequence(F.lit(0), F.size("it") - 1),
                     lambda j: F.when(j + before >= 0, F.get(F.col("hit.t"), j + before)) == F.get(F.col("it"), j))
    judged = pairs.select("doc_id", F.col("s.item_id").alias("item_id"), need(F.size("it")).alias("need"), equal.alias("eq"))
    return judged.where(F.exists(F.transform("eq", lambda p, i: F.get(F.col("eq"), i + F.col("need") - 1) - p),
                                 lambda gap: gap < WIDTH)) \
        .groupBy("doc_id", "item_id").agg(F.max(F.size("eq")).cast("int").alias("n_equal"))


def clean(docs: DataFrame, bench: DataFrame, key: str = "doc_id", **names: str) -> DataFrame:
    """``docs`` without the rows whose key is contaminated (null keys are judged as one key)."""
    own = unused(docs, "_wm_id")
    bad = contaminated(docs, bench, key=key, **names).select(F.col("doc_id").alias(own)).distinct()
    return docs.join(bad, F.col(f"`{key}`").eqNullSafe(F.col(own)), "left_anti")


def oracle(docs: str = "documents", bench: str = "benchmark") -> str:
    """DuckDB SQL for ``contaminated``: every pair of equal tokens, counted by alignment."""
    def toks(table: str, key: str, name: str) -> str:
        return f"""{name}0 AS (SELECT DISTINCT {key} AS id, text FROM {table} WHERE text IS NOT NULL),
{name}1 AS (SELECT row_number() OVER () AS row, id, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'),
            lambda x: x <> '') AS t FROM {name}0),
{name} AS (SELECT row, id, len(t) AS n, unnest(t) AS tok, unnest(range(len(t))) AS pos FROM {name}1)"""
    return f"""
WITH {toks(docs, 'doc_id', 'd')},
{toks(bench, 'item_id', 'b')},
eq AS (SELECT d.row AS drow, d.id AS doc_id, b.row AS brow, b.id AS item_id, b.n, d.pos - b.pos AS diag, b.pos,
              CASE WHEN b.n >= {WIDTH} THEN {NEED} ELSE b.n - greatest(0, b.n // 5 - 1) END AS need
       FROM d JOIN b ON d.tok = b.tok WHERE b.n >= {MIN_TOKENS}),
big AS (SELECT drow, doc_id, brow, item_id, diag, need, count(*) AS c, list(pos ORDER BY pos) AS p FROM eq
        GROUP BY ALL HAVING count(*) >= need),
ok AS (SELECT *, unnest(range(1, CAST(c - need + 2 AS BIGINT))) AS i FROM big)
SELECT doc_id, item_id, CAST(max(c) AS INTEGER) AS n_equal FROM ok
WHERE p[CAST(i + need - 1 AS BIGINT)] - p[i] < {WIDTH} GROUP BY doc_id, item_id"""
