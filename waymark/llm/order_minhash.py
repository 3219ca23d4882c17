"""Near-duplicate texts by Order MinHash with banded alignment.

A text is its sequence of ``SHINGLE``-word shingles (lower case; a shorter text
is one shingle).  Two texts are linked when ``m / (a + b - m) >= SIMILARITY``,
where ``a`` and ``b`` are their numbers of shingles and ``m`` is how many an
alignment matches in order: the Jaccard similarity of the sequences, sensitive to
order and so to edit distance, not just to the sets.

*Sketch.*  Each shingle is labelled with its occurrence number.  For each of
``TABLES`` seeds the ``TAKE`` labelled shingles of least hash are kept in text
order; their joint hash is a bucket key.  At similarity 0.8 two texts share a key
of one table with probability 0.33, so they miss each other in all 36 with
probability 6e-7.  Texts of up to ``SHORT`` shingles also get ``SHORT_TABLES``
keys of ``SHORT_TAKE`` shingles.  Every text gets the same number of keys, whatever its neighbours.

*Candidates.*  Texts with equal word sequences are one class, entered once.
Every class is verified against the most central one of each of its buckets, the one
whose buckets hold most: of many edited copies that is the least edited, near to
all.  Pairs inside a component cannot change the result and are not made, so a bucket
of many copies costs one pair for each.  Where a bucket is left in several components,
pairs across them are verified too: all of them in buckets of at most ``FEW`` classes.
Larger ones, which a common passage or many much edited copies fill, are joined to groups
where they share classes, and a group is compared in squares of ``SIDE`` by ``SIDE``
texts, each a task's matrix product of shingle incidence that bounds every pair's
matches; only pairs that reach the bound are aligned and only links leave the task.

*Verification.*  Bit-parallel alignment of the shingle sequences restricted to
the band ``|i - j| <= a + b - 2 m0``, where ``m0`` is the least ``m`` that links
the two; no linking alignment leaves it, so the test is exact.

A class is known by the digest of its words, not by an id, so an id may stand by several
texts: each row gets the class of its own text.  Null texts and texts without words are
linked with nothing, and so are rows with a null id; all of them stay.  Of a class exactly
one id and text stays (the least); rows that repeat both are one document to
``deduplicate``, which keeps one of them.  Long texts are sketched and aligned whole.
Only id and text are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import ship, stored, unused
from waymark.llm.components import components
from waymark.llm.shingles import Words, mixed

SHINGLE, SIMILARITY = 5, 0.8
TABLES, TAKE = 36, 5
SHORT, SHORT_TABLES, SHORT_TAKE = 44, 16, 2
#: Largest bucket whose cross pairs are all verified.
FEW = 32
SIDE, COLUMNS = 256, 1 << 14
#: Matrix cells of one step of the sketch; longer texts take the tables in turns.
CELLS = 1 << 21


def shingles(text: str | None) -> np.ndarray:
    d = Words(text, lower=True)
    return d.grams(min(SHINGLE, d.n)) if d.n else np.empty(0, np.uint64)


def _labelled(g: np.ndarray) -> np.ndarray:
    """Hash of (shingle, occurrence number in this text)."""
    order = np.argsort(g, kind="stable")
    s = g[order]
    first = np.concatenate([[True], s[1:] != s[:-1]])
    at = np.arange(len(g))
    occ = np.empty(len(g), np.uint64)
    occ[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    with np.errstate(over="ignore"):
        return mixed(g + occ * np.uint64(0x9E3779B97F4A7C15)) if occ.any() else mixed(g)


_SEEDS = mixed(np.arange(1, 2 * (TABLES + SHORT_TABLES) + 1, dtype=np.uint64))
_XOR, _ODD = _SEEDS[::2], _SEEDS[1::2] | np.uint64(1)


def _keys(g: np.ndarray, label: np.ndarray, tables: range, take: int) -> np.ndarray:
    out = np.empty(len(tables), np.uint64)
    step = max(1, CELLS // max(1, len(g)))
    take = min(take, len(g))
    for lo in range(0, len(tables), step):
        ts = np.asarray(tables[lo:lo + step])
        with np.errstate(over="ignore"):
            v = (label[None, :] ^ _XOR[ts, None]) * _ODD[ts, None]
            if take < len(g):
                at = np.sort(np.argpartition(v, take - 1, axis=1)[:, :take], axis=1)
            else:
                at = np.broadcast_to(np.arange(len(g)), (len(ts), len(g)))
            key = ts.astype(np.uint64) + np.uint64(1)
            for c in range(at.shape[1]):
                key = mixed(key * np.uint64(0x100000001B3) + g[at[:, c]])
        out[lo:lo + step] = key
    return out


def sketch(g: np.ndarray) -> np.ndarray:
    label = _labelled(g)
    keys = _keys(g, label, range(TABLES), TAKE)
    if len(g) <= SHORT:
        keys = np.concatenate([keys, _keys(g, label, range(TABLES, TABLES + SHORT_TABLES), SHORT_TAKE)])
    return keys.view(np.int64)


def _sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        n, digest, keys = np.empty(len(b), np.int64), [], []
        for i, t in enumerate(b["text"]):
            g = shingles(t)
            n[i] = len(g)
            digest.append(xxhash.xxh3_128_digest(Words(t, lower=True).data))
            keys.append(sketch(g) if len(g) else np.empty(0, np.int64))
        d = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
        yield pd.DataFrame({"doc_id": b["doc_id"], "raw": b["raw"], "n": n, "d1": d[:, 0], "d2": d[:, 1], "keys": keys})


def matched(a: list[int], b: list[int], need: int) -> int:
    """Shingles that an alignment of ``a`` and ``b`` matches in order, exact when at
    least ``need``: band |i - j| <= len(a) + len(b) - 2 need, bits for rows."""
    band = len(a) + len(b) - 2 * need
    if band < 0:
        return 0
    lo, most = 0, min(len(a), len(b))
    while lo < most and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < most - lo and a[len(a) - 1 - hi] == b[len(b) - 1 - hi]:
        hi += 1
    a, b = a[lo:len(a) - hi], b[lo:len(b) - hi]
    places: dict[int, list[int]] = {}
    for i, x in enumerate(a):
        places.setdefault(x, []).append(i)
    full = (1 << len(a)) - 1
    free = full
    for j, x in enumerate(b):
        at = places.get(x)
        if at:
            bits = 0
            for i in at:
                if abs(i - j) <= band:
                    bits |= 1 << i
            u = free & bits
            free = ((free + u) | (free - u)) & full
    return lo + hi + len(a) - free.bit_count()


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    total = len(a) + len(b)
    need = int(np.ceil(similarity * total / (1 + similarity) - 1e-9))
    if not total or need > min(len(a), len(b)):
        return False
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    if np.minimum(ca[ia], cb[ib]).sum() < need:        # even any order matches too few
        return False
    return matched(a.tolist(), b.tolist(), need) >= need


def _verified(similarity: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple[object, np.ndarray] = (None, np.empty(0, np.uint64))
        for b in batches:
            ok = np.zeros(len(b), bool)
            for i, (hub, ta, tb) in enumerate(zip(b["b"], b["ta"], b["tb"])):
                if last[0] != hub:
                    last = (hub, shingles(tb))
                ok[i] = similar(shingles(ta), last[1], similarity)
            yield b.loc[ok, ["a", "b"]]
    return run


def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of labelled shingle sets, by incidence products
    of ``COLUMNS`` labels at a time."""
    names, col = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    row = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in [*a, *b]])
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(a), len(b)), np.float32)
    for lo in range(0, len(names), COLUMNS):
        s, e = np.searchsorted(col, [lo, lo + COLUMNS])
        m = np.zeros((len(a) + len(b), min(COLUMNS, len(names) - lo)), np.float32)
        m[row[s:e], col[s:e] - lo] = 1
        out += m[:len(a)] @ m[len(a):].T
    return out


def _square(part: pd.DataFrame, similarity: float) -> list[tuple[int, int]]:
    side = part["side"].to_numpy()
    x = part[side != 1]
    y = part[side != 0] if (side == 2).any() else part[side == 1]
    if not len(x) or not len(y):
        return []
    ids, ids_y = x["id"].to_numpy(), y["id"].to_numpy()
    differ = x["component"].to_numpy()[:, None] != y["component"].to_numpy()[None, :]
    if (side == 2).any():
        differ &= ids[:, None] < ids_y[None, :]
    if not differ.any():
        return []
    gx, gy = [shingles(t) for t in x["text"]], [shingles(t) for t in y["text"]]
    n, m = np.array([len(g) for g in gx])[:, None], np.array([len(g) for g in gy])[None, :]
    need = np.ceil(similarity * (n + m) / (1 + similarity) - 1e-9)
    common = _common([_labelled(g) for g in gx], [_labelled(g) for g in gy])
    return [(int(ids[i]), int(ids_y[j])) for i, j in zip(*np.nonzero(differ & (common >= need)))
            if matched(gx[i].tolist(), gy[j].tolist(), int(need[i, j])) >= need[i, j]]


def _squares(similarity: float):
    """Rows come sorted by square (group, i, j); a square may run over several batches."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry, found = None, []
        for b in batches:
            b = b if carry is None else pd.concat([carry, b], ignore_index=True)
            k = b[["grp", "i", "j"]].to_numpy()
            cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist()]
            for s, e in zip(cuts, cuts[1:]):
                found += _square(b.iloc[s:e], similarity)
            carry = b.iloc[cuts[-1]:]
        if carry is not None and len(carry):
            found += _square(carry, similarity)
        yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    return run


def across_groups(members: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between texts of one group and of different components; members
    (id, grp, component).  A square holds at most about 2 SIDE texts."""
    blocks = members.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / SIDE).cast("int").alias("blocks"))
    m = members.join(blocks, "grp").withColumn("at", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # Side 0 fills rows, 1 columns, 2 both (a square on the diagonal).
    spots = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least("at", o).alias("i"), F.greatest("at", o).alias("j"),
        F.when(F.col("at") == o, 2).when(F.col("at") < o, 0).otherwise(1).alias("side")))
    light = m.select("id", "grp", "component", F.explode(spots).alias("s")).select("id", "grp", "component", "s.*")
    return light.join(texts.select("id", "text"), "id").repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j") \
        .mapInPandas(_squares(similarity), "a long, b long")


def verify(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose texts (id, text) are similar."""
    one = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    both = one.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInPandas(_verified(similarity), "a long, b long")


def _in_several(of: DataFrame) -> DataFrame:
    """Rows (key, id, n, component) of the buckets that hold several components."""
    split = of.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    return of.join(split, "key", "left_semi")


def _across(of: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of a bucket in different components and of fitting lengths."""
    rest = _in_several(of)
    x = rest.select("key", F.col("id").alias("a"), F.col("n").alias("an"), F.col("component").alias("ac"))
    y = rest.select("key", F.col("id").alias("b"), F.col("n").alias("bn"), F.col("component").alias("bc"))
    fits = (F.col("an") >= F.col("bn") * similarity - 1e-9) & (F.col("bn") >= F.col("an") * similarity - 1e-9)
    return x.join(y, "key").where(fits & (F.col("ac") != F.col("bc")) & (F.col("a") < F.col("b"))).select("a", "b").distinct()


def _lines(docs: DataFrame, text: str, key: str) -> DataFrame:
    """doc_id, text and the text's digest.  Ids are strings on their way through Python,
    where a column of numbers and nulls would lose digits."""
    return docs.select(F.col(f"`{key}`").cast("long").cast("string").alias("doc_id"),
                       F.col(f"`{text}`").cast("string").alias("text")).withColumn("raw", F.md5("text"))


def classified(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """Per row of ``docs``: doc_id, raw (MD5 of the text), class_id and chosen, whether this id and
    text is the one that its class keeps; class_id is null for rows that no class holds."""
    ship(docs.sparkSession)
    d = _lines(docs, text, key)
    sk = d.mapInPandas(_sketched, "doc_id string, raw string, n long, d1 long, d2 long, keys array<long>")
    sk = stored(sk.withColumn("doc_id", F.col("doc_id").cast("long")), "sketches")
    worded = sk.where("n > 0 AND doc_id IS NOT NULL")
    first = F.min(F.struct("doc_id", "raw"))
    classes = stored(worded.groupBy("d1", "d2").agg(first.alias("top"), F.first("n").alias("n"), F.first("keys").alias("keys"))
                     .select("d1", "d2", "top", "n", "keys", F.monotonically_increasing_id().alias("id")), "classes")
    entered = stored(classes.select("id", "n", F.explode(F.array_distinct("keys")).alias("key")), "buckets")
    sizes = entered.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    held = stored(entered.join(sizes, "key"), "shared-buckets")
    central = held.groupBy("id").agg(F.sum("size").alias("rank"))
    hubs = held.select("key", "id").join(central, "id").groupBy("key") \
        .agg(F.max(F.struct("rank", (-F.col("id")).alias("id"))).alias("top")).select("key", (-F.col("top.id")).alias("hub"))
    to_hub = stored(held.select("key", "id").join(hubs, "key").where("id <> hub")
                    .select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct(), "hub-pairs")

    # The text of a class is that of its least id and digest; exact repeats of that row are one.
    shared = classes.join(held.select("id").distinct(), "id", "left_semi").select("id", F.col("top.doc_id").alias("top_id"),
                                                                                  F.col("top.raw").alias("top_raw"))
    texts = d.join(shared, (F.col("doc_id").cast("long") == F.col("top_id")) & (F.col("raw") == F.col("top_raw")))
    texts = stored(texts.groupBy("id").agg(F.first("text").alias("text")), "pair-texts")
    links = stored(verify(to_hub, texts, similarity), "hub-links")
    comp = stored(components(links), "hub-components")
    of = stored(held.join(comp, "id", "left").select("key", "id", "n", "size", F.coalesce("component", "id").alias("component")),
                "bucket-components")
    few = _across(of.where(F.col("size") <= FEW), similarity)
    many = stored(_in_several(of.where(F.col("size") > FEW)), "mixed-buckets")
    least = many.groupBy("key").agg(F.min("id").alias("least"))
    grp = components(many.select("key", "id").join(least, "key").where("id > least").select("id", "least").distinct(), "id", "least")
    grouped = stored(many.select("id", "component").distinct().join(grp.select("id", F.col("component").alias("grp")), "id"), "groups")
    wide = stored(across_groups(grouped, texts, similarity), "wide-links")
    more = stored(verify(few, texts, similarity), "cross-links")
    final = components(links.unionByName(more).unionByName(wide))
    member = classes.select("id", "d1", "d2", "top").join(final, "id", "left") \
        .select("d1", "d2", "top", F.coalesce("component", "id").alias("component"))
    member = stored(member, "members")
    tops = member.groupBy("component").agg(F.min("top").alias("chosen"))
    named = member.join(tops, "component").select("d1", "d2", "chosen", F.lit(True).alias("held"))
    lines = sk.select("doc_id", "raw", "d1", "d2", F.expr("n > 0 AND doc_id IS NOT NULL").alias("held"))
    return lines.join(named, ["d1", "d2", "held"], "left").select(
        "doc_id", "raw", F.col("chosen.doc_id").alias("class_id"),
        (F.struct("doc_id", "raw") == F.col("chosen")).alias("chosen"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id",
                    similarity: float = SIMILARITY) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id (least id of its class), kept."""
    rows = classified(docs, text, key, similarity)
    return rows.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                       F.coalesce("chosen", F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """``docs``, all columns, with one row of each class; rows that no class holds all stay."""
    own = unused(docs, "_wm_id"), unused(docs, "_wm_raw")
    rows = stored(classified(docs, text, key, similarity).where("class_id IS NOT NULL"), "classified")
    pair = [F.col("doc_id").alias(own[0]), F.col("raw").alias(own[1])]
    gone = rows.where(~F.col("chosen")).select(*pair).distinct()
    again = stored(rows.where("chosen").groupBy("doc_id", "raw").count().where("count > 1").select(*pair), "repeated-rows")
    tagged = docs.withColumn(own[0], F.col(f"`{key}`").cast("long")).withColumn(own[1], F.md5(F.col(f"`{text}`").cast("string")))
    left = tagged.join(gone, list(own), "left_anti")
    once = left.join(again, list(own), "left_semi").dropDuplicates(list(own))
    return left.join(again, list(own), "left_anti").unionByName(once).select(*[F.col(f"`{c}`") for c in docs.columns])
