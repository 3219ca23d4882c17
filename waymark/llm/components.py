"""Connected components of a link table by alternating large-star and small-star steps.

Every step is two joins of the links with a per-node minimum (a map-side-combined
aggregate); a hub with a third of all links is split by the adaptive join, and no
neighbour list is ever gathered.  Each round is a written table.  Once a counted
``LOCAL_LINKS`` links or fewer are left, one task finishes them with a union-find; the
result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import stored


LOCAL_LINKS = 200_000


def _finished(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for b in batches:
        for u, v in zip(b["u"].tolist(), b["v"].tolist()):
            a, c = find(u), find(v)
            root[max(a, c)] = min(a, c)
    ids = list(root)
    yield pd.DataFrame({"id": ids, "component": [find(x) for x in ids]}, dtype="int64")


def _print_of(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` of every node with a link: the smallest id it is connected to.

    ``links``: two bigint columns in any direction; nulls, self-links and
    repeats are allowed and ignored.
    """
    u, v = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    e = stored(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
               .select(u.cast("long").alias("u"), v.cast("long").alias("v")).distinct(), "links")
    seen = _print_of(e)
    while seen[0] > LOCAL_LINKS:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        e = stored(small, "small-star")
        now = _print_of(e)
        if now == seen:
            break
        seen = now
    else:
        return e.coalesce(1).mapInPandas(_finished, "id long, component long")
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
