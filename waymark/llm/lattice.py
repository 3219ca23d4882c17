"""Embedding near-duplicates by E8 lattice hashing.

Each of ``TABLES`` tables projects the unit vector onto eight random directions,
scales by ``SCALE`` and decodes to the nearest point of the E8 lattice (the nearer
of the best points of D8 and of D8 + 1/2).  A vector lies in that cell and looks
into it and into the ``PROBES`` neighbouring cells, of the 240 at the lattice's
minimum distance, that are next nearest to its projection.  Two vectors meet in
a table when either looks into the other's cell: at cosine 0.9 with probability
0.68, so eight tables miss such a pair with probability 1e-4 (closer pairs far
less).  What meets is verified by its cosine in double precision.

Equal vectors are one class, hashed once and counted by their number.  The rows
of a cell are dealt into squares of at most ``SIDE`` residents by ``SIDE``
visitors, so a cell with a third of all vectors spreads over many tasks.  A square
is one matrix product; it returns for each vector with a partner the partners to
count and the least vector its local partners connect it to, never the
pairs.  A pair that meets several times is counted at its first meeting, which
both vectors' cells tell.  Components come from the local stars.

Vectors that are null, empty, zero, or hold null or non-finite components link
with nothing and are their own component; vectors of different lengths never
meet.  Rows with a null id get no partners and a null component.  Repeated rows
count as other vectors.  Labels and other columns are not used.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import ship, stored
from waymark.llm.components import components
from waymark.llm.shingles import mixed

COSINE = 0.9
TABLES, PROBES, SCALE, SEED = 8, 4, 0.6, 20
SIDE = 2048


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


NEIGHBOURS = _minimal_vectors()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points of even coordinate sum."""
    r = np.rint(x)
    off = x - r
    worst = np.abs(off).argmax(axis=-1)[..., None]
    turn = np.where(np.take_along_axis(off, worst, -1) >= 0, 1.0, -1.0)
    odd = (r.sum(axis=-1, keepdims=True) % 2) != 0
    np.put_along_axis(r, worst, np.take_along_axis(r, worst, -1) + turn * odd, -1)
    return r


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points of points in the last axis."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(-1, keepdims=True) <= ((x - b) ** 2).sum(-1, keepdims=True)
    return np.where(nearer, a, b)


def _projected(unit: np.ndarray) -> np.ndarray:
    """(n, TABLES, 8).  Added up one component at a time, so that a vector's
    projection doesn't depend on the rows beside it."""
    r = np.random.default_rng((SEED, unit.shape[1])).normal(size=(unit.shape[1], TABLES * 8)) * SCALE
    out = np.zeros((len(unit), TABLES * 8))
    for j in range(unit.shape[1]):
        out += unit[:, j, None] * r[j]
    return out.reshape(len(unit), TABLES, 8)


def _hashed(points: np.ndarray, dim: int) -> np.ndarray:
    """64-bit names of lattice points; points is (n, TABLES, k, 8)."""
    doubled = np.rint(points * 2).astype(np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        h = np.broadcast_to((np.arange(TABLES, dtype=np.uint64) * np.uint64(1 << 32) + np.uint64(dim))[None, :, None],
                            doubled.shape[:-1])
        for c in range(8):
            h = mixed(h * np.uint64(0x100000001B3) + doubled[..., c])
    return h.view(np.int64)


def cells(unit: np.ndarray) -> np.ndarray:
    """(n, TABLES, 1 + PROBES): the vector's own cell, then the cells it looks into."""
    x = _projected(unit)
    own = decode(x)
    gain = (x - own) @ NEIGHBOURS.T
    near = np.argsort(-gain, axis=-1, kind="stable")[..., :PROBES]
    points = np.concatenate([own[..., None, :], own[..., None, :] + NEIGHBOURS[near]], axis=-2)
    return _hashed(points, unit.shape[1])


def unit_vectors(blobs: list[bytes]) -> np.ndarray:
    """Packed doubles of equal length as rows of unit length."""
    v = np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        blobs, d1, d2 = [], [], []
        for e in b["embedding"]:
            v = None if e is None else np.array([np.nan if x is None else x for x in e] if e.dtype == object else e, np.float64)
            ok = v is not None and len(v) and np.isfinite(v).all() and v.any()
            blob = (v + 0.0).tobytes() if ok else None       # + 0.0: no negative zeros
            x = np.frombuffer(xxhash.xxh3_128_digest(blob or b""), np.int64)
            blobs.append(blob)
            d1.append(x[0])
            d2.append(x[1])
        yield pd.DataFrame({"vec_id": b["vec_id"], "d1": d1, "d2": d2, "vec": blobs})


def _by_length(vecs: pd.Series) -> Iterator[np.ndarray]:
    """Positions of the vectors of each length."""
    n = vecs.map(len).to_numpy()
    for k in np.unique(n):
        yield np.flatnonzero(n == k)


def _placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for the cell a vector lies in (visitor false) and for each it looks into."""
    for b in batches:
        for at in _by_length(b["vec"]):
            part = b.iloc[at]
            c = cells(unit_vectors(list(part["vec"])))
            n, look = len(part), TABLES * (1 + PROBES)
            cell = np.concatenate([c[:, :, 0].reshape(-1), c.reshape(-1)])
            row = np.concatenate([np.repeat(np.arange(n), TABLES), np.repeat(np.arange(n), look)])
            yield pd.DataFrame({"cell": cell, "visitor": np.arange(len(cell)) >= n * TABLES,
                                "id": part["id"].to_numpy()[row], "m": part["m"].to_numpy()[row],
                                "vec": part["vec"].to_numpy()[row]})


def _first_meeting(cx: np.ndarray, cy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table of the first meeting of row pairs, and whether x looks into y's cell there.
    Cells are (n, TABLES, 1 + PROBES)."""
    x_sees = (cx == cy[:, :, :1]).any(-1)
    y_sees = (cy == cx[:, :, :1]).any(-1)
    table = (x_sees | y_sees).argmax(axis=1)
    return table, x_sees[np.arange(len(table)), table]


def _square(cell: int, res: pd.DataFrame, vis: pd.DataFrame) -> pd.DataFrame | None:
    if not len(res) or not len(vis):
        return None
    ur, uv = unit_vectors(list(res["vec"])), unit_vectors(list(vis["vec"]))
    ir, iv = res["id"].to_numpy(), vis["id"].to_numpy()
    i, j = np.nonzero((uv @ ur.T >= COSINE) & (iv[:, None] != ir[None, :]))
    if not len(i):
        return None
    nodes, local = np.unique(np.concatenate([iv[i], ir[j]]), return_inverse=True)
    x, y = local[:len(i)], local[len(i):]
    vec = dict(zip(iv.tolist(), range(len(iv))))
    vec_r = dict(zip(ir.tolist(), range(len(ir))))
    c = cells(np.array([uv[vec[k]] if k in vec else ur[vec_r[k]] for k in nodes.tolist()]))
    weight = np.zeros(len(nodes), np.int64)
    weight[x], weight[y] = vis["m"].to_numpy()[i], res["m"].to_numpy()[j]
    count = np.zeros(len(nodes), np.int64)
    for lo in range(0, len(x), 1 << 16):
        a, b = x[lo:lo + (1 << 16)], y[lo:lo + (1 << 16)]
        # Count where the pair first meets; if each sees the other there, where the lesser id looks.
        table, a_sees = _first_meeting(c[a], c[b])
        rows = np.arange(len(a))
        here = c[b, table, 0] == cell
        both = a_sees & (c[b] == c[a][:, :, :1]).any(-1)[rows, table]
        mine = here & a_sees & (~both | (nodes[a] < nodes[b]))
        np.add.at(count, a[mine], weight[b[mine]])
        np.add.at(count, b[mine], weight[a[mine]])
    root = np.arange(len(nodes))
    while True:                                  # least node of each local component
        new = root.copy()
        np.minimum.at(new, x, root[y])
        np.minimum.at(new, y, root[x])
        new = new[new]
        if (new == root).all():
            break
        root = new
    return pd.DataFrame({"id": nodes, "n": count, "root": nodes[root]})


def _squares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by square; a square may run over several batches."""
    carry: pd.DataFrame | None = None

    def solve(part: pd.DataFrame) -> pd.DataFrame | None:
        v = part["visitor"].to_numpy()
        return _square(int(part["cell"].iloc[0]), part[~v], part[v])

    for b in batches:
        if carry is not None:
            b = pd.concat([carry, b], ignore_index=True)
        k = b[["cell", "r", "c"]].to_numpy()
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist()]
        found = [x for s, e in zip(edges, edges[1:]) if (x := solve(b.iloc[s:e])) is not None]
        carry = b.iloc[edges[-1]:]
        if found:
            yield pd.concat(found)
    if carry is not None and len(carry) and (x := solve(carry)) is not None:
        yield x


def near_duplicates(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    ship(vectors.sparkSession)
    # Ids are strings on their way through Python, where numbers and nulls in one column lose digits.
    v = vectors.select(F.col(f"`{key}`").cast("long").cast("string").alias("vec_id"),
                       F.col(f"`{embedding}`").cast("array<double>").alias("embedding"))
    packed = v.mapInPandas(_packed, "vec_id string, d1 long, d2 long, vec binary")
    packed = stored(packed.withColumn("vec_id", F.col("vec_id").cast("long"))
                    .withColumn("linkable", F.expr("vec IS NOT NULL AND vec_id IS NOT NULL")), "vectors")
    # Equal vectors are a class of its own number: an id may stand by several vectors.
    classes = packed.where("linkable").groupBy("d1", "d2").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("m"), F.first("vec").alias("vec"))
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    rows = stored(classes.select("id", "m", "vec").mapInPandas(
        _placed, "cell long, visitor boolean, id long, m long, vec binary"), "cells")
    size = rows.groupBy("cell").agg(F.count(F.when(~F.col("visitor"), 1)).alias("nr"), F.count(F.when(F.col("visitor"), 1)).alias("nc"))
    # A cell that only its one resident looks into has no pairs.
    size = stored(size.where("nr > 0 AND nc > 1")
                  .select("cell", F.ceil(F.col("nr") / SIDE).cast("int").alias("nr"), F.ceil(F.col("nc") / SIDE).cast("int").alias("nc")),
                  "cell-sizes")
    spot = F.xxhash64("id")
    dealt = rows.join(size, "cell") \
        .withColumn("r", F.explode(F.when(F.col("visitor"), F.sequence(F.lit(0), F.col("nr") - 1))
                                   .otherwise(F.array(F.pmod(spot, F.col("nr")).cast("int"))))) \
        .withColumn("c", F.explode(F.when(~F.col("visitor"), F.sequence(F.lit(0), F.col("nc") - 1))
                                   .otherwise(F.array(F.pmod(spot, F.col("nc")).cast("int"))))) \
        .select("cell", "r", "c", "visitor", "id", "m", "vec")
    found = stored(dealt.repartition("cell", "r", "c").sortWithinPartitions("cell", "r", "c")
                   .mapInPandas(_squares, "id long, n long, root long"), "meetings")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    comp = components(found.where("id <> root").select("id", "root"), "id", "root")
    member = stored(classes.select("id", "d1", "d2", "least", "m").join(counts, "id", "left").join(comp, "id", "left")
                    .withColumn("component", F.coalesce("component", "id")), "vector-members")
    tops = member.groupBy("component").agg(F.min("least").alias("component_id"))
    known = member.join(tops, "component").select(
        "d1", "d2", F.lit(True).alias("linkable"), (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id")
    lines = packed.select("vec_id", "d1", "d2", "linkable").join(known, ["d1", "d2", "linkable"], "left")
    return lines.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        F.coalesce("component_id", "vec_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
