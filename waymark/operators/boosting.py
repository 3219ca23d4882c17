"""Gradient-boosted regression trees without a Spark job for every few operations.

Spark ML's ``GBTRegressor`` runs several jobs for every level of every tree: 400 rounds of depth 8
are 3,200 levels, whose scheduling costs more than their work.  ``BoostedTrees`` grows the same trees (same
bins, candidates, gains, ties and pruning) from rows that are binned once into a byte a feature.  Up to
``ALONE_ROWS`` rows, all trees grow in one task.  Larger tables are dealt over the session's
slots, and a level is one small job: every task counts its rows, the driver adds the counts
and chooses the splits.  The result is Spark ML's own ``GBTRegressionModel``.

* All rows take part in every split; only the candidates' thresholds of a table of more than 10,000
  rows come from a sample of that size, as in Spark ML.
* Up to ``EXACT_ROWS`` rows are added in Spark ML's order, so the model equals Spark ML's to the bit.
  Larger tables count joint cells of several features and only the smaller child of a split (the
  other one is the parent less its sibling): equal but for rounding.
* Python workers keep their rows' state (about 35 bytes a row) between the jobs.  It is a cache: a worker
  without it, or behind, gets the rows from Spark's stored blocks and replays the log of splits.
* Parameters that this form doesn't know and tables beyond ``MOST_ROWS`` a slot are left to Spark ML.
"""

from __future__ import annotations

import json
import math
import uuid
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.session import scratch_path, ship

#: Rows that are added in Spark ML's order, rows that one task takes alone, rows of a task
#: otherwise (at least), rows that a slot may hold.
EXACT_ROWS, ALONE_ROWS, TASK_ROWS, MOST_ROWS = 25_000, 4_000_000, 250_000, 4_000_000
#: Entries of the log that travel with a job; the older ones are broadcast.
RECENT = 64
#: Sent with each job: a short message waits some 40 ms in the worker's socket for an acknowledgement.
FILL = bytes(1 << 17)
#: Cells of a joint histogram, and rows that are counted at once.
CELLS, CHUNK = 1024, 1 << 18
#: Rows that the thresholds come from (Spark ML's number).
SAMPLE_ROWS = 10_000
#: The smallest impurity of a node that may split.
EPSILON = 2.220446049250313e-16

NODES = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,"
         "rawCount:bigint,gain:double,leftChild:int,rightChild:int,"
         "split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` thresholds halfway between neighbouring values: all of them, or those
    nearest to equal shares of the rows."""
    v, w = np.unique(np.where(values == 0, 0.0, values), return_counts=True)
    middle = (v[:-1] + v[1:]) / 2.0
    if len(middle) <= bins - 1:
        return middle
    stride = len(values) / bins
    seen, target, out = float(w[0]), stride, []
    for i, c in enumerate(w[1:].tolist()):
        before, seen = seen, seen + c
        if abs(before - target) < abs(seen - target):
            out.append(middle[i])
            target += stride
    return np.array(out)


def _binned(cuts: list[np.ndarray | None]):
    """Rows as their bins (a byte a feature), label and validation flag."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, len(cuts))
            if not np.isfinite(x).all():
                raise ValueError("feature values must not be NaN or Infinity")
            out = np.empty((n, len(cuts)), np.int8)
            for f, c in enumerate(cuts):
                out[:, f] = x[:, f] if c is None else np.searchsorted(c, x[:, f])
            data = pa.py_buffer(out.tobytes())
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(cuts)), n, [None, data])
            yield pa.RecordBatch.from_arrays([packed.cast(pa.binary()), b.column(1), b.column(2)], ["bins", "y", "v"])
    return run


def _groups(sizes: list[int], exact: bool) -> list[list[int]]:
    """Features that share a histogram of at most ``CELLS`` joint cells."""
    out: list[list[int]] = []
    for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
        home = next((g for g in out if math.prod(sizes[i] for i in g) * sizes[f] <= CELLS), None)
        if home is None or exact:
            out.append([f])
        else:
            home.append(f)
    return out


class _Counts:
    """Histograms of the rows of one task."""

    def __init__(self, bins: np.ndarray, sizes: list[int], exact: bool):
        self.sizes, self.exact, self.most = sizes, exact, max(sizes)
        self.groups, self.codes = _groups(sizes, exact), []
        for g in self.groups:
            code = np.zeros(len(bins), np.int16)
            for f in g:
                code = code * np.int16(sizes[f]) + bins[:, f]
            self.codes.append(code.astype(np.int16))

    def of(self, at: np.ndarray, r: np.ndarray, slot: np.ndarray, k: int) -> np.ndarray:
        """Count, sum and (exact form) sum of squares of ``r`` by node, feature and bin, for the
        nodes that ``slot`` numbers; -1 there leaves a node out."""
        stats = 3 if self.exact else 2
        joint = [np.zeros((stats, k * math.prod(self.sizes[f] for f in g))) for g in self.groups]
        whole = bool((slot >= 0).all())
        for a in range(0, len(at), CHUNK):
            s = slot[at[a:a + CHUNK]]
            w = r[a:a + CHUNK]
            take = None
            if not whole:
                take = np.flatnonzero(s >= 0)
                s, w = s[take], w[take]
            for g, code, h in zip(self.groups, self.codes, joint):
                c = code[a:a + CHUNK]
                i = s * (h.shape[1] // k)
                i += c if take is None else c[take]
                h[0] += np.bincount(i, minlength=h.shape[1])
                h[1] += np.bincount(i, w, h.shape[1])
                if self.exact:
                    h[2] += np.bincount(i, w * w, h.shape[1])
        out = np.zeros((3, k, len(self.sizes), self.most))
        for g, h in zip(self.groups, joint):
            cells = h.reshape(stats, k, *[self.sizes[f] for f in g])
            for at_, f in enumerate(g):
                other = tuple(i + 2 for i in range(len(g)) if i != at_)
                out[:stats, :, f, :self.sizes[f]] = cells.sum(axis=other) if other else cells
        return out


def _variance(s: np.ndarray) -> np.ndarray:
    n = np.where(s[0] == 0, 1.0, s[0])
    return np.where(s[0] == 0, 0.0, (s[2] - s[1] * s[1] / n) / n)


def _best(h: np.ndarray, parent: np.ndarray | None, splits: np.ndarray, binary: np.ndarray, least: int, gain_least: float):
    """The best split of each node: gain, feature, place, whether a binary feature's 1 goes left, and the
    statistics of the node and its children."""
    k = h.shape[1]
    nodes = np.arange(k)
    swapped = np.zeros(h.shape[1:3], bool)
    if binary.any():
        pair = h[:, :, binary, :2]
        mean = np.where(pair[0] == 0, np.finfo(float).max, pair[1] / np.where(pair[0] == 0, 1.0, pair[0]))
        swap = mean[..., 1] < mean[..., 0]
        h = h.copy()
        h[:, :, binary, :2] = np.where(swap[None, ..., None], pair[..., ::-1], pair)
        swapped[:, binary] = swap
    left = np.cumsum(h, axis=3)
    total = left[..., -1:]
    right = total - left
    if parent is None:
        f = int(np.flatnonzero(splits > 0)[0])
        parent = left[:, :, f, 0] + right[:, :, f, 0]
    n = left[0] + right[0]
    n[n == 0] = 1.0
    gain = _variance(parent)[:, None, None] - left[0] / n * _variance(left) - right[0] / n * _variance(right)
    ok = (left[0] >= least) & (right[0] >= least) & (gain >= gain_least)
    ok &= np.arange(h.shape[3])[None, None, :] < splits[None, :, None]
    gain = np.where(ok, gain, -np.inf).reshape(k, -1)
    best = gain.argmax(axis=1)
    f, s = best // h.shape[3], best % h.shape[3]
    return gain[nodes, best], f, s, swapped[nodes, f], parent, left[:, nodes, f, s], right[:, nodes, f, s]


class _Share:
    """A share of the rows: where they are in the tree that grows, and what is left to explain."""

    def __init__(self, p: dict, bins: np.ndarray, y: np.ndarray, v: np.ndarray):
        self.p, self.width, self.done = p, len(p["cuts"]), 0
        self.held = bins[v].ravel(), y[v], np.zeros(int(v.sum()))
        if v.any():
            bins, y = bins[~v], y[~v]
        self.bins, self.y = bins.ravel(), y
        self.r, self.pred = y.copy(), np.zeros(len(y)) if p["exact"] else None
        kind = np.int16 if p["depth"] < 14 else np.int32
        self.at, self.held_at = np.zeros(len(y), kind), np.zeros(len(self.held[1]), kind)
        self.counts = _Counts(bins, [2 if c is None else len(c) + 1 for c in p["cuts"]], p["exact"])
        self.first, self.told = True, None

    def histogram(self, slot: np.ndarray, k: int) -> np.ndarray:
        return self.counts.of(self.at, self.r, slot, k)

    def move(self, feature: np.ndarray, place: np.ndarray, child: np.ndarray) -> None:
        """Rows move from their node to the child of its split, or stay."""
        for at, bins in ((self.at, self.bins), (self.held_at, self.held[0])):
            for a in range(0, len(at), CHUNK):
                x = at[a:a + CHUNK].astype(np.int64)
                i = np.arange(a * self.width, (a + len(x)) * self.width, self.width)
                i += feature[x]
                at[a:a + CHUNK] = child[2 * x + (bins[i] > place[x])]

    def settle(self, value: np.ndarray, weight: float) -> None:
        """The tree is grown: its leaves' values are explained."""
        square = np.zeros(len(value)) if self.p["exact"] else np.bincount(self.at, self.r * self.r, len(value))
        if self.p["exact"]:
            self.pred += value[self.at] * weight
            self.r = 2.0 * (self.y - self.pred)
        elif self.first:
            self.r = 2.0 * (self.r - value[self.at])
        else:
            self.r -= (2.0 * weight * value)[self.at]
        _, y, pred = self.held
        pred += value[self.held_at] * weight
        self.told = np.concatenate([square, [float(len(y)), float(((y - pred) ** 2).sum())]])
        self.at[:], self.held_at[:], self.first = 0, 0, False

    def told_last(self) -> np.ndarray:
        """Of the tree that was settled last: squares by leaf, held-out rows and their squared error."""
        return self.told


#: The shares that this worker holds, by fit and partition.
_SHARES: dict[tuple[str, int], _Share] = {}


class _Spread:
    """The shares of all tasks, behind the same calls.  What changes them goes into a log, which
    every task catches up with before it counts."""

    def __init__(self, packed: DataFrame, p: dict):
        self.p, self.fit, self.sc = p, uuid.uuid4().hex, packed.sparkSession.sparkContext
        self.sizes = np.array([2 if c is None else len(c) + 1 for c in p["cuts"]])
        self.used = np.arange(self.sizes.max())[None, :] < self.sizes[:, None]
        self.log, self.sent, self.old = [], 0, None
        dealt = packed.repartition(p["tasks"]).mapInArrow(_whole(len(p["cuts"])), "bins binary, y binary, v binary")
        self.blocks = dealt.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
        # A partition's number, kept where its block is, brings a job to that executor without the block.
        self.places = self.blocks.mapPartitionsWithIndex(lambda i, rows: [i for _ in rows]).persist()
        self.places.count()

    def _run(self, what: str, *args) -> list:
        if len(self.log) - self.sent > RECENT:
            if self.old is not None:
                self.old.unpersist()
            self.sent, self.old = len(self.log), self.sc.broadcast(list(self.log))
        ask = _ask(self.fit, self.p, what, args, self.sent, self.old, self.log[self.sent:], self.used)
        got = dict(self.sc.runJob(self.places, ask))
        lost = sorted(i for i, x in got.items() if x is None)
        if lost:
            number = self.blocks.mapPartitionsWithIndex(lambda i, rows: ((i, x) for x in rows))
            got.update(self.sc.runJob(number, ask, lost))
        return [got[i] for i in sorted(got)]

    def histogram(self, slot: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros((3, k, *self.used.shape))
        for n, s in self._run("histogram", slot, k):
            out[0][:, self.used] += n
            out[1][:, self.used] += s
        return out

    def move(self, *entry) -> None:
        self.log.append(("move", *entry))

    def settle(self, *entry) -> None:
        self.log.append(("settle", *entry))

    def told_last(self) -> np.ndarray:
        return np.sum(self._run("told_last"), axis=0)

    def close(self) -> None:
        self.places.unpersist()
        self.blocks.unpersist()
        if self.old is not None:
            self.old.unpersist()


def _ask(fit: str, p: dict, what: str, args: tuple, start: int, old, recent: list, used: np.ndarray):
    """A task that catches up with the log and answers; None if it has neither the share nor its rows."""
    fill = FILL

    def run(rows: Iterator) -> Iterator[tuple[int, object]]:
        assert fill
        for row in rows:
            number, block = row if isinstance(row, tuple) else (row, None)
            for key in [key for key in _SHARES if key[0] != fit]:      # another fit's
                del _SHARES[key]
            share = _SHARES.get((fit, number))
            if share is None:
                if block is None:
                    yield number, None
                    continue
                bins, y, v = block
                share = _SHARES[fit, number] = _Share(p, np.frombuffer(bins, np.int8).reshape(-1, len(p["cuts"])),
                                                      np.frombuffer(y, np.float64), np.frombuffer(v, np.bool_))
            if share.done < start:
                for name, *entry in old.value[share.done:]:
                    getattr(share, name)(*entry)
                share.done = start
            for name, *entry in recent[share.done - start:]:
                getattr(share, name)(*entry)
            share.done = start + len(recent)
            got = getattr(share, what)(*args)
            yield number, (got[0][:, used].astype(np.int32), got[1][:, used]) if what == "histogram" else got
    return run


class _Grower:
    """Chooses the splits, from the counts of one share or of all."""

    def __init__(self, p: dict, rows: _Share | _Spread):
        self.p, self.rows = p, rows
        self.binary = np.array([c is None for c in p["cuts"]])
        self.splits = np.array([1 if c is None else len(c) for c in p["cuts"]])

    def tree(self) -> dict:
        """Grow one tree; its nodes."""
        p = self.p
        nodes = {"feature": [0], "place": [0], "swap": [False], "gain": [-1.0], "left": [-1], "right": [-1], "stats": [None]}
        feature, place, stats = nodes["feature"], nodes["place"], nodes["stats"]
        open_, parent, before, pairs = [0], None, None, []
        for level in range(p["depth"]):
            slot = np.full(len(feature), -1, np.int64)
            if not pairs:
                slot[open_] = np.arange(len(open_))
                h = self.rows.histogram(slot, len(open_))
            else:
                # Of two siblings only the smaller is counted; the other is their parent less it.
                less, more, above = np.array(pairs).T
                slot[np.array(open_)[less]] = np.arange(len(pairs))
                part = self.rows.histogram(slot, len(pairs))
                h = np.empty((3, len(open_), *part.shape[2:]))
                h[:, less], h[:, more] = part, before[:, above] - part
            gain, f, s, swap, own, left, right = _best(h, parent, self.splits, self.binary, p["least"], p["gain"])
            if stats[0] is None:
                stats[0] = own[:, 0]
            child = np.arange(2 * len(feature)) // 2
            open_, grown, grown_stats, pairs, was = [], np.flatnonzero(gain > 0), [], [], open_
            for j in grown.tolist():
                node, a = was[j], len(feature)
                feature[node], nodes["gain"][node], nodes["swap"][node] = int(f[j]), float(gain[j]), bool(swap[j])
                place[node] = int(s[j])
                nodes["left"][node], nodes["right"][node] = a, a + 1
                child[2 * node:2 * node + 2] = (a + 1, a) if swap[j] else (a, a + 1)
                for x in (left[:, j], right[:, j]):
                    for key, value in (("feature", 0), ("place", 0), ("swap", False), ("gain", -1.0), ("left", -1), ("right", -1), ("stats", x)):
                        nodes[key].append(value)
                    if level + 1 < p["depth"] and not (p["exact"] and abs(float(_variance(x))) < EPSILON):
                        open_.append(len(feature) - 1)
                        grown_stats.append(x)
                if not p["exact"] and level + 1 < p["depth"]:
                    last = len(open_) - 1
                    pairs.append((last - 1, last, j) if left[0, j] <= right[0, j] else (last, last - 1, j))
            n = len(child) // 2
            self.rows.move(np.array(feature[:n], np.int16), np.array(place[:n], np.int8), child.astype(np.int32))
            if not open_:
                break
            parent, before = np.array(grown_stats).T, h
        return nodes

    def grow(self) -> Iterator[dict]:
        """The trees, as long as the held-out rows (if there are any) gain from them."""
        p, trees, best, error = self.p, [], 0, 0.0
        for m in range(p["rounds"]):
            nodes = self.tree()
            stats = np.array(nodes["stats"]).T
            value = np.where(stats[0] == 0, 0.0, stats[1] / np.where(stats[0] == 0, 1.0, stats[0]))
            self.rows.settle(value, p["step"] if m else 1.0)
            *square, n, off = self.rows.told_last()
            if not p["exact"]:
                for i in range(len(square) - 1, -1, -1):
                    if nodes["left"][i] >= 0:
                        square[i] = square[nodes["left"][i]] + square[nodes["right"][i]]
                stats[2] = square
            nodes["stats"], nodes["value"], nodes["impurity"] = stats, value, _variance(stats)
            trees.append(nodes)
            if not p["held"]:
                best = m + 1
                continue
            off = off / n if n else 0.0
            if m and error - off < p["tolerance"] * max(off, 0.01):
                break
            if not m or off < error:
                best, error = m + 1, off
        return iter(trees[:best])

    def rows_out(self) -> Iterator[pa.RecordBatch]:
        """The nodes of each tree in the order of Spark ML's files; children that predict the same are one leaf."""
        schema = pa.schema([("treeID", pa.int32()), ("nodeData", pa.struct([
            ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
            ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
            ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                                 ("numCategories", pa.int32())]))]))])
        cuts = self.p["cuts"]
        for m, t in enumerate(self.grow()):
            left, right, value = t["left"], t["right"], t["value"].tolist()
            for i in range(len(left) - 1, -1, -1):
                a, b = left[i], right[i]
                if a >= 0 and left[a] < 0 and left[b] < 0 and value[a] == value[b]:
                    left[i] = right[i] = -1
            out, stack, number = [], [0], {}
            while stack:
                i = stack.pop()
                number[i] = len(number)
                if left[i] >= 0:
                    stack += [right[i], left[i]]
            for i, at in number.items():
                inner, f = left[i] >= 0, t["feature"][i]
                if not inner:
                    split = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
                elif cuts[f] is None:
                    split = {"featureIndex": f, "leftCategoriesOrThreshold": [float(t["swap"][i])], "numCategories": 2}
                else:
                    split = {"featureIndex": f, "leftCategoriesOrThreshold": [float(cuts[f][t["place"][i]])], "numCategories": -1}
                s = t["stats"][:, i]
                out.append({"treeID": m, "nodeData": {
                    "id": at, "prediction": value[i], "impurity": float(t["impurity"][i]), "impurityStats": s.tolist(),
                    "rawCount": int(s[0]), "gain": t["gain"][i] if inner else -1.0, "leftChild": number[left[i]] if inner else -1,
                    "rightChild": number[right[i]] if inner else -1, "split": split}})
            yield pa.RecordBatch.from_pylist(out, schema)


def _whole(width: int):
    """All rows of a task as one row of three arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, y, v = _joined(batches, width)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (bins, y, v)], ["bins", "y", "v"])
    return run


def _joined(batches: Iterator[pa.RecordBatch], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [(np.empty((0, width), np.int8), np.empty(0), np.empty(0, bool))]
    for b in batches:
        if b.num_rows:
            x = b.column(0).cast(pa.binary(width))
            raw = np.frombuffer(x.buffers()[1], np.int8, b.num_rows * width, x.offset * width)
            parts.append((raw.reshape(-1, width).copy(), b.column(1).to_numpy().copy(), b.column(2).to_numpy(zero_copy_only=False)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _alone(p: dict):
    """The task that holds all rows and grows all trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _Grower(p, _Share(p, *_joined(batches, len(p["cuts"])))).rows_out()
    return run


class BoostedTrees(GBTRegressor):
    """``GBTRegressor`` whose trees are grown in one job."""

    def _slots(self, spark) -> int:
        """Tasks that run at once."""
        sc = spark.sparkContext._jsc.sc()
        return max(1, sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile()))

    def _known(self) -> bool:
        """Whether the parameters are all among those that this form has."""
        return (self.getLossType() == "squared" and self.getSubsamplingRate() == 1.0 and self.getMaxBins() <= 127
                and self.getFeatureSubsetStrategy() == "all" and self.getMinWeightFractionPerNode() == 0.0
                and self.getMaxDepth() > 0 and not self.isDefined("weightCol") and not self.getLeafCol())

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        spark = dataset.sparkSession
        held = self.isDefined("validationIndicatorCol")
        y = F.col(self.getLabelCol()).cast("double")
        y = F.when(y.isNull() | F.isnan(y), F.raise_error(F.lit("a label is missing"))).otherwise(y)
        x = vector_to_array(F.col(self.getFeaturesCol()))
        rows = dataset.select(x.alias("x"), y.alias("y"), (F.col(self.getValidationIndicatorCol()) if held else F.lit(False)).alias("v"))
        attrs = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {})
        kinds, width = attrs.get("attrs", {}), attrs.get("num_attrs", 0)
        total, n = rows.agg(F.count(F.lit(1)), F.count_if(~F.col("v"))).first()
        slots = self._slots(spark)
        if not self._known() or n < 2 or not width or set(kinds) - {"binary", "numeric"} or total > slots * MOST_ROWS:
            return super()._fit(dataset)
        bins = min(self.getMaxBins(), n)
        some = rows.where("NOT v").select("x")
        if n > SAMPLE_ROWS:
            some = some.sample(SAMPLE_ROWS / n, self.getSeed() % (1 << 31))
        seen = np.array([r.x for r in some.collect()], np.float64)
        binary = {a["idx"] for a in kinds.get("binary", [])}
        cuts = [None if f in binary else thresholds(seen[:, f], bins) for f in range(width)]
        tasks = 1 if total <= ALONE_ROWS else min(slots, -(-total // TASK_ROWS))
        p = dict(cuts=cuts, tasks=tasks, exact=total <= EXACT_ROWS, depth=self.getMaxDepth(), rounds=self.getMaxIter(), step=self.getStepSize(),
                 least=self.getMinInstancesPerNode(), gain=self.getMinInfoGain(), held=held, tolerance=self.getValidationTol())
        ship(spark)
        packed, path = rows.mapInArrow(_binned(cuts), "bins binary, y double, v boolean"), scratch_path(spark, "boosted")
        if tasks == 1:
            packed.coalesce(1).mapInArrow(_alone(p), NODES).write.parquet(f"{path}/data")
        else:
            spread = _Spread(packed, p)
            try:
                nodes = pa.Table.from_batches(list(_Grower(p, spread).rows_out()))
            finally:
                spread.close()
            spark.createDataFrame(nodes, NODES).write.parquet(f"{path}/data")
        return self._copyValues(self._loaded(spark, path, width))

    def _loaded(self, spark, path: str, width: int) -> GBTRegressionModel:
        """The model of the nodes under ``path``, by way of the files that Spark ML reads one from."""
        self.write().save(f"{path}/estimator")
        meta = json.loads(spark.read.text(f"{path}/estimator/metadata").first()[0])
        names = ("cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB",
                 "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed")
        tree = {**meta, "class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "uid": f"dtr_{self.uid}",
                **{k: {n: v for n, v in meta[k].items() if n in names} for k in ("paramMap", "defaultParamMap")}}
        trees = spark.read.parquet(f"{path}/data").select("treeID").distinct()
        trees.select(F.col("treeID").alias("_1"), F.lit(json.dumps(tree)).alias("_2"),
                     F.when(F.col("treeID") == 0, F.lit(1.0)).otherwise(F.lit(self.getStepSize())).alias("_3")) \
            .coalesce(1).write.parquet(f"{path}/treesMetadata")
        meta |= {"class": "org.apache.spark.ml.regression.GBTRegressionModel", "numFeatures": width, "numTrees": trees.count()}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        return GBTRegressionModel.load(path)


# ------------------------------------------------------------------ scoring

#: Trees deeper than this are walked by Spark ML; bytes of the answers to all conditions for one chunk of rows.
DEEPEST, ANSWERS = 12, 1 << 20
_WALKS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _walk(model: GBTRegressionModel):
    """The trees as complete binary trees over the distinct conditions (feature, threshold), broadcast;
    None for a model that has no such form."""
    from pyspark.sql import SparkSession
    depth = model.getMaxDepth()
    if depth > DEEPEST:
        return None
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "walk")
    model.write().save(path)
    d = F.col("nodeData")
    t = spark.read.parquet(f"{path}/data").select(
        "treeID", d.id.alias("id"), d.prediction.alias("value"), d.leftChild.alias("left"), d.rightChild.alias("right"),
        d.split.featureIndex.alias("f"), F.get(d.split.leftCategoriesOrThreshold, F.lit(0)).alias("cut"), d.split.numCategories.alias("kind")).toArrow()
    t = {c: t.column(c).to_numpy(zero_copy_only=False) for c in t.column_names}
    if ((t["kind"] >= 0) & (t["kind"] != 2)).any():
        return None
    order = np.lexsort((t["id"], t["treeID"]))
    t = {c: x[order] for c, x in t.items()}
    root = np.flatnonzero(t["id"] == 0)
    start = root[np.searchsorted(t["treeID"][root], t["treeID"])]
    inner, two = t["left"] >= 0, t["kind"] == 2
    swap = two & (t["cut"] == 1.0)                      # 1 goes left
    low, high = np.where(swap, t["right"], t["left"]) + start, np.where(swap, t["left"], t["right"]) + start
    cut = np.where(two, 0.5, t["cut"])
    asked, which = np.unique(np.stack([t["f"][inner].astype(np.float64), cut[inner]]), axis=1, return_inverse=True)
    place = np.zeros(len(inner), np.int32)
    place[inner] = which.ravel()
    # A leaf above the last level asks anything and has itself for both children.
    at, levels = root[:, None], []
    for _ in range(depth):
        levels.append(place[at])
        at = np.stack([np.where(inner, low, np.arange(len(inner)))[at], np.where(inner, high, np.arange(len(inner)))[at]], axis=2)
        at = at.reshape(len(root), -1)
    values = t["value"][at] * np.array(model.treeWeights)[:, None]
    return spark.sparkContext.broadcast((asked[0].astype(np.int64), asked[1], levels, values))


def _walked(x: np.ndarray, features: np.ndarray, cuts: np.ndarray, levels: list[np.ndarray], values: np.ndarray) -> np.ndarray:
    """Predictions of the rows ``x``: a tree at a time over a chunk of rows, whose tables stay in the
    processor's cache, where walking all trees for one row would not."""
    out = np.zeros(len(x))
    size = max(256, ANSWERS // max(1, len(cuts)))
    for a in range(0, len(x), size):
        c = x[a:a + size]
        n = len(c)
        answers = np.logical_not(c.T[features] <= cuts[:, None]).astype(np.uint8).ravel()
        if not len(answers):
            answers = np.zeros(n, np.uint8)
        ask = [q.astype(np.int64) * n for q in levels]
        rows, i, go, total = np.arange(n), np.empty(n, np.int64), np.empty(n, np.uint8), out[a:a + n]
        for t in range(len(values)):
            node = np.zeros(n, np.int64)
            for q in ask:
                np.take(q[t], node, out=i, mode="clip")
                i += rows
                np.take(answers, i, out=go, mode="clip")
                node <<= 1
                node += go
            total += values[t][node]
    return out


def predicted(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``model.transform(df)``, with the trees walked by ``_walked``."""
    gbt = model.stages[-1]
    if not isinstance(gbt, GBTRegressionModel):
        return model.transform(df)
    if gbt not in _WALKS:
        _WALKS[gbt] = _walk(gbt)
    trees = _WALKS[gbt]
    if trees is None:
        return model.transform(df)
    ship(df.sparkSession)

    def walk(x: pa.Array) -> pa.Array:
        return pa.array(_walked(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1), *trees.value))

    # Not deterministic to the optimizer, which would copy the walk into every filter on it.
    score = F.arrow_udf(walk, "double").asNondeterministic()
    rows = PipelineModel(stages=model.stages[:-1]).transform(df)
    return rows.withColumn(gbt.getPredictionCol(), score(vector_to_array(F.col(gbt.getFeaturesCol()))))
