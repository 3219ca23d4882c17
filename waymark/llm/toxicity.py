"""Toxicity scores from a counterfactual-regularised classifier.

The model is a logistic regression over the presence of word features: whole
words, word beginnings and letter runs inside words, which also catches invented
inflections.  For every labelled text that names a group (``IDENTITY``), a
counterfactual twin is made by swapping the terms for other terms of the list,
and the squared change of the logit between the two is added to the loss: neutral
mentions of a group cannot move the score, because the only difference between
the twins is which group is named.

Work: features are counted by class with a Spark aggregate over the training
texts, the ``MAX_FEATURES`` with the strongest class difference become the
vocabulary, and the sparse rows of at most ``MAX_ROWS`` labelled texts per class
(chosen by the hash of their id, weighted back to the class's size) reach the
driver for the fit.  Everything fitted is bounded by these parameters.  Scoring
reads every whole text once, in Arrow batches, without a shuffle; a word's
features are looked up once per task.

Null and empty texts get the score of a text without words.  A null id is held
out.  Rows whose label is null teach nothing.  Repeated rows get equal scores.  Of a
labelled id that repeats, its least label and least text teach.
Without labelled rows of both classes every score is the share of toxic labels
(0 if there are none).  Extra columns of the tables are not used.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import sampled, ship, stored

MAX_ROWS = 20_000
MAX_FEATURES = 4_000
MIN_TEXTS = 5
MIN_Z = 4.0
FOLDS = 5
#: Group names that may be exchanged for one another.
IDENTITY = ("women", "men", "muslims", "christians", "jews", "hindus", "atheists", "gay", "straight", "lesbian",
            "transgender", "black", "white", "asian", "latino", "immigrants", "refugees", "disabled", "blind", "deaf",
            "old", "young")
WORD = re.compile(r"[^\W\d_]+")
CACHE = 200_000


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -30.0


def word_features(w: str) -> set[str]:
    out = {"w:" + w}
    out.update("p:" + w[:n] for n in (3, 4, 5) if len(w) > n)
    out.update("g:" + w[i:i + 4] for i in range(len(w) - 3))
    return out


def words(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def swapped(ws: set[str], identity: Sequence[str]) -> set[str] | None:
    """The text's words with every group name replaced by another one; None if it names none."""
    found = ws & set(identity)
    if not found or len(identity) < 2:
        return None
    step = {t: identity[(i + len(identity) // 2) % len(identity)] for i, t in enumerate(identity)}
    return (ws - found) | {step[t] for t in found}


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_texts(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, text: str = "text",
                   key: str = "doc_id", label: str = "toxic") -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """(text, label) of at most ``max_rows`` training rows per class, and
    ``{label: (rows there are, rows at most taken)}``."""
    known = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")) \
        .where("id IS NOT NULL AND y IN (0, 1)").where(~held_out(F.col("id")))
    sizes = {r["y"]: (r["n"], min(r["n"], max_rows))
             for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}   # two rows
    taken = None
    for y in sizes:
        part = sampled(known.where(F.col("y") == y), max_rows, sizes[y][0], "id")
        taken = part if taken is None else taken.unionByName(part)
    if taken is None:
        taken = known.limit(0)
    # One label and one text (the least) for each id, also where rows share one: the bound holds.
    taken = taken.groupBy("id").agg(F.min("y").alias("y"))
    texts = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    one = texts.join(F.broadcast(taken), "id").groupBy("id").agg(F.min("y").alias("y"), F.min("text").alias("text"))
    return one.select("text", "y"), sizes


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch: how many texts of each class have a feature."""
    for b in batches:
        for y, texts in b.groupby("y")["text"]:
            n: dict[str, int] = {}
            for t in texts:
                seen: set[str] = set()
                for w in words(t):
                    seen |= word_features(w)
                for f in seen:
                    n[f] = n.get(f, 0) + 1
            if n:
                yield pd.DataFrame({"f": list(n), "y": int(y), "n": list(n.values())})


def vocabulary(train: DataFrame, sizes: dict[int, int], identity: Sequence[str], max_features: int) -> list[str]:
    n1, n0 = float(sizes[1]), float(sizes[0])
    n = train.mapInPandas(_counted, "f string, y int, n long").groupBy("f").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b"))
    p = (F.col("a") + F.col("b")) / (n1 + n0)
    z = (F.col("a") / n1 - F.col("b") / n0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / n1 + 1 / n0))
    top = n.where(F.col("a") + F.col("b") >= MIN_TEXTS).withColumn("z", F.abs(z)).where(F.col("z") >= MIN_Z) \
        .orderBy(F.desc("z"), "f").limit(max_features).select("f")
    return sorted({r["f"] for r in top.collect()} | {"w:" + t for t in identity})


def _rows(index: dict[str, int], identity: Sequence[str]):
    """Arrow mapper: the vocabulary indices of each text and of its counterfactual twin."""
    def indices(ws: Iterable[str]) -> list[int]:
        out: set[int] = set()
        for w in ws:
            out.update(index[f] for f in word_features(w) if f in index)
        return sorted(out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ws = [words(t) for t in b["text"]]
            twins = [swapped(w, identity) for w in ws]
            yield pd.DataFrame({"y": b["y"].to_numpy(), "x": [indices(w) for w in ws],
                                "twin": [None if t is None else indices(t) for t in twins]})
    return run


class _Sparse:
    """0/1 rows as index lists, with the two products a gradient needs."""

    def __init__(self, rows: Sequence[Sequence[int]], width: int):
        self.width, self.n = width, len(rows)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.col = np.concatenate([np.asarray(r, dtype=np.int64) for r in rows]) if self.n else np.empty(0, np.int64)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=self.n)

    def transposed(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=v[self.row], minlength=self.width)


def fit_rows(x: Sequence[Sequence[int]], y: np.ndarray, weight: np.ndarray, twins: Sequence[Sequence[int] | None],
             width: int, pairing: float = 10.0, l2: float = 0.2, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weighted logistic loss + l2 |w|^2 / 2 + pairing * squared logit change between twins (Adam)."""
    a = _Sparse(x, width)
    paired = [i for i, t in enumerate(twins) if t is not None]
    one, two = _Sparse([x[i] for i in paired], width), _Sparse([twins[i] for i in paired], width)
    w, b, total = np.zeros(width), float(np.log((weight @ y + 1) / (weight @ (1 - y) + 1))), weight.sum()
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for k in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(a.times(w) + b, -40, 40)))
        r = weight * (p - y)
        g = np.append(a.transposed(r) + l2 * w, r.sum())
        if paired:
            change = 2 * pairing * (one.times(w) - two.times(w))
            g[:-1] += one.transposed(change) - two.transposed(change)
        g /= total
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, identity: Sequence[str] = IDENTITY, max_rows: int = MAX_ROWS,
        max_features: int = MAX_FEATURES, pairing: float = 10.0, text: str = "text", key: str = "doc_id",
        label: str = "toxic") -> Model:
    texts, sizes = training_texts(docs, labels, max_rows, text, key, label)
    if not all(sizes.get(y, (0, 0))[0] for y in (0, 1)):
        return Model(bias=30.0 if sizes.get(1) else -30.0)
    train = stored(texts, "toxicity-training")
    got = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not all(got.get(y) for y in (0, 1)):
        return Model(bias=30.0 if got.get(1) else -30.0)
    names = vocabulary(train, got, identity, max_features)
    index = {f: i for i, f in enumerate(names)}
    rows = train.mapInPandas(_rows(index, identity), "y int, x array<int>, twin array<int>").toPandas()
    y = rows["y"].to_numpy().astype(float)
    scale = {c: sizes[c][0] / got[c] for c in (0, 1)}
    weight = np.where(y == 1, scale[1], scale[0])
    w, b = fit_rows(list(rows["x"]), y, weight, list(rows["twin"]), len(names), pairing)
    return Model({f: float(w[i]) for f, i in index.items()}, b)


def _scorer(model: Model):
    """Series of texts -> series of scores."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, tuple[str, ...]] = {}
        for b in batches:
            out = np.empty(len(b))
            for k, t in enumerate(b):
                seen: set[str] = set()
                for w in words(t):
                    f = known.get(w)
                    if f is None:
                        if len(known) >= CACHE:
                            known.clear()
                        f = known[w] = tuple(x for x in word_features(w) if x in model.weights)
                    if f:
                        seen.update(f)
                logit = model.bias + sum(model.weights[f] for f in sorted(seen))
                out[k] = 1 / (1 + np.exp(-min(max(logit, -40.0), 40.0)))
            yield pd.Series(out)
    return run


def score_of(model: Model, text: Column) -> Column:
    """The score of a text column; only that column goes through Python."""
    return F.pandas_udf(_scorer(model), "double")(text.cast("string"))


def scores(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score (double), predicted (int) for every row."""
    ship(docs.sparkSession)
    d = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), score_of(model, F.col(f"`{text}`")).alias("score"))
    return d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows whose text scores 0.5 or more."""
    ship(docs.sparkSession)
    return docs.where(score_of(model, F.col(f"`{text}`")) < 0.5)
