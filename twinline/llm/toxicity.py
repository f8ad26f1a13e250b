"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other; each later model sees the
earlier categories' probabilities as features. In training those come from
out-of-fold predictions, so a later model learns from probabilities as honest
as the ones it meets when scoring: in each fold words are chosen, ratios scaled and the
model fitted without the held-out labels.

Features: the words most associated with each category (present or not) and a
few surface ratios of the text. The models are fitted on a bounded sample of
labelled rows (``max_rows`` of each value of the last category, in order of a
hash of the id), weighted by the share of the value among all labels, so that a
probability means the same whatever the bound leaves out; scoring runs over every row. What is broadcast is the model,
a few hundred words and weights.

Defined results: null is the empty text; labels that are null count as 0, a
repeated doc_id takes its largest label; without labelled rows, or without two
values in a category, that category's probability is its share (0 without any);
repeated rows score alike; an empty table gives an empty result; extra columns
pass through ``score``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Bound on labelled rows used in training, for each value of the last category.
MAX_ROWS = 4_000
#: Words kept for each category.
TOP_WORDS = 128
#: Least chi-square of a kept word, far above chance for a whole vocabulary.
LEAST_CHI = 30.0
FOLDS = 5
#: Lengths of stems, and the counts and shares of words (in thousandths) from which a recurring stem is a feature.
STEMS = (5, 6, 7)
TIMES = (2, 3, 4, 6, 9)
PER_MILLE = (2, 4, 8, 16)
THRESHOLD = 0.5
WORD = re.compile(r"[^\W\d_]+")
#: Name, and the SQL that makes it from the labels table; in chain order.
CATEGORIES = (("low_quality", "1 - quality"), ("toxic", "toxic"))
SURFACE = 7


def surface(text: str, words: list[str]) -> list[float]:
    n = max(1, len(text))
    letters = sum(map(len, words))
    lines = text.split("\n")
    return [
        np.log1p(len(text)), letters / n, sum(map(text.count, "|*%#&$")) / n, sum(map(text.count, "0123456789")) / n,
        letters / max(1, len(words)), 1 - len(set(words)) / max(1, len(words)), 1 - len(set(lines)) / len(lines),
    ]


def word_ids(words: list[str]) -> np.ndarray:
    """Hashes of the words present, and of the stems that recur: how often, and at what share of the words."""
    counts = Counter(words)
    found = set(counts)
    stems: Counter = Counter()
    for w, n in counts.items():
        for k in STEMS:
            if len(w) > k:
                stems[w[:k]] += n
    for stem, n in stems.items():
        if n > 1:
            found.update(f"{stem}*{t}" for t in TIMES if n >= t)
            found.update(f"{stem}%{t}" for t in PER_MILLE if 1000 * n >= t * len(words))
    return np.unique(np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in found), np.uint32, len(found)).view(np.int32))


def features_of(text: str) -> tuple[np.ndarray, list[float]]:
    words = WORD.findall(text.lower())
    return word_ids(words), [float(x) for x in surface(text, words)]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1, steps: int = 25) -> np.ndarray:
    """Weights (the last is the intercept) of a ridge logistic regression of weighted rows, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    if y.min() == y.max():
        w[-1] = 30.0 if y[0] else -30.0
        return w
    for _ in range(steps):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (weight * (p - y)) + penalty * w)
        w -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-4:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def linear(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


@dataclass
class Chain:
    names: tuple[str, ...]
    vocab: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))  # in order
    mean: np.ndarray = field(default_factory=lambda: np.zeros(SURFACE))
    scale: np.ndarray = field(default_factory=lambda: np.ones(SURFACE))
    weights: list[np.ndarray] = field(default_factory=list)

    def matrix(self, ids: list, surfaces: np.ndarray) -> np.ndarray:
        x = np.zeros((len(ids), len(self.vocab) + SURFACE))
        if len(self.vocab) and len(ids):
            flat, owner = np.concatenate(ids), np.repeat(np.arange(len(ids)), [len(i) for i in ids])
            at = np.minimum(np.searchsorted(self.vocab, flat), len(self.vocab) - 1)
            hit = self.vocab[at] == flat
            x[owner[hit], at[hit]] = 1
        x[:, len(self.vocab) :] = (surfaces - self.mean) / self.scale
        return x

    def predict(self, ids: list, surfaces: np.ndarray) -> np.ndarray:
        x = self.matrix(ids, surfaces)
        for w in self.weights:
            x = np.hstack([x, linear(w, x)[:, None]])
        return x[:, x.shape[1] - len(self.weights) :] if self.weights else np.zeros((len(ids), len(self.names)))


def associated(ids: list, y: np.ndarray, top: int) -> np.ndarray:
    """Features with the largest chi-square for y = 1, among those in five texts or more."""
    flat = np.concatenate(ids)
    kinds, at = np.unique(flat, return_inverse=True)
    label = np.repeat(y.astype(float), [len(x) for x in ids])
    c1 = np.bincount(at, label, len(kinds))
    c0 = np.bincount(at, 1 - label, len(kinds))
    n1, n = float(y.sum()), float(len(y))
    d = c1 * (n - n1) - c0 * n1
    chi = n * d * d / np.maximum(1, (c0 + c1) * (n - c0 - c1) * n1 * (n - n1))
    kept = np.flatnonzero((c0 + c1 >= 5) & (chi >= LEAST_CHI) & (d > 0))
    order = np.lexsort((kinds[kept], -chi[kept]))[:top]
    return kinds[kept[order]]


def design(names: tuple[str, ...], ids: list, surfaces: np.ndarray, labels: np.ndarray, top: int) -> Chain:
    """A chain without models yet: words chosen and ratios scaled by these rows."""
    vocab = np.unique(np.concatenate([associated(ids, labels[:, k], top) for k in range(len(names))]))
    return Chain(names, vocab, surfaces.mean(0), np.maximum(surfaces.std(0), 1e-6))


def fit(
    ids: list, surfaces: np.ndarray, labels: np.ndarray, folds: np.ndarray, names: tuple[str, ...], top: int = TOP_WORDS, weight: np.ndarray | None = None
) -> Chain:
    if not len(ids):
        return Chain(names)  # scores 0
    weight = np.ones(len(ids)) if weight is None else weight
    chain = design(names, ids, surfaces, labels, top)
    earlier = np.zeros((len(ids), 0))  # out-of-fold probabilities of the categories so far
    inner = []  # (held out, its rows, the others, features of both) of each fold
    for f in np.unique(folds):
        out = np.flatnonzero(folds == f)
        rest = np.flatnonzero(folds != f)
        if len(rest):
            own = design(names, [ids[i] for i in rest], surfaces[rest], labels[rest], top)
            inner.append((out, rest, own.matrix([ids[i] for i in out], surfaces[out]), own.matrix([ids[i] for i in rest], surfaces[rest])))
    x = chain.matrix(ids, surfaces)
    for k in range(len(names)):
        y = labels[:, k].astype(float)
        chain.weights.append(logistic(np.hstack([x, earlier]), y, weight))
        held = np.full(len(y), np.average(y, weights=weight))
        for out, rest, x_out, x_rest in inner:
            w = logistic(np.hstack([x_rest, earlier[rest]]), y[rest], weight[rest])
            held[out] = linear(w, np.hstack([x_out, earlier[out]]))
        earlier = np.hstack([earlier, held[:, None]])
    return chain


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, categories=CATEGORIES) -> Chain:
    """Fits the chain on a bounded sample of ``docs`` joined with ``labels``."""
    names = tuple(n for n, _ in categories)
    marks = labels.where("doc_id is not null").select("doc_id", *[F.expr(f"coalesce(cast({sql} as int), 0)").alias(n) for n, sql in categories])
    marks = marks.groupBy("doc_id").agg(*[F.max(n).alias(n) for n in names])
    order = F.xxhash64(F.lit("toxicity"), "doc_id")
    many = {r[0]: r[1] for r in marks.groupBy(names[-1]).agg(F.count("*")).collect()}  # two values
    some = [marks.where(F.col(names[-1]) == v).orderBy(order, "doc_id").limit(max_rows) for v in (0, 1)]
    sample = some[0].unionByName(some[1])  # at most 2 * max_rows small rows
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(sample), "doc_id")

    def run(batches):
        for b in batches:
            made = [features_of(t) for t in b["text"]]
            yield b.drop(columns="text").assign(ids=[m[0] for m in made], surface=[m[1] for m in made])

    kinds = ", ".join(f"{n} int" for n in names)
    got = rows.select("doc_id", *names, "text").mapInPandas(run, f"doc_id long, {kinds}, ids array<int>, surface array<double>").toPandas()
    got = got.sort_values("doc_id", kind="stable").drop_duplicates("doc_id")
    folds = np.array([zlib.crc32(str(d).encode()) % FOLDS for d in got["doc_id"]])
    surfaces = np.array(got["surface"].tolist()).reshape(len(got), SURFACE)
    marked = got[list(names)].to_numpy().reshape(len(got), len(names))
    taken = {v: min(n, max_rows) for v, n in many.items()}
    rate = sum(many.values()) / max(1, sum(taken.values()))  # so the weights are 1 on the whole
    weight = np.array([many[v] / taken[v] / rate for v in marked[:, -1]])
    return fit([np.asarray(x, np.int32) for x in got["ids"]], surfaces, marked, folds, names, weight=weight)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` plus struct __tox(p_<category>, ...)."""
    model = docs.sparkSession.sparkContext.broadcast(chain)
    schema = ", ".join(f"p_{n} double" for n in chain.names)

    @F.pandas_udf(schema)
    def probabilities(texts: pd.Series) -> pd.DataFrame:
        made = [features_of(t) for t in texts]
        surfaces = np.array([m[1] for m in made]).reshape(len(made), SURFACE)
        p = np.empty((len(made), len(model.value.names)))
        for i in range(0, len(made), 1000):
            p[i : i + 1000] = model.value.predict([m[0] for m in made[i : i + 1000]], surfaces[i : i + 1000])
        return pd.DataFrame(p, columns=[f"p_{n}" for n in model.value.names])

    return docs.withColumn("__tox", probabilities(text_of()))


def remove_toxic(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose probability in the last category is below ``threshold``."""
    return score(docs, chain).where(F.col(f"__tox.p_{chain.names[-1]}") < threshold).drop("__tox")


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    chain = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    p = F.col("__tox")
    return score(docs, chain).select(
        "doc_id", *[p[f"p_{n}"].alias(f"p_{n}") for n in chain.names], (p[f"p_{chain.names[-1]}"] >= THRESHOLD).alias("toxic")
    )
