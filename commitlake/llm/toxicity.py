"""Toxicity by a counterfactual-regularised classifier.

A sparse logistic model over the words of a text, trained in numpy on the driver
on a bounded sample of labelled documents (``PER_CLASS`` of each class). Besides
the log loss and an L1 penalty it pays for counterfactuals: in labelled sentences
identity terms are swapped for other identity terms, and every change of the
score costs. Where the sample has few such sentences, neutral mentions are made
from clean ones: a sentence with an identity term added against the
same sentence with another, or with none. So a mention of a group does not
move the score by itself. The sentences are those of the sample's whole texts:
``MENTIONS`` at most, those that name a group first, then by a hash.

The classes are sampled evenly, and the penalty shrinks the weights. So the sums
are set back by a scale and a bias that fit the labels of documents left out of a
model's training (``FOLDS`` models, each without its part), classes weighted as
they occur.

Defined results: a null or empty text, or one without known words, gets the score of
the bias; without labels every score is 0.5; where the labels, or the documents
found for them, are all of one class, that class's smoothed share; rows that repeat
get equal scores. Null labels do not teach.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.llm.common import cut, runs
from commitlake.llm.labelled import class_counts, sample

PER_CLASS = 6000
#: Words that the model may know.
VOCABULARY = 20_000
#: Sentences that are made into counterfactual pairs, at most.
MENTIONS = 10_000
#: Models that each leave a part of the sample out, to calibrate on it.
FOLDS = 4
#: Divided by the number of sampled documents.
L1 = 0.6
FAIR = 1.0
STEPS = 300

#: Identity terms that may stand in for one another (fixed values).
IDENTITY = tuple(
    """
    women men woman man girls boys female male gay lesbian straight transgender
    muslim muslims christian christians jewish jews hindu buddhist atheist
    black white asian latino african european american immigrant immigrants refugee
    disabled blind deaf old young
    femmes hommes musulmans chrétiens juifs noirs blancs immigrés
    frauen männer muslime christen juden schwarze weiße ausländer
    mujeres hombres musulmanes cristianos judíos negros blancos inmigrantes
    """.split()
)

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_FOLD).split() if text else []


class WordModel:
    """``weights`` of words and ``bias``; a score is the logistic of their sum
    over a text's distinct words."""

    def __init__(self, weights: dict[bytes, float], bias: float):
        self.weights, self.bias, self.known = weights, bias, frozenset(weights)

    def score(self, text: str | None) -> float:
        total = self.bias + sum(self.weights[w] for w in self.known.intersection(words(text)))
        return float(1 / (1 + np.exp(-np.clip(total, -50, 50))))


def vocabulary(sampled: DataFrame, share: float, size: int = VOCABULARY) -> list[bytes]:
    """The words of the sample that tell the classes apart best (chi-squared over
    document counts), of those in two documents at least. ``share``: of class 1."""
    split = F.arrow_udf(_distinct, "array<binary>")
    counts = sampled.select("y", F.explode(split("text")).alias("w")).groupBy("w")
    counts = counts.agg(F.count("*").alias("n"), F.sum("y").alias("n1")).where("n >= 2")
    gain = F.pow(F.col("n1") - F.col("n") * share, 2) / F.col("n")
    return sorted(bytes(r.w) for r in counts.orderBy(gain.desc(), "w").limit(size).select("w").collect())


def _distinct(texts: pa.Array) -> pa.Array:
    return pa.array([sorted(set(words(t))) for t in texts.to_pylist()], pa.list_(pa.binary()))


def _numbers(known: dict[bytes, int]):
    def numbers(texts: pa.Array) -> pa.Array:
        out = [sorted(known[w] for w in set(words(t)) if w in known) for t in texts.to_pylist()]
        return pa.array(out, pa.list_(pa.int32()))

    return F.arrow_udf(numbers, "array<int>")


def mentions(sampled: DataFrame, known: dict[bytes, int], limit: int = MENTIONS) -> list[list[int]]:
    """Sentences (as word numbers) of the sample's whole texts: those that name an
    identity term first, then those of more than three words, by a hash."""
    terms = {t.encode() for t in IDENTITY}

    def split(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            found = []
            for s in re.split(r"[.!?\n]+", t or ""):
                w = set(words(s))
                named = bool(w & terms)
                if named or len(w) > 3:
                    found.append({"plain": not named, "x": sorted(known[x] for x in w if x in known)})
            out.append(found)
        return pa.array(out, pa.list_(pa.struct([("plain", pa.bool_()), ("x", pa.list_(pa.int32()))])))

    sentences = F.arrow_udf(split, "array<struct<plain:boolean,x:array<int>>>")
    rows = sampled.select("doc_id", F.posexplode(sentences("text")).alias("at", "s"))
    rows = rows.orderBy("s.plain", F.xxhash64(F.col("doc_id").cast("string"), "at"), "doc_id", "at").limit(limit)
    return [list(r.x) for r in rows.select("s.x").collect()]


class _Rows:
    """Binary rows of word numbers, multiplied without a dense matrix."""

    def __init__(self, rows: list[list[int]], width: int):
        self.width, self.n = width, len(rows)
        self.col = np.array([c for r in rows for c in r], np.int64)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], minlength=self.n)

    def back(self, error: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, error[self.row], minlength=self.width)


def counterfactuals(sentences: list[list[int]], terms: list[int], seed: int = 3):
    """Pairs of rows: a sentence with an identity term, and with another or none."""
    r, known = np.random.default_rng(seed), set(terms)
    left, right = [], []
    for s in sentences:
        rest = [c for c in s if c not in known]
        own = [c for c in s if c in known] or [int(r.choice(terms))]
        swapped = [int(r.choice(terms)) for _ in own]
        left += [rest + own, rest + own]
        right += [rest + sorted(set(swapped)), rest]
    return left, right


def fit(
    rows: list[list[int]], y: np.ndarray, pairs: tuple[list, list], width: int, l1: float = L1, fair: float = FAIR, steps: int = STEPS
) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated proximal gradient steps."""
    x, (a, b) = _Rows(rows, width), (_Rows(p, width) for p in pairs)
    w, bias, at, at_bias, t = np.zeros(width), 0.0, np.zeros(width), 0.0, 1.0
    # the loss's curvature, by power iteration, gives the step; the bias adds 1/4
    v, top = np.ones(width) / np.sqrt(max(width, 1)), 0.0
    for _ in range(30):
        u = 0.25 * x.back(x.times(v)) / x.n
        if a.n:
            gap = (a.times(v) - b.times(v)) * 2 * fair / a.n
            u = u + a.back(gap) - b.back(gap)
        top = float(np.linalg.norm(u))
        v = u / (top + 1e-12)
    curve = 1.2 * top + 0.5
    for _ in range(steps):
        error = 1 / (1 + np.exp(-np.clip(x.times(at) + at_bias, -50, 50))) - y
        grad = x.back(error) / x.n
        if a.n:
            gap = a.times(at) - b.times(at)
            change = 2 * fair * gap / a.n
            grad = grad + a.back(change) - b.back(change)
        new = at - grad / curve
        new = np.sign(new) * np.maximum(np.abs(new) - l1 / x.n / curve, 0)
        new_bias = at_bias - error.mean() / curve
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        at, at_bias = new + (t - 1) / t_new * (new - w), new_bias + (t - 1) / t_new * (new_bias - bias)
        w, bias, t = new, new_bias, t_new
    return w, bias


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, size: int = VOCABULARY, fair: float = FAIR
) -> WordModel:
    """Learns from the texts of ``docs`` and ``labels`` (doc_id and ``label``, 0 or 1)."""
    n0, n1 = class_counts(labels, label)
    if not n0 or not n1:
        share = (n1 + 1) / (n0 + n1 + 2)
        return WordModel({}, float(np.log(share / (1 - share))))
    sampled = cut(sample(docs, labels, label, per_class))
    found = {r.y: r["count"] for r in sampled.groupBy("y").count().collect()}
    if len(found) < 2:
        share = (found.get(1, 0) + 1) / (sum(found.values()) + 2)
        return WordModel({}, float(np.log(share / (1 - share))))
    terms = [t.encode() for t in IDENTITY]
    names = sorted({*vocabulary(sampled, found[1] / (found[0] + found[1]), size), *terms})
    known = {w: i for i, w in enumerate(names)}
    rows = sampled.select("doc_id", "y", _numbers(known)("text").alias("x")).collect()
    rows.sort(key=lambda r: str(r.doc_id))
    x, y = [list(r.x) for r in rows], np.array([r.y for r in rows], float)
    pairs = counterfactuals(mentions(sampled, known), sorted({known[t] for t in terms}))
    w, bias = fit(x, y, pairs, len(names), fair=fair)
    scale, shift = calibration(x, y, pairs, len(names), fair, n1 / n0)
    w, bias = w * scale, bias * scale + shift
    return WordModel({names[i]: float(w[i]) for i in np.flatnonzero(np.abs(w) > 1e-6)}, float(bias))


def calibration(
    x: list[list[int]], y: np.ndarray, pairs: tuple[list, list], width: int, fair: float, odds: float, seed: int = 13
) -> tuple[float, float]:
    """Scale and shift of the sums: the ones of least log loss over documents that the
    model did not learn from, where class 1 is ``odds`` times as frequent as class 0."""
    fold, sums = np.random.default_rng(seed).integers(0, FOLDS, len(y)), np.zeros(len(y))
    weight = np.where(y == 1, odds * max((y == 0).sum(), 1) / max((y == 1).sum(), 1), 1.0)
    for k in range(FOLDS):
        own, left = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if not len(left) or len(set(y[own])) < 2:
            return 1.0, float(np.log(odds) - np.log(y.sum() / (len(y) - y.sum())))
        w, bias = fit([x[i] for i in own], y[own], pairs, width, fair=fair, steps=STEPS // 2)
        sums[left] = _Rows([x[i] for i in left], width).times(w) + bias
    scale, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps, slightly held to a scale of 1
        p = 1 / (1 + np.exp(-np.clip(scale * sums + shift, -50, 50)))
        a, h = weight * (p - y), weight * p * (1 - p)
        grad = np.array([a @ sums + scale - 1, a.sum()])
        step = np.linalg.solve([[h @ (sums * sums) + 1, h @ sums], [h @ sums, h.sum() + 1e-6]], grad)
        step *= min(1.0, 2 / (np.abs(step).max() + 1e-9))
        scale, shift = scale - step[0], shift - step[1]
    return float(max(scale, 0.1)), float(shift)


def toxicity(text: Column, model: WordModel) -> Column:
    """Score between 0 and 1 of each whole text."""

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([model.score(t) for part in runs(texts) for t in part.to_pylist()], pa.float64())

    return F.arrow_udf(scores, "double").asNondeterministic()(text.cast("string"))
