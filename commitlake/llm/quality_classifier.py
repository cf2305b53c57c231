"""Quality classifier: random-indexing word vectors and a two-layer network.

Every word has a sparse random index vector, made from its hash. A word's
vector is the sum of the index vectors of the words around it (``REACH`` to
either side) over the whole texts of all documents, labelled or not. A word counts twice:
by its letters, and by its shape (the classes of its characters, runs
shortened), so that unknown words still tell what they look like. A document
is the mean of its words' vectors, of either kind, with its length and its share
of distinct words. A two-layer network in numpy maps that to a logit; a
temperature fitted on documents held back from the network's training calibrates
the probability.

The sample is ``PER_CLASS`` documents of each class at most. The words that have
vectors are those of the sample's whole texts, ``MOST_PARTS`` letter and shape forms
at most: those in most of the sample's documents. Their contexts are summed in every
task over its documents, then by blocks of words. The network learns, and scores
are made, from whole texts.

Defined results: a null or empty text is a document without words and has the score
of the zero vector; without labels every score is 0.5; where the labels, or the
documents found for them, are all of one class, that class's smoothed share; rows
that repeat get equal scores. Null labels do not teach.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.llm.common import cut, runs, text_bytes
from commitlake.llm.labelled import class_counts, sample

PER_CLASS = 2500
DIMENSIONS = 48
NONZERO = 6
REACH = 2
HIDDEN = 24
EPOCHS = 40
#: A word is known by its letters from so many occurrences on.
LEAST = 3
#: Letter and shape forms that have vectors at most.
MOST_PARTS = 200_000
#: Distinct words that a task remembers.
_REMEMBERED = 200_000
_BLOCK = 150_000
#: Words whose contexts are summed at once, and parts of a block of sums.
_AT_ONCE, _PARTS = 100_000, 256

_SHAPE = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)
)
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 or b == 10 else 32 for b in range(256))


def parts(word: bytes) -> tuple[bytes, bytes]:
    """The letters and the shape of a word."""
    letters, shapes = all_parts([word])
    return letters[0], shapes[0]


def all_parts(words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """The letters and the shapes of words, made at once: no word has a line end."""
    if not words:
        return [], []
    text = b"\n".join(words)
    letters = [b"l:" + x.strip() for x in text.translate(_LETTERS).split(b"\n")]
    shapes = [b"s:" + x for x in _RUNS.sub(rb"\1", text.translate(_SHAPE)).split(b"\n")]
    return letters, shapes


def index_vectors(names: list[bytes], dimensions: int = DIMENSIONS) -> np.ndarray:
    """Sparse vectors of +1 and -1, from each name's hash."""
    out = np.zeros((len(names), dimensions), np.float32)
    for k in range(NONZERO):
        h = np.array([xxhash.xxh3_64_intdigest(x, seed=k) for x in names], np.uint64)
        at = (h % np.uint64(dimensions)).astype(np.int64)
        out[np.arange(len(names)), at] += np.where(h >> np.uint64(63), 1, -1)
    return out


class _Numbers:
    """Numbers of words, each with its letters' and its shape's part number; parts are
    numbered from 1 on, 0 is the unknown part's. Word 0 is a gap between texts."""

    def __init__(self, names: list[bytes]):
        self.number, self.wide = {p: i + 1 for i, p in enumerate(names)}, len(names) + 1
        self._forget()

    def _forget(self) -> None:
        self.memory: dict[bytes, int] = {}
        self.both = np.zeros((1, 2), np.int64)

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words; ``both`` holds the part numbers of each."""
        if len(self.memory) > _REMEMBERED:
            self._forget()
        new = list(set(words).difference(self.memory))
        if new:
            get, first = self.number.get, len(self.memory) + 1
            self.memory.update(zip(new, range(first, first + len(new)), strict=True))
            own = [np.fromiter([get(p, 0) for p in some], np.int64, len(new)) for some in all_parts(new)]
            self.both = np.concatenate([self.both[:first], np.stack(own, axis=1)])
            self._learned(first)
        return np.fromiter(map(self.memory.__getitem__, words), np.int64, len(words))

    def _learned(self, first: int) -> None:
        """Words from number ``first`` on are new."""


def _batches(texts: list[list[bytes]], most: int) -> Iterator[list[list[bytes]]]:
    """Texts of about ``most`` words together, one text at least."""
    at = 0
    while at < len(texts):
        end, n = at, 0
        while end < len(texts) and n < most:
            n += len(texts[end])
            end += 1
        yield texts[at:end]
        at = end


class Contexts(_Numbers):
    """Occurrences of parts, and sums of the index vectors around them."""

    def __init__(self, names: list[bytes]):
        super().__init__(names)
        self.index = np.vstack([np.zeros((1, DIMENSIONS)), index_vectors(names)]).astype(np.int8)
        self.own = np.zeros((1, DIMENSIONS), np.int8)
        self.counts, self.sums = np.zeros(self.wide, np.int64), np.zeros((self.wide, DIMENSIONS), np.int64)

    def _learned(self, first: int) -> None:
        # an entry is NONZERO at most for each part: 2 REACH neighbours' fit into a byte
        new = self.both[first:]
        self.own = np.concatenate([self.own[:first], self.index[new[:, 0]] + self.index[new[:, 1]]])

    def add_all(self, texts: list[list[bytes]]) -> None:
        for some in _batches(texts, _AT_ONCE):
            self._add(some)

    def _add(self, texts: list[list[bytes]]) -> None:
        sizes = np.array([len(t) for t in texts])
        n = int(sizes.sum())
        if not n:
            return
        # texts stand REACH gaps apart, so that no context reaches into the next
        at = np.arange(n) + REACH * (np.repeat(np.arange(len(texts)), sizes) + 1)
        word = np.zeros(n + REACH * (len(texts) + 1), np.int64)
        word[at] = self.ids([w for t in texts for w in t])
        around = self.own[word]
        near = np.zeros_like(around)
        for k in range(1, REACH + 1):
            near[k:] += around[:-k]
            near[:-k] += around[k:]
        # by word first, then by the words' parts
        word, near = word[at], near[at]
        order = np.argsort(word, kind="stable")
        distinct, first, count = np.unique(word[order], return_index=True, return_counts=True)
        total = _sums(near[order], first)
        for part in self.both[distinct].T:
            known = np.flatnonzero(part)  # nothing is asked of the unknown part
            order = known[np.argsort(part[known], kind="stable")]
            each, first = np.unique(part[order], return_index=True)
            if not len(each):
                continue
            self.counts[each] += np.add.reduceat(count[order], first)
            self.sums[each] += np.add.reduceat(total[order], first, axis=0)


def _sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows (bytes between -64 and 63) from each position of ``first`` to the
    next: four columns at once, as 16-bit lanes of one number, 512 rows at most."""
    cuts = np.union1d(first, np.arange(0, len(rows), 512))
    sizes = np.diff(np.append(cuts, len(rows)))
    lanes = (rows.astype(np.int16) + 64).astype(np.uint16).view(np.uint64)
    sums = np.add.reduceat(lanes, cuts, axis=0).view(np.uint16).astype(np.int32) - 64 * sizes[:, None].astype(np.int32)
    whole = np.searchsorted(cuts, first)
    out, more = sums[whole], np.setdiff1d(np.arange(len(cuts)), whole, assume_unique=True)
    np.add.at(out, np.searchsorted(whole, more) - 1, sums[more])
    return out


def corpus_contexts(texts: DataFrame, names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts and sums of ``Contexts`` over all rows of ``texts`` (one column)."""
    shared = texts.sparkSession.sparkContext.broadcast(names)
    kind = "block int, counts binary, sums binary"

    def rows(found: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for block, (counts, sums) in found.items():
            packed = [zlib.compress(x.astype(np.int64).tobytes(), 1) for x in (counts, sums)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)], ["block", "counts", "sums"]
            )

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            own = own or Contexts(shared.value)
            for part in runs(batch.column(0)):
                own.add_all([(t or b"").split() for t in text_bytes(part)])
        if own is not None:
            for at in range(0, own.wide, _PARTS):
                counts = own.counts[at : at + _PARTS]
                if counts.any():
                    yield from rows({at // _PARTS: (counts, own.sums[at : at + _PARTS])})

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for block, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                new = [np.frombuffer(zlib.decompress(x), np.int64) for x in packed]
                old = found.get(block, (0, 0))
                found[block] = (old[0] + new[0], old[1] + new[1])
        yield from rows(found)

    out = texts.mapInArrow(local, kind).repartition("block").mapInArrow(total, kind).collect()
    shared.unpersist()
    counts, sums = np.zeros(len(names) + 1, np.int64), np.zeros((len(names) + 1, DIMENSIONS), np.float32)
    for r in out:
        own = np.frombuffer(zlib.decompress(r.counts), np.int64)
        at = slice(r.block * _PARTS, r.block * _PARTS + len(own))
        counts[at] = own
        sums[at] = np.frombuffer(zlib.decompress(r.sums), np.int64).reshape(-1, DIMENSIONS)
    return counts, sums


class WordVectors(_Numbers):
    """A vector for each known part; row 0 is the unknown part's, zero. ``names``,
    ``sums``: parts and what is around them; by default of ``texts``."""

    def __init__(self, texts: list[list[bytes]], names: list[bytes] | None = None, sums: np.ndarray | None = None):
        if names is None:
            counts: dict[bytes, int] = {}
            for t in texts:
                for w in t:
                    for p in parts(w):
                        counts[p] = counts.get(p, 0) + 1
            names = sorted(p for p, n in counts.items() if n >= LEAST)
            around = Contexts(names)
            around.add_all(texts)
            sums = around.sums.astype(np.float32)
        super().__init__(names)
        table = sums.copy()
        table[0] = 0
        size = np.linalg.norm(table, axis=1, keepdims=True)
        self.table = table / np.where(size > 0, size, 1)

    def pool(self, texts: list[list[bytes]]) -> np.ndarray:
        """Document vectors: means by letters and by shape, length, distinct share."""
        return np.concatenate([self._pool(some) for some in _batches(texts, _BLOCK)] or [np.zeros((0, 2 * DIMENSIONS + 2), np.float32)])

    def _pool(self, texts: list[list[bytes]]) -> np.ndarray:
        out = np.zeros((len(texts), 2 * DIMENSIONS + 2), np.float32)
        word, share, sizes = self._words(texts)
        filled = np.flatnonzero(sizes)
        if len(filled):
            first = (np.cumsum(sizes) - sizes)[filled]
            for k in (0, 1):
                sums = np.add.reduceat(self.table[self.both[word, k]], first, axis=0)
                out[filled, k * DIMENSIONS : (k + 1) * DIMENSIONS] = sums / sizes[filled, None]
        out[:, -2:] = share
        return out

    def _words(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers of all texts, the two last features, and the texts' sizes."""
        sizes = np.array([len(t) for t in texts])
        word = self.ids([w for t in texts for w in t])
        distinct = [len(set(t)) / len(t) if t else 0 for t in texts]
        return word, np.stack([np.log1p(sizes) / 10, distinct], axis=1).astype(np.float32), sizes


class Pooled(WordVectors):
    """Word vectors after a linear map of the pooled features: a short row for each
    word, summed over a document, gives what ``pool`` and the map give."""

    def __init__(self, vectors: WordVectors, weights: np.ndarray):
        _Numbers.__init__(self, [])
        self.number, self.wide = vectors.number, vectors.wide
        self.maps = [(vectors.table @ weights[k * DIMENSIONS : (k + 1) * DIMENSIONS]).astype(np.float32) for k in (0, 1)]
        self.rest = weights[-2:]
        self.rows = np.zeros((1, weights.shape[1]), np.float32)

    def _learned(self, first: int) -> None:
        new = self.both[first:]
        self.rows = np.concatenate([self.rows[:first], self.maps[0][new[:, 0]] + self.maps[1][new[:, 1]]])

    def mapped(self, texts: list[list[bytes]]) -> np.ndarray:
        return np.concatenate([self._mapped(some) for some in _batches(texts, _BLOCK)] or [np.zeros((0, self.rest.shape[1]))])

    def _mapped(self, texts: list[list[bytes]]) -> np.ndarray:
        word, share, sizes = self._words(texts)
        out = share @ self.rest
        filled = np.flatnonzero(sizes)
        if len(filled):
            sums = np.add.reduceat(self.rows[word], (np.cumsum(sizes) - sizes)[filled], axis=0)
            out[filled] += sums / sizes[filled, None]
        return out


class QualityModel:
    """Word vectors, the network and its temperature."""

    def __init__(self, vectors: WordVectors | None, constant: float = 0.5):
        self.vectors, self.constant, self.pooled = vectors, constant, None

    def fit(self, x: np.ndarray, y: np.ndarray, prior: tuple[int, int], seed: int = 9) -> QualityModel:
        r = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = (x - self.mean) / self.scale
        held = r.random(len(x)) < 0.2
        if held.all() or not held.any() or len(set(y[held])) < 2:
            held[:] = False
        self.w1 = r.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN))
        self.b1, self.w2, self.b2 = np.zeros(HIDDEN), r.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)
        names, step = ("w1", "b1", "w2", "b2"), 0
        moments = {k: (np.zeros_like(getattr(self, k)), np.zeros_like(getattr(self, k))) for k in names}
        xs, ys = x[~held], y[~held]
        for epoch in range(EPOCHS):
            order = r.permutation(len(xs))
            for at in range(0, len(xs), 64):
                p = order[at : at + 64]
                hidden = np.maximum(xs[p] @ self.w1 + self.b1, 0)
                error = (_logistic(hidden @ self.w2 + self.b2) - ys[p]) / len(p)
                back = np.outer(error, self.w2) * (hidden > 0)
                step += 1
                grads = {"w1": xs[p].T @ back + 1e-4 * self.w1, "b1": back.sum(axis=0), "w2": hidden.T @ error, "b2": error.sum(keepdims=True)}
                for k, g in grads.items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    rate = 0.005 * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                    getattr(self, k)[...] -= rate * m / (np.sqrt(v) + 1e-8)
        # the sample has the classes evenly: back to their true odds, then calibrate
        odds = y.sum() / max(len(y) - y.sum(), 1)
        self.shift = float(np.log(prior[1] / prior[0]) - np.log(odds))
        self.temperature = self._calibrate(x[held], y[held], odds, prior)
        return self

    def _calibrate(self, x: np.ndarray, y: np.ndarray, odds: float, prior: tuple[int, int]) -> float:
        """The temperature with the least log loss, classes weighted as they occur."""
        if not len(x):
            return 1.0
        weight = np.where(y == 1, prior[1] / prior[0] / odds, 1.0)
        logits = self._logits(x)

        def loss(t: float) -> float:
            p = np.clip(_logistic(logits / t + self.shift), 1e-9, 1 - 1e-9)
            return float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())

        return min((float(t) for t in np.exp(np.linspace(-1.5, 2.5, 81))), key=loss)

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if self.vectors is None:
            return np.full(len(texts), self.constant)
        if self.pooled is None:  # the network's first layer, word by word
            self.pooled = Pooled(self.vectors, self.w1 / self.scale[:, None])
        first = self.pooled.mapped([(t or b"").split() for t in texts]) + (self.b1 - self.mean / self.scale @ self.w1)
        logits = np.maximum(first, 0) @ self.w2 + self.b2
        return _logistic(logits / self.temperature + self.shift)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS, most_parts: int = MOST_PARTS) -> QualityModel:
    """Learns from the texts of ``docs`` and ``labels`` (doc_id and ``label``, 0 or 1)."""
    n0, n1 = class_counts(labels, label)
    if not n0 or not n1:
        return QualityModel(None, (n1 + 1) / (n0 + n1 + 2))
    sampled = cut(sample(docs, labels, label, per_class))
    found = {r.y: r["count"] for r in sampled.groupBy("y").count().collect()}
    if len(found) < 2:
        m1 = found.get(1, 0)
        return QualityModel(None, (m1 + 1) / (sum(found.values()) + 2))

    def distinct(texts: pa.Array) -> pa.Array:
        out = [sorted({p for some in all_parts(list(set((t or b"").split()))) for p in some}) for t in text_bytes(texts)]
        return pa.array(out, pa.list_(pa.binary()))

    def pooled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [shared.value.pool([(t or b"").split() for t in text_bytes(part)]) for part in runs(texts)]
            flat = np.concatenate(found) if found else np.empty((0, 2 * DIMENSIONS + 2), np.float32)
            yield pa.array(list(flat), pa.list_(pa.float32()))

    names = sampled.select(F.explode(F.arrow_udf(distinct, "array<binary>")("text")).alias("p")).groupBy("p").count()
    names = names.orderBy(F.desc("count"), "p").limit(most_parts).select("p")
    names = sorted(names.toArrow().column(0).to_pylist())
    counts, sums = corpus_contexts(docs.select(F.col("text").cast("string")), names)
    known = np.flatnonzero(counts[1:] >= LEAST) + 1
    vectors = WordVectors([], [names[i - 1] for i in known], sums[np.concatenate([[0], known])])
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    pool = F.arrow_udf(pooled, "array<float>").asNondeterministic()
    rows = sampled.select("doc_id", "y", pool("text").alias("x")).collect()
    shared.unpersist()
    rows.sort(key=lambda r: str(r.doc_id))
    x = np.array([r.x for r in rows], np.float32)
    return QualityModel(vectors).fit(x, np.array([r.y for r in rows], float), (n0, n1))


def quality(text: Column, broadcast) -> Column:
    """Score between 0 and 1 of each whole text; ``broadcast`` holds a model."""

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [broadcast.value.scores(text_bytes(part)) for part in runs(texts)]
            yield pa.array(np.concatenate(found) if found else [], pa.float64())

    return F.arrow_udf(scores, "double").asNondeterministic()(text.cast("string"))
