"""Language ID by a byte convolutional network.

Texts are cut into windows of ``WINDOW`` bytes (the last is padded with zero
bytes). Each byte is embedded; filters of several widths slide over the window,
each filter keeps its maximum over all positions (max pooling), and a softmax
layer maps the maxima to languages. Everything is trained in numpy on the
driver, on a bounded sample of labelled texts; tasks apply the network to all
windows of their whole texts in blocks. A document's distribution is the mean
of its windows', weighted by their letters.

The sample: of the ``MOST_LANGUAGES`` values of lang that most documents have
(ties: smallest first), ``PER_LANGUAGE`` documents of each at most, chosen by a hash
of id and text; rows that repeat are one. All windows of the sample's whole texts
teach, as far as a language has ``TAUGHT`` of them; of more, each document's share is
drawn by a hash, so that long texts do not make the driver's work unbounded.

Defined results: a null text, or one without letters, is ``und`` with score 0, as
is every text when nothing is labelled; with one language all texts are it;
repeated rows get equal answers; rows with a null label, or with one that is not
among the learned languages, do not teach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commitlake.llm.common import cut, free_name, release, runs, struct_array, text_bytes

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 8
#: The sample's bounds: languages, documents of each, and windows of each.
MOST_LANGUAGES, PER_LANGUAGE, TAUGHT = 200, 600, 10_000
#: Rounds over the sample's windows; of a small sample as many as make ``_STEPS`` steps,
#: up to ``_ROUNDS``.
EPOCHS, _STEPS, _ROUNDS = 2, 600, 15
#: Windows that a task holds at once.
_BLOCK = 64
UNKNOWN = "und"
#: Scores below this are uncertain: hardly better than a guess among three.
MIN_SCORE = 0.35

_IS_LETTER = np.zeros(256, np.float32)
_IS_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def fold(text: bytes) -> np.ndarray:
    """Bytes with A-Z and the two-byte Latin capitals in lower case."""
    x = np.frombuffer(text.lower(), np.uint8)
    capital = (x[1:] >= 0x80) & (x[1:] <= 0x9E) & (x[:-1] == 0xC3)
    if capital.any():
        x = x.copy()
        x[1:][capital] += 0x20
    return x


def windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts, and the number of windows of each text."""
    n = np.array([-(-len(t) // WINDOW) for t in texts], np.int64)
    out = np.zeros(int(n.sum()) * WINDOW, np.uint8)
    at = 0
    for t, k in zip(texts, n, strict=True):
        out[at : at + len(t)] = t
        at += int(k) * WINDOW
    return out.reshape(-1, WINDOW), n


def has_letters(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


class ByteNet:
    """Embedding, filters of all widths side by side (narrow ones padded with
    zero weights that stay zero), max pooling, softmax."""

    def __init__(self, classes: list[str], seed: int = 11):
        r, wide = np.random.default_rng(seed), max(WIDTHS)
        self.classes = classes
        self.embed = r.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.mask = np.zeros((wide, EMBED, len(WIDTHS) * FILTERS), np.float32)
        for i, width in enumerate(WIDTHS):
            self.mask[:width, :, i * FILTERS : (i + 1) * FILTERS] = 1
        self.mask = self.mask.reshape(wide * EMBED, -1)
        self.filters = (r.normal(0, 0.3, self.mask.shape) * self.mask).astype(np.float32)
        self.bias = np.zeros(self.mask.shape[1], np.float32)
        self.out = r.normal(0, 0.1, (self.mask.shape[1], len(classes))).astype(np.float32)
        self.out_bias = np.zeros(len(classes), np.float32)

    def _pool(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        wide = max(WIDTHS)
        flat = self.embed[x].reshape(len(x), -1)
        patches = np.lib.stride_tricks.sliding_window_view(flat, wide * EMBED, axis=1)[:, ::EMBED]
        patches = np.ascontiguousarray(patches)
        return patches, patches.reshape(-1, wide * EMBED) @ self.filters, flat

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Distribution over the classes for each window."""
        out = np.empty((len(x), len(self.classes)), np.float32)
        for at in range(0, len(x), _BLOCK):
            part = x[at : at + _BLOCK]
            _, values, _ = self._pool(part)
            top = np.maximum(values.reshape(len(part), -1, len(self.bias)).max(axis=1) + self.bias, 0)
            out[at : at + _BLOCK] = _softmax(top @ self.out + self.out_bias)
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 5, rate: float = 0.01) -> ByteNet:
        r = np.random.default_rng(seed)
        names = ("embed", "filters", "bias", "out", "out_bias")
        moments = {k: (np.zeros_like(getattr(self, k)), np.zeros_like(getattr(self, k))) for k in names}
        step = 0
        for epoch in range(epochs):
            order = r.permutation(len(x))
            for at in range(0, len(x), _BLOCK):
                pick = order[at : at + _BLOCK]
                step += 1
                for k, g in self._gradients(x[pick], y[pick]).items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    size = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                    getattr(self, k)[...] -= size * m / (np.sqrt(v) + 1e-7)
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        n, f, wide = len(x), len(self.bias), max(WIDTHS)
        patches, values, _ = self._pool(x)
        values = values.reshape(n, -1, f)
        at = values.argmax(axis=1)
        top = np.take_along_axis(values, at[:, None, :], axis=1)[:, 0] + self.bias
        high = np.maximum(top, 0)
        error = _softmax(high @ self.out + self.out_bias)
        error[np.arange(n), y] -= 1
        error /= n
        back = (error @ self.out.T) * (top > 0)
        best = patches[np.arange(n)[:, None], at]  # n, f, wide * EMBED
        to_filters = np.einsum("nf,nfp->pf", back, best, optimize=True) * self.mask
        to_patch = (back[:, :, None] * self.filters.T[None]).reshape(-1, EMBED)
        bytes_of = x[np.arange(n)[:, None, None], at[:, :, None] + np.arange(wide)].ravel()
        embed = np.zeros_like(self.embed)
        np.add.at(embed, bytes_of, to_patch)
        return {
            "embed": embed,
            "filters": to_filters.astype(np.float32),
            "bias": back.sum(axis=0),
            "out": high.T @ error,
            "out_bias": error.sum(axis=0),
        }

    def predict(self, texts: list[bytes | None]) -> Iterator[tuple[str, float]]:
        """Language and score of each whole text."""
        folded = [fold(t or b"") for t in texts]
        x, n = windows(folded)
        if not self.classes:
            yield from ((UNKNOWN, 0.0) for _ in texts)
            return
        p, weight = self.probabilities(x), _IS_LETTER[x].sum(axis=1)
        at = 0
        for text, k in zip(texts, n.tolist(), strict=True):
            w = weight[at : at + k]
            if not text or not w.sum() or (max(text) > 127 or not w.any()) and not has_letters(text):
                yield UNKNOWN, 0.0
            else:
                mean = w @ p[at : at + k] / w.sum()
                best = int(mean.argmax())
                yield self.classes[best], min(float(mean[best]), 1.0)
            at += k


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sample(labelled: DataFrame, per_language: int = PER_LANGUAGE, most: int = MOST_LANGUAGES, taught: int = TAUGHT) -> list:
    """Rows of lang and a window: the bounded sample that a network learns from."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.select(F.col("doc_id").cast("string"), F.col("lang").cast("string"), F.col("text").cast("string"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most).collect()
    draw = F.xxhash64(F.coalesce("doc_id", F.lit("")), "text")
    chance = F.create_map(*(F.lit(x) for r in counts for x in (r.lang, min(1.0, 2 * per_language / r.n)))) if counts else None
    if chance is None:
        return []
    # about twice as many by chance, in the scan; of these the first by the draw
    picked = rows.withColumn("draw", draw).where(F.pmod("draw", F.lit(1_000_003)) / 1_000_003 < F.coalesce(chance[F.col("lang")], F.lit(0.0)))
    picked = picked.dropDuplicates(["lang", "draw"])
    first = F.row_number().over(W.partitionBy("lang").orderBy("draw"))
    picked = cut(picked.withColumn("at", first).where(F.col("at") <= per_language).select("lang", "draw", "text"))

    def every(texts: pa.Array) -> pa.Array:
        out = []
        for t in text_bytes(texts):
            x, _ = windows([fold(t)])
            out.append([w.tobytes() for w in x])
        return pa.array(out, pa.list_(pa.binary()))

    cuts = picked.select("lang", "draw", F.posexplode(F.arrow_udf(every, "array<binary>")("text")).alias("place", "win"))
    sizes = {r.lang: r.n for r in picked.groupBy("lang").agg(F.sum(F.ceil(F.octet_length("text") / WINDOW)).alias("n")).collect()}
    if not sizes:
        return []
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, taught / max(n, 1)))))
    use = F.pmod(F.xxhash64("draw", "place"), F.lit(1_000_003)) / 1_000_003 < share[F.col("lang")]
    return sorted((r.lang, bytes(r.win)) for r in cuts.where(use).select("lang", "win").collect())


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE, epochs: int | None = None) -> ByteNet:
    """Learns from lang and text of ``labelled`` (doc_id only chooses the sample)."""
    rows = sample(labelled, per_language)
    classes = sorted({lang for lang, _ in rows})
    net = ByteNet(classes)
    if len(classes) > 1:
        x = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW)
        epochs = epochs or min(max(EPOCHS, -(-_STEPS * _BLOCK // len(x))), _ROUNDS)
        net.fit(x, np.searchsorted(classes, [lang for lang, _ in rows]), epochs)
    return net


def language(text: Column, net: ByteNet) -> Column:
    """Struct of lang and score."""

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [r for part in runs(texts) for r in net.predict(text_bytes(part))]
            yield struct_array(
                {"lang": pa.array([r[0] for r in rows], pa.string()), "score": pa.array([r[1] for r in rows], pa.float64())}
            )
        release()

    return F.arrow_udf(predict, "lang string, score double").asNondeterministic()(text.cast("string"))


def accepted(docs: DataFrame, net: ByteNet, least: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` in a known language with a score of ``least`` at least;
    all rows where the network has learned no language."""
    if not net.classes:
        return docs
    own = free_name(docs.columns, "found_language")
    known = (F.col(f"{own}.lang") != UNKNOWN) & (F.col(f"{own}.score") >= least)
    return docs.withColumn(own, language(F.col("text"), net)).where(known).drop(own)
