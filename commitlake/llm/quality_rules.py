"""Quality rules with risk-controlled thresholds.

Each document has a few shape features, the higher the worse, and is as odd as its
oddest feature: the least share of its stratum's (language's) documents, labelled or
not, that reach its level of a feature. A rule rejects what is odder than a share t; one
t means a cutoff for each feature. The larger t, the more is rejected, so the
rules of a stratum are a sequence from lax to strict, the same for all labels. They are tested in
this order on the stratum's good labelled documents, by an exact binomial test that at most ``risk``
of them are rejected, until the first that fails: a fixed sequence needs no
correction of its own, and no part of the risk is set aside for a single feature. The level is
corrected for the strata (Bonferroni). With probability ``1 - alpha`` at least, every
stratum's good documents are rejected with probability ``risk`` at most. A stratum that
the labels cannot vouch for (less than some 230 good ones of four strata) has no
cutoff and rejects nothing.

Words are runs of ``[^\\x20\\x09-\\x0D]``. Defined results: a null or empty text
has no words and fails the base rules; a null stratum is a stratum of its own;
repeated rows count as often as they occur; without labels only the base rules
hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.llm.common import SPACES, cut, free_name, mix64, runs, struct_array, text_bytes

#: Share of a stratum's good documents that the rules may reject.
RISK = 0.02
#: Probability that the guarantee fails anywhere.
ALPHA = 0.05
#: Levels of the cutoff grid of each feature.
GRID = 40
#: The shares of a stratum's documents whose rules are tested one after another.
STEPS = tuple(2 ** (-k / 4) for k in range(52, 3, -1))

#: Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_SYMBOLS = b"#*$%&|<>"
_INSIDE = bytes(range(0x80, 0xC0))  # bytes inside a code point
_UPPER = bytes(range(65, 91))
_STRIDE = 1_000_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier one."""
    if b"\n" not in text:
        return int(bool(text.strip())), 0
    own = [x for x in text.split(b"\n") if x.strip()]
    return len(own), len(own) - len(set(own))


def _repeats(w: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    seen, hit = {}, np.zeros(len(w), bool)
    for i, win in enumerate(zip(w, w[1:], w[2:])):
        first = seen.setdefault(win, i)
        if first != i:
            hit[first : first + 3] = hit[i : i + 3] = True
    return int(hit.sum())


def count(texts: list[bytes | None]) -> Iterator[tuple[int, ...]]:
    """The values of ``COUNTS`` for each text."""
    at = 0
    while at < len(texts):
        split, size = [], 0
        while at + len(split) < len(texts) and size < _STRIDE:
            split.append((texts[at + len(split)] or b"").split())
            size += len(split[-1])
        repeated = _maybe_repeated(split)
        for text, w, again in zip(texts[at : at + len(split)], split, repeated, strict=True):
            text = text or b""
            packed = text.translate(None, SPACES)
            lines, same = _lines(text)
            yield (
                len(w),
                len(packed.translate(None, _INSIDE)),
                len(text) - len(text.translate(None, _SYMBOLS)),
                same,
                _repeats(w) if again else 0,
                lines,
                len(packed) - len(packed.translate(None, _UPPER)),
            )
        at += len(split)


def _maybe_repeated(split: list[list[bytes]]) -> np.ndarray:
    """False for texts in which certainly no 3-word window repeats: hashes of
    all windows of all texts are sorted once; equal windows have equal hashes."""
    sizes = np.array([len(w) for w in split], np.int64)
    flat = np.fromiter((hash(x) for w in split for x in w), np.int64, int(sizes.sum())).view(np.uint64)
    found = np.zeros(len(split), bool)
    if len(flat) < 3:
        return found
    doc = np.repeat(np.arange(len(split), dtype=np.uint64), sizes)
    m = mix64(flat)
    windows = mix64(m[:-2] * np.uint64(3) + m[1:-1] * np.uint64(5) + m[2:] * np.uint64(7))
    windows ^= mix64(doc[:-2] + np.uint64(1))
    inside = np.flatnonzero(doc[:-2] == doc[2:])
    order = inside[np.argsort(windows[inside])]
    same = windows[order[1:]] == windows[order[:-1]]
    found[doc[order[1:][same]].astype(np.int64)] = True
    return found


def text_counts(text: Column) -> Column:
    """Struct of ``COUNTS``."""

    def counts(texts: pa.Array) -> pa.Array:
        found = [row for part in runs(texts) for row in count(text_bytes(part))]
        rows = np.array(found, np.int64).reshape(-1, len(COUNTS))
        return struct_array({c: pa.array(rows[:, i]) for i, c in enumerate(COUNTS)})

    return F.arrow_udf(counts, ", ".join(f"{c} long" for c in COUNTS)).asNondeterministic()(text)


def base_failed() -> Column:
    """Over the columns of ``COUNTS``."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _share(a: Column, b: Column) -> Column:
    return a / F.greatest(b, F.lit(1))


def features() -> dict[str, Column]:
    """Features between 0 and 1, over the columns of ``COUNTS``."""
    return {
        "symbols": _share(F.col("n_symbols"), F.col("word_chars")),
        "dup_lines": _share(F.col("n_dup_lines"), F.col("n_lines")),
        "repeats": _share(F.col("n_repeat_words"), F.col("n_words")),
        "upper": _share(F.col("n_upper"), F.col("word_chars")),
        "word_length": _share(F.col("word_chars"), F.col("n_words")) / GRID,
    }


def level(feature: Column, grid: int = GRID) -> Column:
    """0 to ``grid``: the grid cutoffs that the feature reaches."""
    return F.least(F.ceil(feature * grid), F.lit(grid)).cast("int")


def most_rejected(n: int, risk: float, alpha: float) -> int:
    """Largest k with P(Binomial(n, risk) <= k) <= alpha; -1 if there is none."""
    total, top = 0.0, -1
    for start in range(0, n + 1, 4096):
        for k in range(start, min(start + 4096, n + 1)):
            p = lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(risk) + (n - k) * np.log1p(-risk)
            total += np.exp(p)
            if total > alpha:
                return top
            top = k
    return top


def cutoffs(counted: DataFrame, good: Column, risk: float = RISK, alpha: float = ALPHA, grid: int = GRID) -> DataFrame:
    """stratum, feature, cutoff (the lowest rejected level) and n.

    ``counted``: a row for each document: stratum, and the columns of ``COUNTS``;
    ``good``: true for good labelled documents.
    """
    names = list(features())
    own = counted.select("stratum", F.coalesce(good, F.lit(False)).alias("good"), *(level(c, grid).alias(f) for f, c in features().items()))
    levels = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("level")) for f in names))
    bins = own.select("stratum", F.explode(levels).alias("x")).groupBy("stratum", "x.feature", "x.level").agg(F.count("*").alias("n"))

    def steps(rows):
        """For each feature and level the first step whose rule rejects it."""
        import pandas as pd

        out = []
        for f in names:
            counts = np.zeros(grid + 1, np.int64)
            mine = rows[rows["feature"] == f]
            counts[mine["level"]] = mine["n"]
            share = counts[::-1].cumsum()[::-1] / max(counts.sum(), 1)
            first = np.searchsorted(STEPS, share, side="left")
            first[0] = len(STEPS)  # the lowest level is never odd
            out.append([int(x) for x in first])
        return pd.DataFrame({"stratum": [rows["stratum"].iloc[0]], "steps": [out]})

    # at most (grid + 1) rows for each feature of a stratum, and a row of their steps
    known = cut(bins.groupBy("stratum").applyInPandas(steps, "stratum string, steps array<array<int>>"))
    known = known.withColumnRenamed("stratum", "of_stratum")
    rated = own.where("good").join(known, F.col("stratum").eqNullSafe(F.col("of_stratum")))
    step = F.least(*(F.get(F.get("steps", F.lit(i)), F.col(f)) for i, f in enumerate(names)))
    rated = rated.select("stratum", step.alias("step")).groupBy("stratum", "step").agg(F.count("*").alias("n"))
    rated = cut(rated)
    strata = max(1, rated.select("stratum").distinct().count())

    def choose(rows):
        import pandas as pd

        counts = np.zeros(len(STEPS) + 1, np.int64)
        counts[rows["step"]] = rows["n"]
        n = int(counts.sum())
        fits = np.flatnonzero(counts[:-1].cumsum() <= most_rejected(n, risk, alpha / strata))
        return pd.DataFrame({"stratum": [rows["stratum"].iloc[0]], "last": [int(fits[-1]) if len(fits) else -1], "n": [n]})

    chosen = rated.groupBy("stratum").applyInPandas(choose, "stratum string, last int, n long").where("last >= 0")
    found = chosen.join(known, F.col("stratum").eqNullSafe(F.col("of_stratum")))
    found = found.select("stratum", "n", "last", F.posexplode("steps").alias("at", "first"))
    lowest = F.size(F.filter("first", lambda x: x > F.col("last")))
    feature = F.get(F.array(*map(F.lit, names)), F.col("at"))
    return found.select("stratum", feature.alias("feature"), lowest.cast("int").alias("cutoff"), "n").where(F.col("cutoff") <= grid)


def with_verdict(
    counted: DataFrame, good: Column, risk: float = RISK, alpha: float = ALPHA, grid: int = GRID
) -> DataFrame:
    """``counted`` (stratum and the columns of ``COUNTS``) with base_failed and kept;
    columns of these names are replaced.

    ``good`` is an expression over ``counted``: true for good labelled documents.
    """
    names = list(features())
    own = {x: free_name(counted.columns, x) for x in ("of_stratum", *(f"cutoff_{f}" for f in names))}
    chosen = cutoffs(counted.where(~base_failed()), good, risk, alpha, grid)
    wide = chosen.groupBy(F.col("stratum").alias(own["of_stratum"])).pivot("feature", names).agg(F.first("cutoff"))
    wide = wide.select(own["of_stratum"], *(F.col(f).alias(own[f"cutoff_{f}"]) for f in names))
    rejected = F.lit(False)
    for f, c in features().items():
        rejected = rejected | F.coalesce(level(c, grid) >= F.col(own[f"cutoff_{f}"]), F.lit(False))
    joined = counted.join(wide, F.col("stratum").eqNullSafe(F.col(own["of_stratum"])), "left")
    return joined.select(
        *(F.col(c) for c in counted.columns if c.lower() not in ("base_failed", "kept")),
        base_failed().alias("base_failed"),
        (~base_failed() & ~rejected).alias("kept"),
    )
