"""Secret scan: fixed patterns, and a battery of randomness tests.

DataFrame functions only. Three patterns give the base spans. Besides, every
token that could be an encoded key (``TOKEN``) is tested. Its encoding is the
smallest alphabet that holds it, and its characters are numbers in it:

* chi-squared of the alphabet's uniformity,
* runs above and below the middle of the alphabet (Wald-Wolfowitz),
* serial correlation of neighbouring characters.

A token whose three p-values together (Fisher) speak against randomness is no
secret. For the others the question is turned round: the null hypothesis is that
the token is like the ordinary words and identifiers of the corpus. All three
tests, as normal deviates, count: their joint distribution over ordinary tokens
is fitted (``fitted``) in each stratum, an encoding and a class of lengths, from a
histogram of the corpus's distinct tokens, beside the known one of random tokens.
``ENCODINGS`` gives the start, and the null of a stratum with few ordinary tokens.
The deviates' best linear score between the two has a p-value under the fitted null.
The false-discovery rate is controlled (Benjamini-Hochberg at ``RATE``) within each
stratum over its distinct tokens, from a histogram of their p-values, as exact as
its fine bins and never laxer than them. Tokens that stay are added as spans of the
kind ``random``.

Spans are code points, end exclusive. Defined results: a null or empty text has
no spans; a token that overlaps a base span is not added; tokens of letters only
or digits only have no encoding and are not tested; rows that repeat are scanned one
by one, but a token counts once in the fit and the rates, however many copies of it
there are; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from commitlake.llm.common import cut

#: The base patterns, in the order of the kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, ACCESS_LENGTH = r"AKIA[A-Z0-9]+", 18
HEX, HEX_LENGTH = r"[0-9a-f]+", 16
ASSIGN_LENGTH = 12
KINDS = ("assign", "access", "hex", "random")
#: Runs of 20 characters and more with a letter and a digit, from their start.
TOKEN = (
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}"
)
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
#: Encodings, the smallest first, and how far ordinary text in them is from
#: uniform: k * sum of squared shares - 1, half of what word-like tokens show.
ENCODINGS = {
    _DIGITS + "abcdef": 0.5,
    _DIGITS + "ABCDEF": 0.5,
    _UPPER + "234567": 0.6,
    _DIGITS + _LOWER: 0.7,
    _DIGITS + _UPPER: 0.7,
    _UPPER + _LOWER + _DIGITS: 1.2,
    _UPPER + _LOWER + _DIGITS + "+/": 1.2,
    _UPPER + _LOWER + _DIGITS + "-_": 1.2,
}
RATE = 0.05
#: Fisher's p-value below which a token has too much structure.
STRUCTURE = 0.001
#: Bins of the p-value histogram in a factor of ten, and bins in all.
_FINE, _BINS = 20, 400
#: Class of the longest tokens (4,096 characters on).
_LONGEST = 24
#: Deviates (chi-squared, runs, serial correlation): bins' widths, and their bounds.
DEVIATES = ("of_chi", "by_runs", "by_serial")
_WIDE, _LOW, _HIGH = np.array([0.5, 0.5, 0.5]), np.array([-4.0, -6.0, -6.0]), np.array([16.0, 6.0, 6.0])
#: Covariance of a random token's deviates: runs see the halves of what serial
#: correlation sees whole, for an even spread sqrt(3) / 2 of it on either side.
_RANDOM = np.array([[1.0, 0.0, 0.0], [0.0, 1.0, -0.75], [0.0, -0.75, 1.0]])
#: Tokens that the start of the fit counts for, and rounds.
_PRIOR, _ROUNDS = 10.0, 100


def _running(lengths: Column) -> Column:
    """Running totals, in blocks of about the square root of the array's size,
    as each step copies what the fold has so far."""
    n = F.size(lengths)
    wide = F.greatest(F.ceil(F.sqrt(n)), F.lit(1)).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(n / wide).cast("int") - 1), lambda i: F.slice(lengths, i * wide + 1, wide)
    )

    def fold(block: Column, start: Column) -> Column:
        first = F.struct(start.alias("t"), F.array().cast("array<int>").alias("out"))
        step = lambda s, x: F.struct((s["t"] + x).alias("t"), F.concat(s["out"], F.array(s["t"] + x)).alias("out"))
        return F.aggregate(block, first, step, lambda s: s["out"])

    first = F.struct(F.lit(0).alias("t"), F.array().cast("array<array<int>>").alias("out"))

    def join(s: Column, block: Column) -> Column:
        own = fold(block, s["t"])
        return F.struct(F.element_at(own, -1).alias("t"), F.concat(s["out"], F.array(own)).alias("out"))

    return F.flatten(F.aggregate(blocks, first, join, lambda s: s["out"]))


def matches(text: Column, pattern: str) -> Column:
    """Array of start, end, match: all leftmost non-overlapping matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    steps = F.zip_with(between, found, lambda a, b: F.length(a) + F.length(b))
    spans = F.zip_with(
        _running(steps),
        found,
        lambda end, m: F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("match")),
    )
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def _normal(z: Column) -> Column:
    """The normal distribution's lower tail (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z > 0, 1 - upper).otherwise(upper)


def tested(tokens: Column) -> Column:
    """Array of start, end, stratum, structure (Fisher's p-value), natural (that of
    chi-squared alone against ``ENCODINGS``), the ``DEVIATES`` and the token's hash,
    of the tokens that have an encoding.

    Each step adds to the structs what the next ones use, so that nothing is
    evaluated again for every character.
    """
    sizes = F.array(*(F.lit(len(a)) for a in ENCODINGS))
    deviations = F.array(*(F.lit(float(d)) for d in ENCODINGS.values()))
    alphabets = F.array(*map(F.lit, ENCODINGS))
    halves = F.array(*(F.lit("0" * (len(a) // 2) + "1" * (len(a) - len(a) // 2)) for a in ENCODINGS))

    def encoding(token: Column) -> Column:
        out = F.lit(None).cast("int")
        for i, alphabet in reversed(list(enumerate(ENCODINGS, 1))):
            out = F.when(token.rlike(f"^[{alphabet}]+$"), F.lit(i)).otherwise(out)  # the dash is last
        return out

    def step(array: Column, **made) -> Column:
        """The structs with more fields, each made from a struct."""
        return F.transform(array, lambda t: _with(t, {k: f(t) for k, f in made.items()}))

    def _with(t: Column, fields: dict[str, Column]) -> Column:
        for k, c in fields.items():
            t = t.withField(k, c)
        return t

    def tail(z: Column) -> Column:
        return F.greatest(2 * _normal(-F.abs(z)), F.lit(1e-300))

    t = F.filter(step(tokens, e=lambda t: encoding(t["match"])), lambda t: t["e"].isNotNull())
    t = step(
        t,
        k=lambda t: F.element_at(sizes, t["e"]).cast("double"),
        d=lambda t: F.element_at(deviations, t["e"]),
        n=lambda t: F.length(t["match"]).cast("double"),
        c=lambda t: F.filter(F.split(t["match"], ""), lambda c: c != ""),
        a=lambda t: F.element_at(alphabets, t["e"]),
    )
    t = step(
        t,
        squares=lambda t: F.aggregate(
            F.array_distinct(t["c"]),
            F.lit(0.0),
            lambda s, c: s + F.pow(F.length(t["match"]) - F.length(F.replace(t["match"], c, F.lit(""))), F.lit(2)),
        ),
        x=lambda t: F.transform(t["c"], lambda c: F.instr(t["a"], c).cast("double")),
        halves=lambda t: F.call_function("translate", t["match"], t["a"], F.element_at(halves, t["e"])),
    )
    t = step(
        t,
        chi=lambda t: t["k"] * t["squares"] / t["n"] - t["n"],
        mean=lambda t: F.aggregate(t["x"], F.lit(0.0), lambda s, v: s + v) / t["n"],
        runs=lambda t: F.length(F.regexp_replace(t["halves"], r"(.)\1*", "x")),
        ones=lambda t: F.length(F.replace(t["halves"], F.lit("0"), F.lit(""))).cast("double"),
    )
    t = step(
        t,
        x=lambda t: F.transform(t["x"], lambda v: v - t["mean"]),
        both=lambda t: 2 * t["ones"] * (t["n"] - t["ones"]),
    )
    t = step(
        t,
        var=lambda t: F.greatest(F.aggregate(t["x"], F.lit(0.0), lambda s, v: s + v * v), F.lit(1e-9)),
        next=lambda t: F.aggregate(
            F.zip_with(F.slice(t["x"], F.lit(1), F.size(t["x"]) - 1), F.slice(t["x"], F.lit(2), F.size(t["x"]) - 1), lambda a, b: a * b),
            F.lit(0.0),
            lambda s, v: s + v,
        ),
        spread=lambda t: F.sqrt(
            F.greatest(t["both"] * (t["both"] - t["n"]) / (t["n"] * t["n"] * (t["n"] - 1)), F.lit(1e-9))
        ),
    )
    # Wilson and Hilferty: chi-squared's cube root is about normal
    nine = lambda t: 2 / (9 * (t["k"] - 1))
    cube = lambda t: (F.pow(t["chi"] / (t["k"] - 1), F.lit(1 / 3)) - (1 - nine(t))) / F.sqrt(nine(t))
    t = step(
        t,
        of_chi=cube,
        by_runs=lambda t: (t["runs"] - t["both"] / t["n"] - 1) / t["spread"],
        by_serial=lambda t: (t["next"] / t["var"] + 1 / t["n"]) * F.sqrt(t["n"]),
    )
    t = step(
        t,
        uniform=lambda t: F.greatest(_normal(-t["of_chi"]), F.lit(1e-300)),
        of_runs=lambda t: tail(t["by_runs"]),
        of_serial=lambda t: tail(t["by_serial"]),
        centre=lambda t: (t["k"] - 1) + t["n"] * t["d"],
    )
    # half of Fisher's statistic, and a chi-squared as uneven as ordinary text's
    t = step(
        t,
        half=lambda t: -(F.log(t["uniform"]) + F.log(t["of_runs"]) + F.log(t["of_serial"])),
        z=lambda t: (t["chi"] - t["centre"]) / F.sqrt(2 * (t["centre"] + t["n"] * t["d"])),
    )
    return F.transform(
        t,
        lambda t: F.struct(
            t["start"].alias("start"),
            t["end"].alias("end"),
            _stratum(t["e"], t["match"]).alias("stratum"),
            (F.exp(-t["half"]) * (1 + t["half"] + t["half"] * t["half"] / 2)).alias("structure"),
            F.greatest(_normal(t["z"]), F.lit(1e-300)).alias("natural"),
            *(t[x].alias(x) for x in DEVIATES),
            F.xxhash64(t["match"]).alias("token"),
        ),
    )


def _stratum(encoding: Column, token: Column) -> Column:
    """100 times the encoding's number and the length class: halves of a doubling."""
    return encoding * 100 + F.least(F.floor(2 * F.log2(F.length(token))), F.lit(_LONGEST)).cast("int")


def _start(stratum: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of ordinary tokens' deviates, as ``ENCODINGS`` has them."""
    (alphabet, d), n = list(ENCODINGS.items())[stratum // 100 - 1], 2 ** ((stratum % 100 + 0.5) / 2)
    free = len(alphabet) - 1
    centre, nine = free + n * d, 2 / (9 * free)
    mean, cov = np.zeros(3), _RANDOM.copy()
    mean[0] = ((centre / free) ** (1 / 3) - (1 - nine)) / math.sqrt(nine)
    slope = (centre / free) ** (-2 / 3) / (3 * free * math.sqrt(nine))
    cov[0, 0] = max(2 * (centre + n * d) * slope**2, 1.0)
    return mean, cov


def fitted(stratum: int, x: np.ndarray, n: np.ndarray) -> tuple[list[float], float]:
    """Weights of the deviates and an offset: the score, standard normal for ordinary
    tokens and low for random ones.

    ``x``: deviates (rows of three), each ``n`` times. A mixture of random tokens,
    whose distribution is known, and ordinary ones, normal, by expectation
    maximisation.
    """

    def density(mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
        off = x - mean
        return np.exp(-0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off)) / math.sqrt(np.linalg.det(cov))

    mean0, cov0 = mean, cov = _start(stratum)
    random, share = density(np.zeros(3), _RANDOM), 0.1
    for _ in range(_ROUNDS):
        a, b = share * random, (1 - share) * density(mean, cov)
        ordinary = n * np.where(a + b > 0, b / np.maximum(a + b, 1e-300), 1.0)
        share = float(np.clip(1 - ordinary.sum() / n.sum(), 1e-6, 1 - 1e-6))
        weight = _PRIOR + ordinary.sum()
        mean = (_PRIOR * mean0 + ordinary @ x) / weight
        off, start = x - mean, mean0 - mean
        cov = (_PRIOR * (cov0 + np.outer(start, start)) + (off * ordinary[:, None]).T @ off) / weight
        cov = cov + np.diag(_WIDE**2 / 12)
    w = np.linalg.solve(cov, mean)
    w /= math.sqrt(w @ cov @ w)
    return [float(v) for v in w], float(-w @ mean)


def fits(tokens: DataFrame) -> dict[int, tuple[list[float], float]]:
    """``fitted`` of each stratum; ``tokens``: stratum and ``DEVIATES``, a row for each
    distinct token. The histogram has at most 8 * 17 strata of 40 * 24 * 24 bins."""
    bins = [
        F.floor((F.least(F.greatest(F.col(c), F.lit(float(a))), F.lit(float(b))) - float(a)) / float(w)).alias(c)
        for c, a, b, w in zip(DEVIATES, _LOW, _HIGH, _WIDE, strict=True)
    ]
    cells: dict[int, list] = {}
    for r in tokens.select("stratum", *bins).groupBy("stratum", *DEVIATES).count().toLocalIterator():
        cells.setdefault(r[0], []).append(tuple(r)[1:])
    out = {}
    for stratum in sorted(cells):
        rows = np.array(sorted(cells.pop(stratum)), float)
        out[stratum] = fitted(stratum, _LOW + (rows[:, :3] + 0.5) * _WIDE, rows[:, 3])
    return out


def base_spans(text: Column) -> Column:
    """Array of start, kind's number, end: the base spans in order."""

    def spans(found: Column, kind: int) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))

    # a run of a class is matched as a whole, so a minimum length can stand in
    # the pattern; an assignment that fails still uses up its characters
    assign = F.filter(
        matches(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["match"], ASSIGN, 2)) >= ASSIGN_LENGTH
    )
    access = matches(text, ACCESS.replace("+", f"{{{ACCESS_LENGTH - 4},}}"))
    hexes = matches(text, HEX.replace("+", f"{{{HEX_LENGTH},}}"))
    return F.array_sort(F.concat(spans(assign, 0), spans(access, 1), spans(hexes, 2)))


def thresholds(tokens: DataFrame, rate: float = RATE) -> dict[int, int]:
    """For each stratum the lowest bin of p-values that is a discovery.

    ``tokens``: stratum and bin (``_FINE`` bins to a factor of ten, higher for
    smaller p-values), a row for each distinct token. The histogram has at most
    8 * 17 strata of ``_BINS`` bins.
    """
    bins = tokens.groupBy("stratum", "bin").agg(F.count("*").alias("n"))
    down = W.partitionBy("stratum").orderBy(F.col("bin").desc())
    edges = bins.withColumn("found", F.sum("n").over(down)).withColumn("m", F.sum("n").over(W.partitionBy("stratum")))
    fits = F.col("m") * F.pow(F.lit(10.0), -F.col("bin") / _FINE) <= rate * F.col("found")
    return {r.stratum: r.b for r in edges.where(fits).groupBy("stratum").agg(F.min("bin").alias("b")).collect()}


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id and spans (kind, start, end, in order) of every document row."""
    text = F.col("text")
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = rows.select("doc_id", base_spans(text).alias("base"), matches(text, TOKEN).alias("tokens"))
    apart = F.filter(
        "tokens",
        lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    kept = F.transform(
        tested(F.col("apart")),
        lambda t: F.struct(
            t["start"].alias("start"),
            t["end"].alias("end"),
            t["stratum"].alias("stratum"),
            t["token"].alias("token"),
            *(t[x].alias(x) for x in DEVIATES),
            (t["structure"] >= STRUCTURE).alias("even"),
        ),
    )
    # a column of its own, and only where there is a token, so that most rows do nothing here
    found = found.select("doc_id", "base", F.when(F.size("tokens") > 0, apart).alias("apart"))
    fields = ",".join(f"{x}:double" for x in DEVIATES)
    none = F.array().cast(f"array<struct<start:int,end:int,stratum:int,token:bigint,{fields},even:boolean>>")
    found = cut(found.select("doc_id", "base", F.when(F.size("apart") > 0, kept).otherwise(none).alias("tokens")))
    once = found.select(F.explode("tokens").alias("t")).groupBy("t.stratum", "t.token")
    once = cut(once.agg(*(F.first(f"t.{x}").alias(x) for x in DEVIATES)))
    models = fits(once)

    def bin_of(stratum: Column, deviates: list[Column]) -> Column:
        """Bin of the p-value under the stratum's null."""
        parts = [F.lit(v) for k, (w, at) in models.items() for v in (k, [*w, at])]
        model = F.element_at(F.create_map(*parts), stratum)
        z = F.element_at(model, 4)
        for i, x in enumerate(deviates, 1):
            z = z + F.element_at(model, i) * x
        return F.least(F.floor(-F.log10(F.greatest(_normal(z), F.lit(1e-300))) * _FINE), F.lit(_BINS)).cast("int")

    limits = {}
    if models:
        limits = thresholds(once.select("stratum", bin_of(F.col("stratum"), [F.col(x) for x in DEVIATES]).alias("bin")), rate)

    def discovered(t: Column) -> Column:
        if not limits:
            return F.lit(False)
        hit = F.element_at(F.create_map(*(F.lit(v) for x in limits.items() for v in x)), t["stratum"])
        return F.coalesce(bin_of(t["stratum"], [t[x] for x in DEVIATES]) >= hit, F.lit(False)) & t["even"]

    random = F.transform(
        F.filter("tokens", discovered),
        lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")),
    )
    every = F.array_sort(F.concat("base", random))
    named = F.transform(
        every,
        lambda s: F.struct(
            F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
        ),
    )
    return found.select("doc_id", named.alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
