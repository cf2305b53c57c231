"""Mixing sources to target weights (Efraimidis-Spirakis sampling).

Every source gets a target in words: its weight's share of ``share`` times
all words, but ``most`` times its own size at most; what is cut off goes to
the other sources by weight until none is above. A source is taken in whole
epochs first; the rest of its target is a weighted sample without
replacement. Each document draws an exponential key, ``-ln(u) / weight``, with
u from a hash of its id and text and its quality weight; documents are taken
in the order of their keys while the prefix sum of their sizes fits.

The prefix sums are not made in one sorted task for each source. A source's
keys are mapped to (0, 1) by the source's own key distribution (weights have
eight levels, so it is known from eight counts) and cut into bins of about
``BIN`` documents; bins are summed before the shuffle, and only the one bin
of each source that the budget ends in is sorted.

Sizes are words, runs of ``[^\\x20\\x09-\\x0D]``. Defined results: a null text
has size 0 and is taken with 0 words; a null source is a source of its own,
the last in order; rows alike in id, source and text draw one key, and as
many of them are taken as fit; the document that the budget ends in is taken
when that comes nearer to the target; an empty table mixes to nothing. The
result depends on the rows only, not on their order or partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commitlake.llm.common import cut, free_name, small

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix over words of all sources.
SHARE = 1.5
#: Words of a source in the mix over its own words.
MOST = 2
#: Documents of a bin, about.
BIN = 1024
LEVELS = 8
#: Copies of one row that a task makes from one row of the copy table.
_COPIES = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def quality_level(text: Column) -> Column:
    """1 to ``LEVELS``: less for texts with many symbols."""
    chars = F.length(text)
    symbols = chars - F.length(F.translate(text, "#*$%&|<>!{}[]~^=_\\", ""))
    share = F.least(F.coalesce(symbols / F.greatest(chars, F.lit(1)), F.lit(1.0)) * 10, F.lit(1.0))
    return (F.lit(LEVELS) - F.floor(share * (LEVELS - 1))).cast("int")


def _keyed(docs: DataFrame) -> DataFrame:
    """source, size, level, h (64-bit identity of the row) and key."""
    rows = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        n_words(F.col("text").cast("string")).alias("size"),
        quality_level(F.col("text").cast("string")).alias("level"),
        _identity().alias("h"),
    )
    return rows.withColumn("key", _key())


def _identity(row: str = "") -> Column:
    """64 bits of a row's id and text."""
    parts = [F.coalesce(F.col(row + c).cast("string"), F.lit("\0")) for c in ("doc_id", "text")]
    return F.xxhash64(*parts)


def _key() -> Column:
    u = (F.shiftrightunsigned(F.col("h"), 11).cast("double") + 0.5) / float(2**53)
    return -F.log(u) * LEVELS / F.col("level")


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``sizes`` (a row for each source: source, source_size, ...) with target."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(F.col("i"), F.lit(len(weights))) + 1)
    rows = (
        sizes.withColumn("i", (F.row_number().over(order) - 1).cast("int"))
        .withColumn("w", pick)
        .withColumn("most", most * F.col("source_size").cast("double"))
        .withColumn("ratio", F.col("most") / F.col("w"))
    )
    # in the order of most / weight, sources reach their most one by one;
    # theta is what a unit of weight gets when all before are at theirs
    before = W.orderBy("ratio", "i").rowsBetween(W.unboundedPreceding, -1)
    total, weight = F.sum(F.col("source_size")).over(W.partitionBy()) * share, F.sum("w").over(W.partitionBy())
    left = total - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    rows = rows.withColumn("theta", left / (weight - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    first = F.struct("ratio", "i", "theta")
    level = F.min(F.when(F.col("theta") < F.col("ratio"), first)).over(W.partitionBy())["theta"]
    rows = rows.withColumn("level", level)
    capped = F.col("level").isNull() | (F.col("ratio") <= F.col("level"))
    target = F.when(capped, F.col("most")).otherwise(F.col("level") * F.col("w"))
    return rows.withColumn("target", target).drop("i", "w", "most", "ratio", "theta", "level")


class Mix:
    """The decisions of one mix.

    ``units``: source, h, level, size, key, doc_id and c, the number of rows
    alike. ``sources``: a row for each source: source_size, target, epochs and
    the point where its budget ends: end_key, end_h, end_m (rows of that unit
    that are taken once more) and end_c (rows of that unit).
    """

    def __init__(
        self,
        docs: DataFrame,
        weights: Sequence[float] = WEIGHTS,
        share: float = SHARE,
        most: float = MOST,
    ):
        rows = _keyed(docs)
        self.units = cut(rows.groupBy("source", "h", "level", "size", "key", "doc_id").agg(F.count("*").alias("c")))
        counts = [F.sum(F.when(F.col("level") == v, F.col("c"))).alias(f"n{v}") for v in range(1, LEVELS + 1)]
        sizes = self.units.groupBy("source").agg(
            F.sum(F.col("size") * F.col("c")).alias("source_size"), F.sum("c").alias("n"), *counts
        )
        epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
        sources = cut(
            targets(sizes, weights, share, most)
            .withColumn("epochs", epochs)
            .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        )
        self.sources = cut(self._ends(sources))

    def _ends(self, sources: DataFrame) -> DataFrame:
        levels = [f"n{v}" for v in range(1, LEVELS + 1)]
        narrow = small(sources).select(F.col("source").alias("s"), "n", "rest", *levels)
        units = self.units.where("size > 0").join(narrow, F.col("source").eqNullSafe(F.col("s")))
        # the share of the source's documents with a smaller key
        below = sum(
            F.coalesce(F.col(f"n{v}"), F.lit(0)) * (1 - F.exp(-F.col("key") * (v / LEVELS))) for v in range(1, LEVELS + 1)
        ) / F.col("n")
        units = units.withColumn("bin", F.floor(below * F.ceil(F.col("n") / BIN)))
        words = F.col("size") * F.col("c")
        bins = units.groupBy("s", "bin", "rest").agg(F.sum(words).alias("words"))
        so_far = F.sum("words").over(W.partitionBy("s").orderBy("bin"))
        last = (
            bins.withColumn("so_far", so_far)
            .where("so_far > rest")
            .groupBy("s")
            .agg(F.min(F.struct("bin", F.expr("so_far - words").alias("before"))).alias("at"))
            .select(F.col("s").alias("s1"), F.col("at.bin").alias("bin1"), "at.before")
        )
        inside = units.join(last, F.col("s").eqNullSafe(F.col("s1")) & (F.col("bin") == F.col("bin1")))
        running = F.col("before") + F.sum(words).over(W.partitionBy("s").orderBy("key", "h"))
        end = (
            inside.withColumn("so_far", running)
            .where("so_far > rest")
            .withColumn("m", F.round((F.col("rest") - F.col("so_far") + words) / F.col("size")).cast("long"))
            .groupBy("s")
            .agg(F.min(F.struct("key", "h", "m", "c")).alias("end"))
        )
        return sources.drop("n", *levels).join(end, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source",
            "source_size",
            "target",
            "epochs",
            "rest",
            F.col("end.key").alias("end_key"),
            F.col("end.h").alias("end_h"),
            F.col("end.m").alias("end_m"),
            F.col("end.c").alias("end_c"),
        )

    def decided(self, rows: DataFrame, source: str) -> DataFrame:
        """``rows`` (with key and h) joined with their source's row and ``extra``:
        1 for rows taken once more, 0 for others, null at the end point."""
        ends = small(self.sources).withColumnRenamed("source", "s")
        at, end = F.struct("key", "h"), F.struct(F.col("end_key").alias("key"), F.col("end_h").alias("h"))
        # without an end point the budget holds all that is left
        extra = (
            F.when(F.col("rest") <= 0, F.lit(0))
            .when(F.col("end_key").isNull() | (at < end), F.lit(1))
            .when(at > end, F.lit(0))
        )
        return rows.join(ends, F.col(source).eqNullSafe(F.col("s"))).drop("s").withColumn("extra", extra)

    def report(self) -> DataFrame:
        """doc_id, source, size, source_size, target, taken of every document row."""
        rows = self.decided(self.units, "source")
        once = F.coalesce(F.col("extra") * F.col("c"), F.col("end_m"))
        parts = F.array(
            F.struct(once.alias("rows"), F.lit(1).alias("more")),
            F.struct((F.col("c") - once).alias("rows"), F.lit(0).alias("more")),
        )
        rows = rows.select("doc_id", "source", "size", "source_size", "target", "epochs", F.explode(parts).alias("p"))
        taken = F.col("size") * (F.col("epochs") + F.col("p.more"))
        rows = rows.select("*", taken.alias("taken"), F.col("p.rows").alias("rows")).where("rows > 0")
        return copies(rows, "rows").select("doc_id", "source", "size", "source_size", "target", "taken")


def copies(rows: DataFrame, n: str) -> DataFrame:
    """Each row n times; rows that are wanted more than ``_COPIES`` times are
    first dealt out in parts, so that no task makes them alone."""
    few, many, part = rows.where(F.col(n) <= _COPIES), rows.where(F.col(n) > _COPIES), free_name(rows.columns, "part")
    parts = many.withColumn(part, F.explode(F.expr(f"sequence(0, ({n} - 1) div {_COPIES})")))
    parts = parts.withColumn(n, F.expr(f"least({_COPIES}, {n} - {part} * {_COPIES})"))
    parts = parts.repartition(F.col(part), F.col(n)).drop(part)
    return _repeated(few, n).unionByName(_repeated(parts, n))


def _repeated(rows: DataFrame, n: str) -> DataFrame:
    own = free_name(rows.columns, "copy")
    return rows.withColumn(own, F.explode(F.expr(f"sequence(1, {n})"))).drop(own, n)


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mix: rows of ``docs`` as often as they are taken."""
    decisions = Mix(docs, weights, share, most)
    own = "document"  # the whole row, so that none of its names can clash
    rows = docs.select(F.struct("*").alias(own)).select(
        own,
        F.col(f"{own}.source").cast("string").alias("source"),
        quality_level(F.col(f"{own}.text").cast("string")).alias("level"),
        _identity(f"{own}.").alias("h"),
    )
    rows = decisions.decided(rows.withColumn("key", _key()), "source")
    alone = F.coalesce(F.col("extra"), F.when(F.col("end_c") == 1, F.col("end_m"))) + F.col("epochs")
    taken = rows.where(alone > 0).withColumn("n", alone.cast("long"))
    out = _repeated(taken, "n").select(f"{own}.*")
    if decisions.sources.where("end_c > 1").isEmpty():
        return out
    # rows alike at an end point: one of them, as often as they are taken in all
    alike = rows.where("extra IS NULL AND end_c > 1").dropDuplicates(["source", "h"])
    alike = alike.withColumn("n", F.col("epochs") * F.col("end_c") + F.col("end_m")).where("n > 0")
    return out.unionByName(copies(alike, "n").select(f"{own}.*"))
