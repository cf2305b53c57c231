"""As-of join: for each row the newest row of another table that is not after it.

The rows of both tables are dealt by their key, and in each task the last row of the right
table is carried along the rows of a key in the order of time. A key with very many rows
(told by the counts of a sample of rows) is cut by time into stretches of about ``TOGETHER``
rows, which are dealt apart; a moment at which a key has that many rows is a stretch of its own,
whose rows are dealt at random. What a stretch carries in from those before it comes from
the last right row of each, by an aggregate with partial sums in the tasks. No pairs are made, and
no task holds a whole key.

Plan: a pass over keys and times for the sample, one shuffle of the needed columns, by key and stretch,
that serves the windows, and where there are such keys a pass over their right rows. Broadcast: the
borders of the stretches and what they carry in, a row for each ``TOGETHER`` rows at most.
Only the sample is checkpointed. Where the left rows are the right rows as well, each is
shuffled and sorted once: what it finds is the row before the first one of its time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlake.functions import repo_name
from commitlake.operators._paths import SHA, URL
from commitlake.session import ensure_checkpoint_dir

_COMMITTED = "commit.committer.date"
#: Rows of one key that are worked on together, about; the sample has one row in ``SAMPLED``.
TOGETHER, SAMPLED = 200_000, 64
#: Sampled rows for each border of a stretch.
_FOR_BORDER = 100


def as_of_join(
    left: DataFrame,
    right: DataFrame | Mapping[str, str],
    keys: Sequence[str],
    time: str,
    found: str = "found",
    strict: bool = False,
    partitions: int | None = None,
    hashes: Sequence[str] = (),
) -> DataFrame:
    """``left`` with ``found``: a struct of the other columns of ``right`` and its time,
    from the row with equal ``keys`` and the greatest ``time`` that is not after the left row's
    (``strict``: that is before it); null where there is none.

    Both tables have the columns ``keys`` and ``time``. ``right`` may be names in ``found`` and
    the columns of ``left`` that they stand for: then the left rows are the right rows as well.
    Of right rows with one key and time
    the one whose other columns are greatest counts, in their order. Null keys equal
    nothing, and rows without a time meet nothing; such left rows stay, with null.
    ``found`` must not be a column of ``left``. ``partitions``: of the shuffle, and stretches of a
    key at most (default: the session's shuffle partitions). ``hashes``: columns of ``left`` whose
    texts are hexadecimal digits as a rule: such texts go through the shuffle as bytes.
    """
    if found in left.columns:
        raise ValueError(f"left has a column {found!r} already")
    same_rows = not isinstance(right, DataFrame)
    most = partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = {c: left.schema[c].dataType for c in (*keys, time)}
    names = {c: f"_k{i}" for i, c in enumerate(keys)} | {time: "_t"}
    whole = F.lit(True)
    for c in kinds:
        whole = whole & F.col(c).isNotNull()
    at = [F.col(c).cast(kinds[c]).alias(n) for c, n in names.items()]
    own = {c: f"_c{i}" for i, c in enumerate(c for c in left.columns if c not in kinds)}
    rows = left.select(*at, *(F.col(c).alias(n) for c, n in own.items()), whole.alias("_whole"), F.lit(True).alias("_asks"))
    names |= own
    if same_rows:
        value = F.struct(F.col("_t").alias(time), *(F.col(names[c]).alias(n) for n, c in right.items()))
    else:
        others = [c for c in right.columns if c not in kinds]
        rights = right.where(whole).select(*at, F.struct(F.lit(True).alias("_is"), *others).alias("_others"), F.lit(True).alias("_whole"), F.lit(False).alias("_asks"))
        rows = rows.unionByName(rights, allowMissingColumns=True)
        value = F.struct(F.col("_t").alias(time), *(F.col("_others")[c].alias(c) for c in others))
    key = [names[c] for c in keys]
    borders = _borders(rows.where("_whole").select(*key, "_t"), key, most)
    lo = hi = F.lit(0)
    if borders is not None:
        rows = rows.join(F.broadcast(borders), key, "left")
        lo = F.when(F.col("_whole") & F.col("_borders").isNotNull(), F.size(F.filter("_borders", lambda b: b < F.col("_t")))).otherwise(F.lit(0))
        hi = F.when(F.col("_whole") & F.col("_borders").isNotNull(), F.size(F.filter("_borders", lambda b: b <= F.col("_t")))).otherwise(F.lit(0))
    # rows at a border's time are a stretch of their own; in the order of time the sums only grow
    rows = rows.withColumn("_lo", lo).withColumn("_hi", hi).withColumn("_stretch", F.col("_lo") + F.col("_hi"))
    drawn = F.when(F.col("_whole"), F.col("_hi") - F.col("_lo")).otherwise(F.lit(most))
    drawn = F.when(drawn > 1, F.pmod(F.monotonically_increasing_id(), drawn)).otherwise(F.lit(0))
    cut = ["_stretch"] if borders is not None else []
    group = [*key, "_whole", *cut, "_draw"]
    flat = rows.withColumn("_alone", F.col("_hi") > F.col("_lo")).withColumn("_draw", drawn)
    texts = [own[c] for c in dict.fromkeys(hashes)]
    plain = [*group, *(["_alone"] if cut else []), "_t", *([] if same_rows else ["_others", "_asks"]), *(n for n in own.values() if n not in texts)]
    dealt = flat.select(*plain, *(x for n in texts for x in _as_bytes(n)))
    dealt = dealt.repartition(partitions, *group) if partitions else dealt.repartition(*group)
    dealt = dealt.select(*plain, *(_as_text(n).alias(n) for n in texts))
    if same_rows:
        joined = _among_own(dealt, group, [(time, "_t"), *((n, names[c]) for n, c in right.items())], strict)
    else:
        # at one time, right rows come first, unless they must be before
        dealt = dealt.withColumn("_right", F.when(~F.col("_asks"), value))
        order = ["_t", F.desc("_asks") if strict else F.col("_asks"), "_right"]
        inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        joined = dealt.withColumn("_got", F.last("_right", ignorenulls=True).over(inside)).where("_asks")
    if borders is not None:
        last = flat.where("_whole AND _borders IS NOT NULL" + ("" if same_rows else " AND NOT _asks"))
        last = last.groupBy(*key, "_stretch").agg(F.max(value).alias("_right"))
        joined = joined.join(F.broadcast(_carried(last, borders, key)), [*key, "_stretch"], "left")
        carried = F.coalesce("_got", "_before") if strict else F.when(F.col("_alone"), F.col("_upto")).otherwise(F.coalesce("_got", "_before"))
        joined = joined.withColumn("_got", F.when(F.col("_whole"), carried))
    return joined.select(*(F.col(names[c]).alias(c) for c in left.columns), F.col("_got").alias(found))


def _as_bytes(name: str) -> list[Column]:
    """A text as bytes where it is lower-case hexadecimal digits, and as it is elsewhere."""
    octets = F.unhex(name)
    fits = F.lower(F.hex(octets)) == F.col(name)
    return [F.when(fits, octets).alias(f"{name}_octets"), F.when(fits, F.lit(None)).otherwise(F.col(name)).alias(f"{name}_text")]


def _as_text(name: str) -> Column:
    return F.coalesce(F.lower(F.hex(f"{name}_octets")), F.col(f"{name}_text"))


def _among_own(dealt: DataFrame, group: list[str], fields: list[tuple[str, str]], strict: bool) -> DataFrame:
    """``dealt`` with ``_got``: what each row finds among the rows of its group. ``fields``:
    names in it and the columns that they stand for, the time first."""
    if not strict:
        # a row's own time is not after it
        got = F.max(F.struct(*(F.col(c).alias(n) for n, c in fields))).over(Window.partitionBy(*group, "_t"))
    else:
        columns = list(dict.fromkeys(c for _, c in fields if c not in group))
        inside = Window.partitionBy(*group).orderBy(*columns)
        dealt = dealt.withColumns({f"_before{c}": F.lag(c).over(inside) for c in columns})
        before = F.struct(*(F.col(c if c in group else f"_before{c}").alias(n) for n, c in fields))
        earlier = F.col("_before_t").isNotNull()
        # the last row of the time before, which the first row of a time has before it
        dealt = dealt.withColumn("_step", F.when(~earlier | (F.col("_before_t") != F.col("_t")), F.struct(F.when(earlier, before).alias("value"))))
        got = F.last("_step", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))["value"]
    return dealt.withColumn("_got", F.when(F.col("_whole"), got))


def _borders(rows: DataFrame, key: list[str], most: int) -> DataFrame | None:
    """The keys of many rows, and ``_borders``: the times that cut a key's rows into even stretches.
    None if there is no such key."""
    ensure_checkpoint_dir(rows.sparkSession)
    sampled = rows if SAMPLED == 1 else rows.where(F.rand() < 1 / SAMPLED)
    sampled = sampled.checkpoint(eager=True)
    many = sampled.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") * SAMPLED > TOGETHER)
    many = many.withColumn("_stretches", F.least(F.lit(most), F.ceil(F.col("_n") * SAMPLED / TOGETHER).cast("int")))
    many = many.where("_stretches > 1").checkpoint(eager=True)
    if many.isEmpty():
        return None
    some = sampled.join(F.broadcast(many), key).where(F.rand() * F.col("_n") < _FOR_BORDER * F.col("_stretches"))
    times = some.groupBy(*key, "_stretches").agg(F.array_sort(F.collect_list("_t")).alias("_times"))
    each = F.transform(F.sequence(F.lit(1), F.col("_stretches") - 1), lambda i: F.get("_times", F.floor(i * F.size("_times") / F.col("_stretches")).cast("int")))
    return times.select(*key, each.alias("_borders")).checkpoint(eager=True)


def _carried(last: DataFrame, borders: DataFrame, key: list[str]) -> DataFrame:
    """For every stretch of the keys of ``borders`` the last right row before it, and before its end."""
    every = borders.select(*key, F.explode(F.sequence(F.lit(0), 2 * F.size("_borders"))).alias("_stretch"))
    # few stretches have a right row of their own: cut, so that the window is over a row for each
    every = every.join(last, [*key, "_stretch"], "left").checkpoint(eager=True)
    by_key = Window.partitionBy(*key).orderBy("_stretch")
    before = F.last("_right", ignorenulls=True).over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    upto = F.last("_right", ignorenulls=True).over(by_key.rowsBetween(Window.unboundedPreceding, 0))
    return every.select(*key, "_stretch", before.alias("_before"), upto.alias("_upto"))


def previous_versions(df: DataFrame) -> DataFrame:
    """``sha, repo, filename, file_sha, previous_sha, previous_file_sha, previous_date``: for
    each file of each commit its newest version in the repository before the commit
    (of equal dates the greatest file sha, then commit sha); null for the first."""
    files = df.select(
        F.col(SHA).alias("sha"),
        repo_name(URL).alias("repo"),
        F.col(_COMMITTED).alias("date"),
        F.inline(F.arrays_zip(F.col("files.filename").alias("filename"), F.col("files.sha").alias("file_sha"))),
    ).where("filename IS NOT NULL")
    versions = {"file_sha": "file_sha", "in_sha": "sha"}
    out = as_of_join(files, versions, ["repo", "filename"], "date", strict=True, hashes=["sha", "file_sha"])
    return out.select(
        "sha", "repo", "filename", "file_sha", F.col("found.in_sha").alias("previous_sha"),
        F.col("found.file_sha").alias("previous_file_sha"), F.col("found.date").alias("previous_date"),
    )
