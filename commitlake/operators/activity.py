"""Commit activity: counts, rankings, time series and per-commit timings.

O1 commit_count, O3 author_ranking, O12 commits_by_committer,
O13 weekly_commits, O14 commit_age, O15 commit_gaps, O16 weekday_commits,
O17 commit_delay.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlake.functions import commit_day, epoch_seconds, repo_name
from commitlake.operators._paths import AUTHOR, AUTHORED, COMMITTED, COMMITTER, SHA, URL
from commitlake.operators._rank import rank_by_count


def commit_count(df: DataFrame) -> DataFrame:
    """O1: number of commit rows (no de-duplication by sha), column ``n_commits``."""
    return df.agg(F.count(F.lit(1)).alias("n_commits"))


def author_ranking(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """O3: ``rank, author, n_commits`` for every author.

    Rank 0 has the most commits; equal counts are ordered by the lower-cased
    name, then by the name itself. Rows come out ordered by rank: they are
    range-partitioned and sorted on the rank order already, so no further
    sort is planned. See ``commitlake.operators._rank`` for how the rank is
    numbered without a single-task window. Eager: the ranked authors are
    checkpointed when this is called.
    """
    authors = df.groupBy(F.col(AUTHOR).alias("author")).agg(F.count(F.lit(1)).alias("n_commits"))
    ranked = rank_by_count(authors, "author", "n_commits", partitions=partitions)
    return ranked.select("rank", "author", "n_commits")


def commits_by_committer(
    df: DataFrame, committers: Iterable[str] | DataFrame, ordered: bool = True
) -> DataFrame:
    """``committer, sha, timestamp`` of the listed committers, by time.

    The name filter reaches a Parquet scan as a pushed ``In`` filter on the
    nested field. Equal timestamps are ordered by sha. ``ordered=False``
    leaves out the global sort (a sampling job and a range shuffle) when the
    caller does not need the order. A long list of names can be given as a
    DataFrame (its first column), which is joined instead.
    """
    if isinstance(committers, DataFrame):
        names = committers.select(F.col(committers.columns[0]).alias("_name"))
        rows = df.join(names, F.col(COMMITTER) == F.col("_name"), "left_semi")
    else:
        rows = df.where(F.col(COMMITTER).isin(list(committers)))
    rows = rows.select(
        F.col(COMMITTER).alias("committer"),
        F.col(SHA).alias("sha"),
        F.col(COMMITTED).alias("timestamp"),
    )
    return _ordered(rows, "timestamp", "sha") if ordered else rows


def weekly_commits(df: DataFrame, iso_year: bool = False) -> DataFrame:
    """Commits per ``repository, week, year``.

    ``week`` is the ISO week and ``year`` the calendar year of the commit
    day, as in the reference, so 2018-12-31 counts as week 1 of 2018. With
    ``iso_year=True`` the year is the ISO week-numbering year instead
    (2018-12-31 is week 1 of 2019). An url without a repository gives
    ``repository = ''``.
    """
    day = commit_day(COMMITTED)
    year = F.extract(F.lit("YEAROFWEEK"), day) if iso_year else F.year(day)
    return df.groupBy(
        repo_name(URL, default="").alias("repository"),
        F.weekofyear(day).alias("week"),
        year.alias("year"),
    ).agg(F.count(F.lit(1)).alias("count"))


def _epoch(snapshot) -> int:
    if isinstance(snapshot, dt.datetime):
        if snapshot.tzinfo is None:
            snapshot = snapshot.replace(tzinfo=dt.timezone.utc)
        return int(snapshot.timestamp() // 1)
    return int(snapshot)


def commit_age(df: DataFrame, snapshot) -> DataFrame:
    """All columns plus ``age``, seconds from the commit to ``snapshot``.

    ``snapshot`` is epoch seconds or a ``datetime`` (naive means UTC). The
    age is negative for commits after the snapshot.
    """
    return df.withColumn("age", F.lit(_epoch(snapshot)) - epoch_seconds(COMMITTED))


def commit_gaps(
    df: DataFrame,
    committer: str | None = None,
    ordered: bool = True,
    columns: Sequence[str | Column] | None = None,
) -> DataFrame:
    """All columns plus ``time_diff``, calendar days since the
    committer's previous commit (0 for the first one), in time order. With
    ``columns`` only these (names or expressions over ``df``) are carried, so a
    caller that needs few fields reads and shuffles no others.

    With ``committer`` only that committer's rows are returned, as in the
    reference; without it every committer is handled at once. Commits are
    ordered by (date, sha, url); ``time_diff`` depends on dates only, so the
    tie-break does not change any value. A commit without a date gets 0.

    A committer, or one committer's day, may hold a large share of all rows,
    so no window runs over the commit rows. A day-difference is non-zero only
    at the first commit of a committer's calendar day:

    * the keys (committer, date, sha, url) are counted, then reduced to the
      smallest of each (committer, day), both with partial aggregation;
      ``lag`` over these days (partitioned by committer: at most one row per
      calendar day) gives the previous active day;
    * the commit rows are joined to the days on (committer, day); adaptive
      execution splits a skewed join key. The row with the smallest key takes
      the gap; it is an expression over the joined row;
    * where that key has copies, exactly one of them takes the gap. Only such
      rows pass through a second join and two small windows: first within
      (committer, day, task), then over one row of each task. Without copies
      that branch is empty, and adaptive execution drops its join.

    Other columns than the keys are only carried along, so columns of any
    type are allowed.

    ``ordered=False`` leaves out the final global sort (a sampling job and a
    range shuffle of all rows) when the caller does not need the order; the
    values are the same.
    """
    if committer is not None:
        df = df.where(F.col(COMMITTER) == committer)
    key = F.struct(F.col(COMMITTED).alias("at"), F.col(SHA).alias("sha"), F.col(URL).alias("url"))
    who_day = F.struct(F.col(COMMITTER).alias("who"), commit_day(COMMITTED).alias("day"))
    rows = df.select(*(columns or ["*"]), who_day.alias("_key"), key.alias("_own"))
    out = [F.col(f"`{c}`") for c in rows.columns[:-2]]

    counted = rows.groupBy("_key", "_own").agg(F.count(F.lit(1)).alias("n"))
    by_committer = Window.partitionBy("_key.who").orderBy("_key.day")
    days = (
        counted.groupBy("_key")
        .agg(F.min(F.struct("_own", "n")).alias("_first"))
        .withColumn("_prev_day", F.lag("_key.day").over(by_committer))
    )
    is_first = F.col("_own.at").isNotNull() & (F.col("_own") == F.col("_first._own"))
    copied = F.col("_first.n") > 1
    gap = F.coalesce(F.datediff(F.col("_key.day"), F.col("_prev_day")), F.lit(0))

    joined = rows.join(days, "_key")
    plain = joined.where(~(is_first & copied)).withColumn("time_diff", F.when(is_first, gap).otherwise(F.lit(0)))
    # One of the copies of a first key: the first of its task's copies, then
    # of the tasks'. Which one is chosen makes no difference but for columns
    # in which rows with equal keys differ.
    copies = rows.join(days.where(copied & F.col("_first._own.at").isNotNull()), "_key").where(is_first)
    in_task = Window.partitionBy("_key", "_task").orderBy("_own")
    of_tasks = Window.partitionBy("_key", F.when(F.col("_rn") == 1, F.lit(-1)).otherwise(F.col("_task"))).orderBy("_task")
    copies = (
        copies.withColumn("_task", F.spark_partition_id())
        .withColumn("_rn", F.row_number().over(in_task))
        .withColumn("_takes", (F.col("_rn") == 1) & (F.row_number().over(of_tasks) == 1))
        .withColumn("time_diff", F.when(F.col("_takes"), gap).otherwise(F.lit(0)))
    )
    result = plain.select(*out, "time_diff", "_own").union(copies.select(*out, "time_diff", "_own"))
    if ordered:
        result = _ordered(result, "_own.at", "_own.sha", "_own.url")
    return result.drop("_own")


def _ordered(df: DataFrame, *keys: str) -> DataFrame:
    """Global sort; rows with equal keys may be split over tasks, as a row
    number (of no meaning) ends the sort key."""
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    return numbered.orderBy(*(F.col(k) for k in keys), "_row").drop("_row")


def weekday_commits(df: DataFrame) -> DataFrame:
    """``day`` (1 = Sunday ... 7 = Saturday) and ``commits_per_day``.
    Weekdays without commits are absent."""
    return df.groupBy(F.dayofweek(commit_day(COMMITTED)).alias("day")).agg(
        F.count(F.lit(1)).alias("commits_per_day")
    )


def commit_delay(df: DataFrame) -> DataFrame:
    """All columns plus ``commit_time_diff``, seconds from authoring to
    committing."""
    return df.withColumn("commit_time_diff", epoch_seconds(COMMITTED) - epoch_seconds(AUTHORED))
