"""People: per-user totals, owners versus authors, reverts, committers.

O4 user_stats, O5 exclusive_people, O6 revert_streaks, O7 repo_committers,
O10 committer_repo_stats.

Every result here is an aggregate with partial (map-side) aggregation, so a
name that owns a large share of the rows costs one partial row per task in
the shuffle, not one row per commit.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlake.functions import NO_REPO, repo_name, repo_owner_and_name, stat_or_zero, url_piece_owner
from commitlake.fixed import REVERT_WORD
from commitlake.operators._paths import AUTHOR, COMMITTER, MESSAGE, URL

STAT_FIELDS = ("total", "additions", "deletions")


def _stat_sums() -> list:
    return [F.sum(stat_or_zero(f)).alias(f) for f in STAT_FIELDS]


def user_stats(
    df: DataFrame, users: Iterable[str] | DataFrame, role: str = "author"
) -> DataFrame:
    """Summed ``total, additions, deletions`` per listed user.

    The user is the commit **author** by default, as the reference computes
    it (its description says committer: ``role="committer"`` gives that).
    The name column is called ``author`` either way. Missing stats count as
    zeros; a listed name without commits does not appear. ``users`` is a
    list of names, or a one-column DataFrame of names for a long list (then
    a left-semi join keeps the matching commits).
    """
    if role not in ("author", "committer"):
        raise ValueError(f"role must be 'author' or 'committer', not {role!r}")
    person = F.col(AUTHOR if role == "author" else COMMITTER)
    if isinstance(users, DataFrame):
        names = users.select(users.columns[0]).withColumnRenamed(users.columns[0], "_name")
        kept = df.join(names, person == F.col("_name"), "left_semi")
    else:
        kept = df.where(person.isin(list(users)))
    return kept.groupBy(person.alias("author")).agg(*_stat_sums())


def exclusive_people(df: DataFrame) -> DataFrame:
    """Names that are only commit authors or only repository owners.

    The owner is the fifth ``/``-piece of the url. One pass: every commit
    gives (author, 1) and (owner, 2); a name whose OR of roles is not 3 has
    one role only. Same result as two set differences and a union, with one
    shuffle instead of four.
    """
    roles = F.array(
        F.struct(F.col(AUTHOR).alias("name"), F.lit(1).alias("role")),
        F.struct(url_piece_owner(URL).alias("name"), F.lit(2).alias("role")),
    )
    rows = df.select(F.inline(roles))
    # A url too short to hold an owner gives no owner.
    rows = rows.where(~((F.col("role") == 2) & F.col("name").isNull()))
    return (
        rows.groupBy("name")
        .agg(F.bit_or("role").alias("_roles"))
        .where(F.col("_roles") != 3)
        .select("name")
    )


def revert_streaks(df: DataFrame) -> DataFrame:
    """Per author, the longest revert streak and how often it occurs.

    Only messages starting with ``Revert`` count (case-sensitive); the
    streak is the number of ``Revert`` occurrences anywhere in the message
    (so ``Reverted`` counts too). Columns ``author, streak, n``.
    """
    streaks = df.where(F.col(MESSAGE).startswith(REVERT_WORD)).select(
        F.col(AUTHOR).alias("author"),
        F.regexp_count(F.col(MESSAGE), F.lit(REVERT_WORD)).alias("streak"),
    )
    per_streak = streaks.groupBy("author", "streak").agg(F.count(F.lit(1)).alias("n"))
    # Input is one row per (author, streak length): small.
    best = per_streak.groupBy("author").agg(F.max(F.struct("streak", "n")).alias("_best"))
    return best.select("author", "_best.streak", "_best.n")


def repo_committers(df: DataFrame) -> DataFrame:
    """Commits per repository and its distinct committers.

    The key is (owner, repository) from the url (``norepo`` for both when
    it does not match). Output is flat, one row per distinct committer:
    ``owner, repo, n_commits, committer, committer_commits``, where
    ``n_commits`` is the repository's total and ``committer_commits`` that
    committer's share of it. A per-repository list would put all committers
    of one repository into one row; ``collect_set`` over this frame gives it
    where repositories are known to be small.
    """
    owner, repo = repo_owner_and_name(URL, default=NO_REPO)
    keyed = df.select(owner.alias("owner"), repo.alias("repo"), F.col(COMMITTER).alias("committer"))
    # Partial aggregation first: the shuffle carries one row per distinct
    # (owner, repo, committer) and task, however many commits a repository has.
    triples = keyed.groupBy("owner", "repo", "committer").agg(F.count(F.lit(1)).alias("_n"))
    # The repository total is summed from those rows (one per repository
    # after partial aggregation) and joined back. A join, not a window over
    # all committers of a repository: adaptive execution can split the join
    # when one repository has a large share of all committers.
    totals = triples.groupBy("owner", "repo").agg(F.sum("_n").alias("n_commits"))
    # Both join sides use the per-committer count, so they are the same
    # aggregate and adaptive execution runs its scan and shuffle once.
    return triples.join(totals, ["owner", "repo"]).select(
        "owner", "repo", "n_commits", "committer", F.col("_n").alias("committer_commits")
    )


def committer_repo_stats(df: DataFrame) -> DataFrame:
    """Summed stats per (committer, bare repository name).

    Missing stats count as zeros, so a pair whose commits all lack stats has
    ``0, 0, 0``. Columns ``committer, repo, total, additions, deletions``.
    """
    return df.groupBy(
        F.col(COMMITTER).alias("committer"), repo_name(URL, default=NO_REPO).alias("repo")
    ).agg(*_stat_sums())
