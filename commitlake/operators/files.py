"""Files: extension histogram, newest version per repository, file history.

O2 file_extensions, O8 latest_files, O9 file_history / file_commits.

Each operator narrows the ``files`` array to the fields it needs in a
projection below the ``explode``: the array is rebuilt with ``arrays_zip``
from ``files.<field>`` extractions, which nested schema pruning can see
(a ``transform`` lambda hides them, and nested fields selected next to a
generator are read whole). So a Parquet scan reads only those nested fields
and large ones such as ``patch`` never enter a shuffle unless asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commitlake.functions import NO_REPO, file_extension, repo_name
from commitlake.operators._paths import COMMITTED, SHA, URL
from commitlake.schema import FILE_FIELDS

# Newest-version order: later commit date first, then the larger commit sha,
# file sha, status and additions (the reference leaves equal dates to chance).
_TIE_FIELDS = ("sha", "status", "additions")


def _files_with(fields: Sequence[str]):
    """``files`` narrowed to ``fields`` (in that order), field ``x`` named
    ``_f_x``; ``inline`` turns it into one row per file with those columns
    (no struct in between, which is cheaper than ``explode`` + field access)."""
    return F.arrays_zip(*[F.col(f"files.{name}").alias(f"_f_{name}") for name in fields])


def file_extensions(df: DataFrame) -> DataFrame:
    """O2: ``extension, n`` over every file of every commit.

    A NULL file name or a name without an extension counts as ``unknown``;
    case is kept. Commits without files add nothing.
    """
    names = df.select(F.explode(F.col("files.filename")).alias("filename"))
    return names.groupBy(file_extension("filename").alias("extension")).agg(
        F.count(F.lit(1)).alias("n")
    )


def latest_files(
    df: DataFrame, fields: Sequence[str] = FILE_FIELDS, keep_empty_repos: bool = True
) -> DataFrame:
    """The newest version of every named file of every repository.

    The key is the bare repository name (``norepo`` when the url has none),
    so same-named repositories of different owners are merged. Files without
    a name are dropped; a file whose newest status is ``removed`` stays.
    "Newest" is the file in the commit with the latest committer date, with
    ties broken by commit sha, file sha, status and additions (all
    descending).

    Output is flat: ``repo`` and the requested file ``fields``, one row per
    (repo, filename). With ``keep_empty_repos`` a repository that has no
    named file gets one row whose file fields are NULL (the reference gives
    it an empty list).

    Plan: ``row_number() = 1`` per (repo, filename). Spark plans this as a
    partial ``WindowGroupLimit`` before the shuffle, so each task sends at
    most one candidate per (repo, filename), however often a file changes.
    """
    fields = list(fields)
    unknown = [f for f in fields if f not in FILE_FIELDS]
    if unknown:
        raise ValueError(f"unknown file fields {unknown}")
    carried = list(dict.fromkeys([*fields, "filename", *_TIE_FIELDS]))
    # The repository name is taken once per commit, before the explode.
    narrowed = df.select(
        repo_name(URL, default=NO_REPO).alias("repo"),
        F.col(COMMITTED).alias("_date"),
        F.col(SHA).alias("_commit_sha"),
        _files_with(carried).alias("_files"),
    )
    files = narrowed.select("repo", "_date", "_commit_sha", F.inline("_files")).where(
        F.col("_f_filename").isNotNull()
    )
    # Every carried field but the patch text takes part in the order, so only
    # rows equal in all other output columns can tie. The patch is left out:
    # it would be compared and sorted with every candidate.
    rest = [name for name in carried if name not in (*_TIE_FIELDS, "filename", "patch")]
    # File name first: it varies far more than the repository, so the sort
    # prefix (first bytes of the first key) decides most comparisons.
    newest_first = Window.partitionBy("_f_filename", "repo").orderBy(
        F.desc("_date"),
        F.desc("_commit_sha"),
        *[F.desc(f"_f_{name}") for name in [*_TIE_FIELDS, *rest]],
    )
    latest = (
        files.withColumn("_rn", F.row_number().over(newest_first))
        .where(F.col("_rn") == 1)
        .select("repo", *[F.col(f"_f_{name}").alias(name) for name in fields])
    )
    if not keep_empty_repos:
        return latest
    # Built-ins stay inside generated code, unlike a lambda: the first name
    # settles most commits; array_max skips NULL names.
    names = F.col("files.filename")
    named = F.get(names, 0).isNotNull() | F.array_max(names).isNotNull()
    empty = (
        df.groupBy(repo_name(URL, default=NO_REPO).alias("repo"))
        .agg(F.max(named).alias("_named"))
        .where(~F.col("_named"))
        .select("repo")
    )
    return latest.unionByName(empty, allowMissingColumns=True)


def _repo_files(df: DataFrame, repository: str, fields: Sequence[str]) -> DataFrame:
    in_repo = repo_name(URL, default=NO_REPO) == repository
    if repository != NO_REPO:
        # A url whose repository is ``repository`` contains "/repository/";
        # the cheap substring test goes first and spares most rows the
        # name extraction.
        in_repo = F.col(URL).contains(f"/{repository}/") & in_repo
    return (
        df.where(in_repo)
        .select(F.col(SHA).alias("_commit_sha"), _files_with(fields).alias("_files"))
        .select("_commit_sha", F.inline("_files"))
        .where(F.col("_f_filename").isNotNull())
    )


def file_history(df: DataFrame, repository: str) -> DataFrame:
    """Per file of one repository (bare name), how often it changed and
    the summed stats: ``filename, n_commits, total, additions, deletions``.

    ``n_commits`` counts commit references, repeats included (a name twice in
    one commit counts twice); ``total`` is additions + deletions, not the
    file's ``changes``. The commit shas themselves are in ``file_commits``.
    """
    files = _repo_files(df, repository, ("filename", "additions", "deletions"))
    additions, deletions = F.col("_f_additions"), F.col("_f_deletions")
    return files.groupBy(F.col("_f_filename").alias("filename")).agg(
        F.count(F.lit(1)).alias("n_commits"),
        F.sum(additions + deletions).alias("total"),
        F.sum(additions).alias("additions"),
        F.sum(deletions).alias("deletions"),
    )


def file_commits(df: DataFrame, repository: str) -> DataFrame:
    """O9, commit list: ``filename, sha`` for every change of a named file of
    one repository, repeats kept. One row per list entry of the reference's
    per-file sha list, without gathering a list per file."""
    files = _repo_files(df, repository, ("filename",))
    return files.select(F.col("_f_filename").alias("filename"), F.col("_commit_sha").alias("sha"))
