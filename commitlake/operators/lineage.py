"""Commit lineage: branch points (O18) and fork points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlake.functions import repo_full
from commitlake.operators._paths import SHA, URL


def branch_points(df: DataFrame) -> DataFrame:
    """``sha, times_parent`` for commits that are a parent at least twice.

    Only shas present in the table count. The reference joins every
    (exploded) parent reference with the commit rows and counts per parent,
    so a sha stored k times multiplies its count by k. The same number is
    computed here without joining raw rows: references are counted per
    parent sha and rows per sha first (both partial aggregations, so a parent
    referenced by a large share of all commits costs one row per task), then
    the two counts are joined on sha and multiplied. Both aggregates are
    hash-partitioned on sha, so the join adds no shuffle, and no key repeats
    on either side of it.
    """
    references = (
        df.select(F.explode(F.col("parents.sha")).alias("sha"))
        .groupBy("sha")
        .agg(F.count(F.lit(1)).alias("_refs"))
    )
    present = df.groupBy(F.col(SHA).alias("sha")).agg(F.count(F.lit(1)).alias("_rows"))
    return (
        references.join(present, "sha")
        .select("sha", (F.col("_refs") * F.col("_rows")).alias("times_parent"))
        .where(F.col("times_parent") >= 2)
    )


def fork_points(df: DataFrame) -> DataFrame:
    """Child commits whose parent commit is in another repository.

    ``parent_repo_name, child_repo_name, parent_sha, child_sha, n``, names
    as ``owner/repo`` ('' for an url without one). The reference joins every
    (exploded) parent reference with every commit row of the parent sha, so
    a parent stored k times in one repository gives k equal rows. Here the
    parent side is first reduced to one row per (sha, repository) with its
    number of copies ``n`` (partial aggregation, so a sha copied into a large
    share of all rows costs one row per task), and each output row stands
    for ``n`` equal rows of the reference's result.

    Plan: an equi-join on the parent sha with the ``<>`` test as a join
    condition. A parent referenced by a large share of all commits makes one
    join partition large; adaptive execution's skew-join handling splits it
    (``spark.sql.adaptive.skewJoin.enabled``).
    """
    # A row without url has no repository name and can never pass the '<>'
    # test: it is dropped at the scan. The name is then never NULL, so Spark
    # infers no not-NULL filter that would compute it a second time.
    base = df.where(F.col(URL).isNotNull()).select(
        F.coalesce(repo_full(URL, default=""), F.lit("")).alias("_repo"),
        F.col(SHA).alias("_sha"),
        "parents",
    )
    children = base.select(
        F.col("_repo").alias("child_repo_name"),
        F.col("_sha").alias("child_sha"),
        F.explode(F.col("parents.sha")).alias("parent_sha"),
    )
    parents = base.groupBy(
        F.col("_sha").alias("parent_sha"), F.col("_repo").alias("parent_repo_name")
    ).agg(F.count(F.lit(1)).alias("n"))
    joined = children.join(
        parents,
        (children.parent_sha == parents.parent_sha)
        & (children.child_repo_name != parents.parent_repo_name),
        "inner",
    )
    return joined.select("parent_repo_name", "child_repo_name", parents.parent_sha, "child_sha", "n")
