"""The committer -> repository graph as vertex and edge tables.

Vertices are the distinct committer names (type ``developer``) and the
distinct ``owner/repo`` names (type ``repository``, ``norepo`` for an url
without one); the id is ``vertex_id(name)``, a pure function of the name, so
edges need no lookup table: both ends are computed by the same expression.
Edges go one way, committer to repository, without duplicates.

A name used both by a committer and by a repository gives two vertex rows
with one id (one per type). Rows with a NULL committer give no vertex and no
edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlake.fixed import DEVELOPER, NO_REPO, REPOSITORY
from commitlake.functions import repo_full, vertex_id
from commitlake.operators._paths import COMMITTER, URL


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(
        F.col(COMMITTER).alias("committer"), repo_full(URL, default=NO_REPO).alias("repo")
    )


def graph_vertices(df: DataFrame) -> DataFrame:
    """``id bigint, name string, type string``; one row per (name, type)."""
    typed = F.array(
        F.struct(F.col("committer").alias("name"), F.lit(DEVELOPER).alias("type")),
        F.struct(F.col("repo").alias("name"), F.lit(REPOSITORY).alias("type")),
    )
    names = _pairs(df).select(F.inline(typed)).where(F.col("name").isNotNull()).distinct()
    # Ids are computed after de-duplication: two MD5s per distinct name, not
    # per commit.
    return names.select(vertex_id("name").alias("id"), "name", "type")


def graph_edges(df: DataFrame) -> DataFrame:
    """``src bigint, dst bigint``: one edge per committer-repository pair."""
    pairs = _pairs(df).where(F.col("committer").isNotNull() & F.col("repo").isNotNull()).distinct()
    return pairs.select(vertex_id("committer").alias("src"), vertex_id("repo").alias("dst")).distinct()


def commit_graph(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables: ``(vertices, edges)``."""
    return graph_vertices(df), graph_edges(df)
