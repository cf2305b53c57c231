"""Rank of the vertices of the committer -> repository graph, by iterated joins.

The rank of a vertex is its share of a walk that follows a random edge with
probability ``damping`` and otherwise goes to a random vertex; a vertex without
edges out sends its share to all. Ranks are relative to the mean: they add up to
the number of vertices. They are whole numbers of billionths, and every share is
rounded down, so that sums do not depend on the order in which tasks add them.

Plan of a round: one row for each vertex that has edges out (its rank, divided by their
number) meets the edges, shares are added up by their end with a partial sum
in the tasks, and the sums meet the vertices. A vertex with very many edges out
is split: its edges are dealt into parts of about ``HUB`` and its row is copied
once for each part, so that no task holds all of them. A vertex with very many edges
in costs one row for each task. Each round's ranks are checkpointed, so that
lineage does not grow; what the next round needs from all vertices (the sum over
those without edges out, and the change) is one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlake.session import ensure_checkpoint_dir

#: Billionths of the mean rank.
UNIT = 1_000_000_000
DAMPING_PERCENT = 85
#: Edges out of one vertex that are dealt together.
HUB = 10_000


def _cut(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def graph_rank(
    vertices: DataFrame,
    edges: DataFrame,
    rounds: int = 20,
    tolerance: float = 1e-4,
    damping_percent: int = DAMPING_PERCENT,
    both_ways: bool = False,
    hub: int = HUB,
) -> DataFrame:
    """``id, rank, rounds``: the rank of each vertex id, and the rounds it took.

    ``vertices``: ``id`` (repeated ids are one vertex); ``edges``: ``src, dst``
    (repeated edges are one; edges from or to an id that is no vertex, or null,
    count for nothing). It stops after ``rounds``, or as soon as ranks have
    changed by less than ``tolerance`` on average. ``both_ways`` follows each edge in
    either direction. Without vertices there are no rows.
    """
    ids = _cut(_cut(vertices.select("id")).where("id IS NOT NULL").distinct())
    n = ids.count()
    if not n:
        return ids.select("id", F.lit(0.0).alias("rank"), F.lit(0).alias("rounds"))
    # cut first: ends may be long expressions, and what follows asks for them often
    links = _cut(edges.select("src", "dst"))
    if both_ways:
        links = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    links = links.where("src IS NOT NULL AND dst IS NOT NULL").distinct()
    links = links.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
    links = links.join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    links = _cut(links)
    out = links.groupBy("src").agg(F.count(F.lit(1)).alias("out"))
    out = _cut(out.withColumn("parts", F.ceil(F.col("out") / hub)))
    split = out.where("parts > 1").select("src", "parts")
    part = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("parts")), F.lit(0)).alias("part")
    links = _cut(links.join(split, "src", "left").select("src", part, "dst"))

    ranks = _cut(
        ids.join(out.withColumnRenamed("src", "id"), "id", "left").select("id", "out", "parts", F.lit(UNIT).cast("long").alias("rank"))
    )
    done, lost = 0, n * UNIT if out.isEmpty() else ranks.where("out IS NULL").count() * UNIT
    while done < rounds:
        every = UNIT * (100 - damping_percent) // 100 + damping_percent * lost // (100 * n)
        share = F.expr(f"rank * {damping_percent} div (100 * out)").alias("share")
        sent = ranks.where("out IS NOT NULL").select(F.col("id").alias("src"), "parts", share)
        sent = sent.select("src", "share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        got = links.join(sent, ["src", "part"]).groupBy(F.col("dst").alias("id")).agg(F.sum("share").alias("got"))
        rank = (F.coalesce("got", F.lit(0)) + F.lit(every)).cast("long")
        ranks = _cut(ranks.join(got, "id", "left").select("id", "out", "parts", rank.alias("rank"), F.abs(rank - F.col("rank")).alias("change")))
        done += 1
        row = ranks.agg(
            F.sum("change").alias("change"), F.sum(F.when(F.col("out").isNull(), F.col("rank")).otherwise(0)).alias("lost")
        ).first()
        lost = row.lost
        if row.change < tolerance * UNIT * n:
            break
    return ranks.select("id", (F.col("rank") / UNIT).alias("rank"), F.lit(done).alias("rounds"))
