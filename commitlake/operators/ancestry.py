"""Commit ancestry over the graph of parents: generation numbers and nearest common
ancestors.

Commits are told by their sha; copies of a commit are one, and a parent that is not
in the table is none. History is a directed graph without circles in which a commit may
have several parents and a parent any number of children.

Generation: 1 for a commit without parents, else one more than the largest of its
parents'. All commits without parents stand for one root, and an edge carries the
length of a path. In each round every edge to a commit that has just one edge left is led on
to where that one leads (paths of 2, 4, 8, ... commits), and of edges between the same two commits
only the longest stays, which leaves more commits with one edge. Branches and
merges of a history fold up in this way, so that rounds are about logarithmic in its length;
edges never get more. Knots that do not fold (merges across one another) are
resolved from the root on, a level in each round.

Nearest common ancestor of a pair: of the commits that both descend from (a commit
counts as its own ancestor) the one of the largest generation (ties: smallest
sha). It is an end of a pair or has two children, so all other commits with one
parent are skipped first, by doubling again. Then all pairs search together: each
round goes on, from the commits reached, to their parents, and only from those whose
generation is above that of the pair's best common one so far. Generations fall along a
search: a pair that goes on nowhere leaves it, and so do commits of the others that can
neither be reached again nor be better than the best.

All of it runs on numbers of the commits, in the order of their shas; shas come back
at the end.

Hot keys: a parent of very many commits is one row on the smaller side of each
join, and adaptive execution splits the other; sums and maxima are partial. Each round is
checkpointed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commitlake.operators._paths import SHA
from commitlake.session import ensure_checkpoint_dir


def _cut(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def numbered(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id, sha`` of every commit, ids in the order of the shas, and ``child, parent`` (ids)
    of every parent in the table."""
    shas = df.select(F.col(SHA).alias("sha")).where("sha IS NOT NULL").distinct()
    names = shas.repartitionByRange("sha").sortWithinPartitions("sha").withColumn("id", F.monotonically_increasing_id())
    names = _cut(names)
    edges = df.where(F.col(SHA).isNotNull()).select(F.col(SHA).alias("c"), F.explode("parents.sha").alias("p"))
    edges = edges.where("p IS NOT NULL AND p <> c")
    edges = edges.join(names.select(F.col("sha").alias("p"), F.col("id").alias("parent")), "p")
    edges = edges.select("c", "parent").join(names.select(F.col("sha").alias("c"), F.col("id").alias("child")), "c")
    return names, _cut(edges.select("child", "parent").distinct())


def generations(df: DataFrame, rounds: int = 1000) -> DataFrame:
    """``sha, generation`` of every commit. Null where ``rounds`` do not do, and for
    commits that descend from a circle (which no history has)."""
    names, edges = numbered(df)
    return names.join(_generations(names, edges, rounds), "id").select("sha", "generation")


def _generations(names: DataFrame, edges: DataFrame, rounds: int = 1000) -> DataFrame:
    """``id, generation``."""
    # a null parent is the root; a commit whose only edge goes there is settled
    ids = names.select("id")
    rest = ids.join(edges.select(F.col("child").alias("id")).distinct(), "id", "left_anti")
    rest = rest.select(F.col("id").alias("child"), F.lit(None).cast("long").alias("parent"))
    paths = _cut(edges.select("child", "parent").unionByName(rest).withColumn("far", F.lit(1).cast("long")))
    before = None
    for _ in range(rounds):
        open_ = paths.where("parent IS NOT NULL").count()
        # each round settles a commit whose parents are settled; if it does not, there is a circle
        if not open_ or open_ == before:
            break
        before = open_
        alone = paths.groupBy("child").agg(F.count(F.lit(1)).alias("n"), F.max("parent").alias("to"), F.max("far").alias("more"))
        alone = alone.where("n = 1").select(F.col("child").alias("parent"), "to", "more")
        led = paths.where("parent IS NOT NULL").join(alone, "parent", "left")
        hit = F.col("more").isNotNull()
        led = led.select(
            "child", F.when(hit, F.col("to")).otherwise(F.col("parent")).alias("parent"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far")
        )
        led = led.unionByName(paths.where("parent IS NULL"))
        paths = _cut(led.groupBy("child", "parent").agg(F.max("far").alias("far")))
    known = paths.groupBy("child").agg(F.count("parent").alias("open"), F.max("far").alias("generation")).where("open = 0")
    return ids.join(known.select(F.col("child").alias("id"), "generation"), "id", "left")


def common_ancestors(df: DataFrame, pairs: DataFrame, rounds: int = 100_000) -> DataFrame:
    """``a, b, ancestor, generation`` of each distinct pair ``a, b`` of ``pairs``
    (shas): the nearest common ancestor, null where there is none, or where a or b is
    not in the table."""
    names, edges = numbered(df)
    asked = _cut(pairs.select("a", "b").distinct().withColumn("pair", F.monotonically_increasing_id()))
    ends = asked.join(names.select(F.col("sha").alias("a"), F.col("id").alias("ia")), "a")
    ends = ends.join(names.select(F.col("sha").alias("b"), F.col("id").alias("ib")), "b")
    found = _nearest(names, edges, _cut(ends.select("pair", F.col("ia").alias("a"), F.col("ib").alias("b"))), rounds)
    found = found.join(names.withColumnRenamed("sha", "ancestor"), "id").select("pair", "ancestor", "generation")
    return asked.join(found, "pair", "left").select("a", "b", "ancestor", "generation")


#: Lists of finished pairs that are held at most.
_LISTS = 16


def _nearest(names: DataFrame, edges: DataFrame, asked: DataFrame, rounds: int = 100_000) -> DataFrame:
    """``pair, id, generation``: the nearest common ancestor of each ``pair, a, b`` (ids)
    that has one."""
    gens = _cut(_generations(names, edges))
    keys = asked.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    hops = _cut(_skip(edges, keys).join(gens.withColumnRenamed("id", "parent"), "parent"))
    ends = asked.select("pair", F.inline(F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("side")), F.struct(F.col("b").alias("id"), F.lit(2).alias("side")))))
    # commits reached, from which side (3: from both), and whether their parents were
    seen = _met(ends.join(gens, "id").withColumn("done", F.lit(0)))
    of_pair, found = W.partitionBy("pair"), []
    go = F.expr("coalesce(side < 3 AND done < side AND (best IS NULL OR generation > best), false)")
    # the largest generation that goes on; above all where it is not known
    front = F.max(F.when(F.col("go"), F.coalesce("generation", F.lit((1 << 63) - 1)))).over(of_pair)
    for last in range(rounds + 1):
        seen = seen.withColumn("best", F.max(F.when(F.col("side") == 3, F.col("generation"))).over(of_pair))
        seen = seen.withColumn("go", go).withColumn("front", front)
        seen = _cut(seen.where("front IS NULL AND side = 3 OR go OR generation IS NULL OR generation >= best OR best IS NULL AND generation < front"))
        ended = seen.where("side = 3" if last == rounds else "side = 3 AND front IS NULL")
        ended = ended.groupBy("pair").agg(F.min(F.struct((-F.col("generation")).alias("g"), "id")).alias("x"))
        found.append(_cut(ended.select("pair", "x.id", (-F.col("x.g")).alias("generation"))))
        if len(found) == _LISTS:
            found = [_cut(reduce(DataFrame.unionByName, found))]
        open_ = seen.where("front IS NOT NULL")
        if last == rounds or open_.isEmpty():
            break
        reached = open_.where("go").select("pair", F.col("id").alias("child"), "side").join(hops, "child")
        reached = reached.select("pair", F.col("parent").alias("id"), "generation", "side", F.lit(0).alias("done"))
        old = open_.select("pair", "id", "generation", "side", F.when(F.col("go"), F.col("side")).otherwise(F.col("done")).alias("done"))
        seen = _met(old.unionByName(reached))
    return reduce(DataFrame.unionByName, found)


def _met(rows: DataFrame) -> DataFrame:
    """A row for each commit of a pair, dealt by the pair."""
    rows = rows.select("pair", "id", "generation", "side", "done").repartition("pair")
    return rows.groupBy("pair", "id", "generation").agg(F.bit_or("side").alias("side"), F.max("done").alias("done"))


def _skip(edges: DataFrame, keys: DataFrame) -> DataFrame:
    """``child, parent``: edges led past the commits that have one parent and one child at
    most and are no key."""
    children = edges.groupBy("parent").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("parent").alias("id"))
    skipped = edges.groupBy("child").agg(F.count(F.lit(1)).alias("n"), F.max("parent").alias("to")).where("n = 1")
    skipped = skipped.select(F.col("child").alias("id"), "to").join(children.unionByName(keys).distinct(), "id", "left_anti")
    on = _cut(skipped)
    while True:  # where each skipped commit leads, past others
        further = on.select(F.col("id").alias("to"), F.col("to").alias("next"))
        new = _cut(on.join(further, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")))
        on = new.select("id", "to")
        if new.where("moved").isEmpty():
            break
    lead = on.select(F.col("id").alias("parent"), F.col("to"))
    left = edges.join(on.withColumnRenamed("id", "child"), "child", "left_anti")
    return left.join(lead, "parent", "left").select("child", F.coalesce("to", "parent").alias("parent")).distinct()


def merge_bases(df: DataFrame) -> DataFrame:
    """``sha, parent_a, parent_b, base, generation``: the nearest common ancestor of each
    two parents (in the table) of every commit that has several."""
    names, edges = numbered(df)
    ordered = edges.groupBy("child").agg(F.array_sort(F.collect_set("parent")).alias("p")).where(F.size("p") > 1)
    two = ordered.select("child", F.posexplode("p").alias("i", "a"), "p")
    two = two.select("child", "a", F.explode(F.slice("p", F.col("i") + 2, F.size("p"))).alias("b")).where("b IS NOT NULL")
    two = _cut(two)
    asked = _cut(two.select("a", "b").distinct().withColumn("pair", F.monotonically_increasing_id()))
    bases = asked.join(_nearest(names, edges, asked), "pair", "left").select("a", "b", "id", "generation")
    out = two.join(bases, ["a", "b"])
    for own, sha, how in (("child", "child_sha", "inner"), ("a", "parent_a", "inner"), ("b", "parent_b", "inner"), ("id", "base", "left")):
        out = out.join(names.select(F.col("id").alias(own), F.col("sha").alias(sha)), own, how)
    return out.select(F.col("child_sha").alias("sha"), "parent_a", "parent_b", "base", "generation")
