"""Generations, common ancestors and graph ranks against direct computations."""

from __future__ import annotations

import random

import pytest
from conftest import commit
from pyspark.sql import functions as F

from commitlake import operators as ops
from commitlake.operators.ranking import UNIT


def history(r: random.Random, n: int) -> dict[str, list[str]]:
    """Chains, branches, merges within a window, absent parents, several roots."""
    out: dict[str, list[str]] = {}
    for i in range(n):
        k = r.choice([0, 1, 1, 1, 1, 2, 2, 3]) if i else 0
        out[f"c{i:04d}"] = sorted({f"c{max(0, i - r.randint(1, 6)):04d}" for _ in range(k)} - {f"c{i:04d}"}) + (["gone"] if r.random() < 0.1 else [])
    return out


def brute_generations(parents):
    out = {}
    for sha in sorted(parents):
        out[sha] = 1 + max((out[p] for p in parents[sha] if p in parents), default=0)
    return out


def ancestors(parents, sha):
    seen, todo = set(), [sha] if sha in parents else []
    while todo:
        x = todo.pop()
        if x not in seen:
            seen.add(x)
            todo += [p for p in parents[x] if p in parents]
    return seen


def nearest(parents, gens, a, b):
    both = ancestors(parents, a) & ancestors(parents, b)
    return min(both, key=lambda x: (-gens[x], x), default=None)


def table(commits, parents, copies=()):
    rows = [commit(sha=s, parents=p) for s, p in parents.items()]
    return commits(rows + [commit(sha=s, parents=parents[s]) for s in copies]).repartition(4)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_histories(commits, spark, seed):
    r = random.Random(seed)
    parents = history(r, 120)
    df, gens = table(commits, parents, copies=["c0005", "c0005", "c0050"]), brute_generations(parents)
    assert {x.sha: x.generation for x in ops.generations(df).collect()} == gens
    shas = [*parents, "gone", "never"]
    pairs = {(r.choice(shas), r.choice(shas)) for _ in range(150)} | {("c0007", "c0007")}
    got = ops.common_ancestors(df, spark.createDataFrame(sorted(pairs), "a string, b string"))
    want = {(a, b): nearest(parents, gens, a, b) for a, b in pairs}
    rows = got.collect()
    assert {(x.a, x.b): x.ancestor for x in rows} == want and len(rows) == len(pairs)
    assert all(x.generation == (gens[x.ancestor] if x.ancestor else None) for x in rows)


def test_merge_bases(commits):
    parents = {"a": [], "b": ["a"], "c": ["a"], "m": ["b", "c"], "x": [], "n": ["m", "x"], "o": ["b", "c", "x"]}
    got = {(r.sha, r.parent_a, r.parent_b): (r.base, r.generation) for r in ops.merge_bases(table(commits, parents)).collect()}
    assert got == {
        ("m", "b", "c"): ("a", 1), ("n", "m", "x"): (None, None),
        ("o", "b", "c"): ("a", 1), ("o", "b", "x"): (None, None), ("o", "c", "x"): (None, None),
    }


def test_empty_null_and_circular_tables(commits):
    assert ops.generations(commits([])).count() == 0 and ops.merge_bases(commits([])).count() == 0
    rows = [commit(sha=None, parents=["a"]), commit(sha="a", parents=[None, "a"]), commit(sha="b", parents=["c"]), commit(sha="c", parents=["b"])]
    rows.append(commit(sha="d", parents=["c", "a"]))
    assert {r.sha: r.generation for r in ops.generations(commits(rows)).collect()} == {"a": 1, "b": None, "c": None, "d": None}


def test_a_chain_of_100000_commits_in_few_rounds(spark, commits, monkeypatch):
    """With a pull request merged at every fifth commit: 120,000 commits."""
    n = 100_000
    i = F.col("id")
    main = spark.range(n).select(
        F.concat(F.lit("m"), i).alias("sha"),
        F.when(i == 0, F.array().cast("array<string>"))
        .when(i % 5 == 0, F.array(F.concat(F.lit("m"), i - 1), F.concat(F.lit("p"), i)))
        .otherwise(F.array(F.concat(F.lit("m"), i - 1))).alias("p"),
    )
    side = spark.range(5, n, 5).select(F.concat(F.lit("p"), i).alias("sha"), F.array(F.concat(F.lit("m"), i - 1)).alias("p"))
    df = main.union(side).select("sha", F.transform("p", lambda x: F.struct(x.alias("sha"))).alias("parents"))
    from commitlake.operators import ancestry

    rounds, cut = [], ancestry._cut
    monkeypatch.setattr(ancestry, "_cut", lambda x: rounds.append(1) or cut(x))
    found = ops.generations(df)
    assert len(rounds) < 30
    # each merge makes the longest path one longer
    k = F.substring("sha", 2, 9).cast("long")
    want = F.when(F.col("sha").startswith("m"), k + 1 + F.floor(k / 5)).otherwise(k + F.floor((k - 1) / 5) + 1)
    assert found.count() == n + n // 5 - 1 and found.where((F.col("generation") != want) | F.col("generation").isNull()).isEmpty()


def test_rounds_carry_numbers_and_open_pairs_only(spark, commits, monkeypatch):
    from commitlake.operators import ancestry

    kept, cut = [], ancestry._cut
    monkeypatch.setattr(ancestry, "_cut", lambda x: kept.append(cut(x)) or kept[-1])
    parents = {"r": [], "s": []} | {f"c{i:02d}": [f"c{i - 1:02d}" if i else "r"] for i in range(12)}
    parents |= {f"{k}{i:03d}": ["s"] for k in "xy" for i in range(100)}
    df = table(commits, parents)
    assert ops.generations(df).count() == len(parents)
    assert [x.dtypes for x in kept if "string" in dict(x.dtypes).values()] == [[("sha", "string"), ("id", "bigint")]]
    kept.clear()
    # a hundred pairs meet at once; one goes on along a chain that is not skipped
    pairs = [(f"x{i:03d}", f"y{i:03d}") for i in range(100)] + [(f"c{i:02d}",) * 2 for i in range(12)] + [("c11", "s")]
    found = ops.common_ancestors(df, spark.createDataFrame(pairs, "a string, b string")).collect()
    assert {(x.a, x.b): x.ancestor for x in found} == {(a, b): "s" if a[0] == "x" else a if a == b else None for a, b in pairs}
    searched = [x.count() for x in kept if "go" in x.columns]
    assert len(searched) > 8 and sum(searched[3:]) < 100


def brute_rank(ids, edges, rounds, tolerance, percent=85):
    n, rank, done = len(ids), dict.fromkeys(ids, UNIT), 0
    out = {}
    for s, d in edges:
        out.setdefault(s, set()).add(d)
    while done < rounds:
        lost = sum(rank[i] for i in ids if i not in out)
        new = dict.fromkeys(ids, UNIT * (100 - percent) // 100 + percent * lost // (100 * n))
        for s, ds in out.items():
            for d in ds:
                new[d] += rank[s] * percent // (100 * len(ds))
        change = sum(abs(new[i] - rank[i]) for i in ids)
        rank, done = new, done + 1
        if change < tolerance * UNIT * n:
            break
    return {i: r / UNIT for i, r in rank.items()}, done


@pytest.mark.parametrize("hub, both_ways", [(10_000, False), (3, False), (3, True)])
def test_graph_rank(spark, hub, both_ways):
    r = random.Random(hub)
    ids = list(range(60))
    edges = {(r.randrange(60), r.randrange(50)) for _ in range(150)} | {(7, d) for d in range(50)} | {(s, 3) for s in range(40)}
    rows = [*edges, *list(edges)[:20], (7, 999), (999, 7), (None, 3), (3, None)]
    vertices = spark.createDataFrame([(i,) for i in [*ids, 5, 5, None]], "id long")
    links = spark.createDataFrame(rows, "src long, dst long").repartition(3)
    want_edges = edges | {(d, s) for s, d in edges} if both_ways else edges
    for rounds, tolerance in ((5, 0.0), (60, 0.01)):
        got = ops.graph_rank(vertices, links, rounds=rounds, tolerance=tolerance, both_ways=both_ways, hub=hub).collect()
        want, done = brute_rank(ids, want_edges, rounds, tolerance)
        assert {x.id: x.rank for x in got} == want and {x.rounds for x in got} == {done} and len(got) == 60
    assert done < 60 and abs(sum(want.values()) - 60) < 0.01


def test_graph_rank_without_vertices_or_edges(spark):
    none = spark.createDataFrame([], "src long, dst long")
    assert ops.graph_rank(spark.createDataFrame([], "id long"), none).count() == 0
    got = ops.graph_rank(spark.createDataFrame([(1,), (2,)], "id long"), none).collect()
    assert [round(x.rank, 6) for x in got] == [1.0, 1.0]
