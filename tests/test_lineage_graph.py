"""O18, O19, O11."""

from __future__ import annotations

import random

from commitlake import operators as ops

from conftest import commit, url
from test_columns import java_vertex_id


def test_branch_points_bag_semantics(commits):
    df = commits([
        commit("root"),
        commit("a", parents=["root"]),
        commit("b", parents=["root"]),
        commit("c", parents=["a", "missing"]),
        commit("dup", parents=["a"]),
        commit("dup", parents=["x"]),
        commit("e", parents=["dup"]),
    ])
    got = sorted(tuple(r) for r in ops.branch_points(df).collect())
    # root: 2 children; a: 2 references; dup stored twice: 1 reference x 2 rows
    assert got == [("a", 2), ("dup", 2), ("root", 2)]


def test_branch_points_random_against_join(commits):
    rng = random.Random(5)
    rows, raw = [], []
    for i in range(400):
        sha = f"s{rng.randint(0, 300)}"
        parents = [f"s{rng.randint(0, 300)}" for _ in range(rng.randint(0, 3))]
        rows.append(commit(sha, parents=parents))
        raw.append((sha, parents))
    shas = [s for s, _ in raw]
    counts = {}
    for _, parents in raw:
        for p in parents:
            counts[p] = counts.get(p, 0) + shas.count(p)
    want = sorted((k, v) for k, v in counts.items() if v >= 2)
    assert sorted(tuple(r) for r in ops.branch_points(commits(rows)).collect()) == want


def test_fork_points(commits):
    df = commits([
        commit("p", url_=url("NantesJS", "site", "p")),
        commit("c", url_=url("jtanguy", "site", "c"), parents=["p"]),
        commit("same", url_=url("NantesJS", "site", "same"), parents=["p"]),
        commit("bad1", url_="nourl1", parents=["bad2"]),
        commit("bad2", url_="nourl2"),
        commit("orphan", url_="nourl3", parents=["p"]),
    ])
    got = sorted(tuple(r) for r in ops.fork_points(df).collect())
    assert got == [
        ("NantesJS/site", "", "p", "orphan", 1),
        ("NantesJS/site", "jtanguy/site", "p", "c", 1),
    ]
    assert ops.fork_points(df).columns == ["parent_repo_name", "child_repo_name", "parent_sha", "child_sha", "n"]


def test_graph(commits):
    df = commits([
        commit("a", committer="dev1", url_=url("o", "r")),
        commit("b", committer="dev1", url_=url("o", "r")),
        commit("c", committer="dev2", url_=url("o", "r")),
        commit("d", committer="dev1", url_="bad"),
        commit("e", committer="o/r", url_=url("x", "y")),
    ])
    vertices = sorted(tuple(r) for r in ops.graph_vertices(df).collect())
    names = {(n, t) for _, n, t in vertices}
    assert names == {
        ("dev1", "developer"), ("dev2", "developer"), ("o/r", "developer"),
        ("o/r", "repository"), ("norepo", "repository"), ("x/y", "repository"),
    }
    assert all(i == java_vertex_id(n) for i, n, _ in vertices)
    edges = sorted(tuple(r) for r in ops.graph_edges(df).collect())
    want = sorted({(java_vertex_id(c), java_vertex_id(r)) for c, r in [
        ("dev1", "o/r"), ("dev2", "o/r"), ("dev1", "norepo"), ("o/r", "x/y")]})
    assert edges == want


def test_fork_points_copies_counted(commits):
    df = commits([
        commit("p", url_=url("up", "r", "p")),
        commit("p", url_=url("up", "r", "p")),
        commit("p", url_=url("other", "r", "p")),
        commit("c", url_=url("fork", "r", "c"), parents=["p"]),
    ])
    got = sorted(tuple(r) for r in ops.fork_points(df).collect())
    assert got == [("other/r", "fork/r", "p", "c", 1), ("up/r", "fork/r", "p", "c", 2)]


def test_fork_points_random_against_brute_force(commits):
    rng = random.Random(9)
    rows, raw = [], []
    repos = [("o1", "r"), ("o2", "r"), ("o3", "s")]
    for i in range(500):
        sha = f"s{rng.randint(0, 250)}"  # repeats: copies of one commit
        owner, repo = rng.choice(repos)
        parents = [f"s{rng.randint(0, 250)}" for _ in range(rng.randint(0, 2))]
        rows.append(commit(sha, url_=url(owner, repo, sha), parents=parents))
        raw.append((sha, f"{owner}/{repo}", parents))
    bag = {}
    for child_sha, child_repo, parents in raw:
        for p in parents:
            for parent_sha, parent_repo, _ in raw:
                if parent_sha == p and parent_repo != child_repo:
                    key = (parent_repo, child_repo, parent_sha, child_sha)
                    bag[key] = bag.get(key, 0) + 1
    got = {}
    for r in ops.fork_points(commits(rows)).collect():
        key = (r.parent_repo_name, r.child_repo_name, r.parent_sha, r.child_sha)
        got[key] = got.get(key, 0) + r.n
    assert got == bag
