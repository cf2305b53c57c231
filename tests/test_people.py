"""O4, O5, O6, O7, O10."""

from __future__ import annotations

from commitlake import operators as ops

from conftest import commit, url


def test_user_stats_missing_stats_and_unknown_user(commits, spark):
    df = commits([
        commit("a", author="Otto", committer="x", stats=(10, 7, 3)),
        commit("b", author="Otto", stats=None),
        commit("c", author="Otto", stats=(5, 5, 0)),
        commit("d", author="Eve", stats=(1, 1, 0)),
    ])
    got = [tuple(r) for r in ops.user_stats(df, ["Otto", "nobody"]).collect()]
    assert got == [("Otto", 15, 12, 3)]
    names = spark.createDataFrame([("Otto",), ("Eve",)], "who string")
    got = sorted(tuple(r) for r in ops.user_stats(df, names).collect())
    assert got == [("Eve", 1, 1, 0), ("Otto", 15, 12, 3)]


def test_exclusive_people(commits):
    df = commits([
        commit("a", author="both", url_=url("both", "r")),
        commit("b", author="only_author", url_=url("both", "r")),
        commit("c", author="both", url_=url("only_owner", "r")),
        commit("d", author="both", url_="a/b/c"),  # too short for an owner
    ])
    assert sorted(r.name for r in ops.exclusive_people(df).collect()) == ["only_author", "only_owner"]


def test_revert_streaks(commits):
    df = commits([
        commit("a", author="x", message='Revert "Revert "thing""'),
        commit("b", author="x", message="Revert Reverted"),
        commit("c", author="x", message="Revert once"),
        commit("d", author="y", message="Oops, Revert Revert"),
        commit("e", author="y", message="revert lower"),
        commit("f", author="z", message="Revert a"),
        commit("g", author="z", message="Revert b"),
    ])
    got = sorted(tuple(r) for r in ops.revert_streaks(df).collect())
    assert got == [("x", 2, 2), ("z", 1, 2)]


def test_repo_committers_flat(commits):
    df = commits([
        commit("a", committer="AlbertGandolf", url_=url("SharedUmbrella", "SharedUmbrella")),
        commit("b", committer="c1", url_=url("o1", "r")),
        commit("c", committer="c2", url_=url("o1", "r")),
        commit("d", committer="c1", url_=url("o1", "r")),
        commit("e", committer="c1", url_=url("o2", "r")),
        commit("f", committer="c9", url_="https://example.com/nothing"),
    ])
    got = sorted(tuple(r) for r in ops.repo_committers(df).collect())
    assert got == [
        ("SharedUmbrella", "SharedUmbrella", 1, "AlbertGandolf", 1),
        ("norepo", "norepo", 1, "c9", 1),
        ("o1", "r", 3, "c1", 2),
        ("o1", "r", 3, "c2", 1),
        ("o2", "r", 1, "c1", 1),
    ]


def test_committer_repo_stats_zero_when_all_missing(commits):
    df = commits([
        commit("a", committer="GitHub", url_=url("x", "danfe"), stats=None),
        commit("b", committer="GitHub", url_=url("y", "danfe"), stats=None),
        commit("c", committer="ivan", url_=url("o", "AIM-Chat"), stats=(75, 45, 30)),
        commit("d", committer="ivan", url_="bad", stats=(1, 1, 0)),
    ])
    got = sorted(tuple(r) for r in ops.committer_repo_stats(df).collect())
    assert got == [("GitHub", "danfe", 0, 0, 0), ("ivan", "AIM-Chat", 75, 45, 30), ("ivan", "norepo", 1, 1, 0)]


def test_user_stats_by_committer_role(commits):
    df = commits([
        commit("a", author="Otto", committer="GitHub", stats=(10, 7, 3)),
        commit("b", author="GitHub", committer="Otto", stats=(1, 1, 0)),
    ])
    assert [tuple(r) for r in ops.user_stats(df, ["Otto"], role="committer").collect()] == [("Otto", 1, 1, 0)]
    assert [tuple(r) for r in ops.user_stats(df, ["Otto"]).collect()] == [("Otto", 10, 7, 3)]
