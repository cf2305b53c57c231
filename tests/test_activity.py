"""O1, O3, O12-O17."""

from __future__ import annotations

import datetime as dt
import random

from commitlake import operators as ops
from commitlake.operators._rank import rank_by_count

from conftest import commit, ts


def test_commit_count_keeps_duplicates(commits):
    df = commits([commit("a"), commit("a"), commit("b")])
    assert ops.commit_count(df).first().n_commits == 3
    assert ops.commit_count(commits([])).first().n_commits == 0


def test_author_ranking_ties_by_lower_name(commits):
    rows = (
        [commit(f"s{i}", author="bob") for i in range(3)]
        + [commit(f"t{i}", author="Alice") for i in range(2)]
        + [commit(f"u{i}", author="carl") for i in range(2)]
        + [commit("v", author="zed")]
    )
    got = [tuple(r) for r in ops.author_ranking(commits(rows)).collect()]
    assert got == [(0, "bob", 3), (1, "Alice", 2), (2, "carl", 2), (3, "zed", 1)]


def test_rank_by_count_matches_global_sort(spark):
    rng = random.Random(7)
    names = set()
    while len(names) < 3000:
        stem = rng.choice(["user", "User", "bot", "a", "zz", "x"])
        names.add(stem + str(rng.randint(0, 99999)) + rng.choice(["", "X", "x"]))
    rows = [(n, rng.choice([1, 1, 1, 2, 2, 3, 5, 8, 13])) for n in sorted(names)]
    df = spark.createDataFrame(rows, "name string, n bigint")
    want = sorted(rows, key=lambda r: (-r[1], r[0].lower(), r[0]))
    for partitions in (1, 7, 32):
        got = {r["name"]: r["rank"] for r in rank_by_count(df, "name", "n", partitions=partitions).collect()}
        assert [got[name] for name, _ in want] == list(range(len(want)))


def test_commits_by_committer_sorted(commits):
    df = commits([
        commit("b", committer="GitHub", date="2019-03-04T15:21:52"),
        commit("a", committer="GitHub", date="2019-01-27T07:09:13"),
        commit("c", committer="other", date="2018-01-01T00:00:00"),
        commit("a2", committer="GitHub", date="2019-03-04T15:21:52"),
    ])
    got = [(r.committer, r.sha) for r in ops.commits_by_committer(df, ["GitHub"]).collect()]
    assert got == [("GitHub", "a"), ("GitHub", "a2"), ("GitHub", "b")]


def test_weekly_commits_iso_week_calendar_year(commits):
    df = commits([
        commit("a", date="2018-12-31T10:00:00"),
        commit("b", date="2019-01-02T10:00:00"),
        commit("c", url_="https://example.com/none", date="2019-05-20T10:00:00"),
    ])
    got = sorted(tuple(r) for r in ops.weekly_commits(df).collect())
    assert got == [("", 21, 2019, 1), ("repo", 1, 2018, 1), ("repo", 1, 2019, 1)]


def test_commit_age_and_delay(commits):
    df = commits([
        commit("a", date="2019-10-10T11:30:29", authored="2019-10-10T11:00:00"),
        commit("b", date="2019-10-11T00:00:00", authored="2019-10-11T00:00:00"),
    ])
    snapshot = 1570707029  # 2019-10-10T11:30:29Z
    ages = dict(ops.commit_age(df, snapshot).select("sha", "age").collect())
    assert ages == {"a": 0, "b": snapshot - 1570752000}
    assert ops.commit_age(df, dt.datetime(2019, 10, 10, 11, 30, 29)).where("sha = 'a'").first().age == 0
    delays = dict(ops.commit_delay(df).select("sha", "commit_time_diff").collect())
    assert delays == {"a": 1829, "b": 0}
    assert len(ops.commit_age(df, 0).columns) == len(df.columns) + 1


def test_weekday_commits(commits):
    df = commits([
        commit("a", date="2019-01-27T07:00:00"),  # Sunday
        commit("b", date="2019-01-27T23:00:00"),
        commit("c", date="2019-01-28T00:00:00"),  # Monday
    ])
    assert sorted(tuple(r) for r in ops.weekday_commits(df).collect()) == [(1, 2), (2, 1)]


def _brute_gaps(rows):
    out = {}
    by = {}
    for who, sha, when in rows:
        by.setdefault(who, []).append((when, sha))
    for who, items in by.items():
        items.sort()
        prev = None
        for when, sha in items:
            out[sha] = 0 if prev is None else (when.date() - prev.date()).days
            prev = when
    return out


def test_commit_gaps_calendar_days(commits):
    df = commits([
        commit("a", committer="GitHub", date="2019-01-27T07:09:13"),
        commit("b", committer="GitHub", date="2019-03-04T15:21:52"),
        commit("c", committer="GitHub", date="2019-03-04T23:59:00"),
        commit("d", committer="GitHub", date="2019-03-05T00:01:00"),
        commit("e", committer="other", date="2019-03-06T00:01:00"),
    ])
    one = ops.commit_gaps(df, "GitHub")
    assert [(r.sha, r.time_diff) for r in one.collect()] == [("a", 0), ("b", 36), ("c", 0), ("d", 1)]
    assert len(one.columns) == len(df.columns) + 1
    everyone = dict(ops.commit_gaps(df).select("sha", "time_diff").collect())
    assert everyone["e"] == 0 and everyone["d"] == 1


def test_commit_gaps_random_against_brute_force(commits):
    rng = random.Random(3)
    base = dt.datetime(2019, 1, 1)
    raw, rows = [], []
    for i in range(2000):
        who = "hot" if rng.random() < 0.5 else f"c{rng.randint(0, 20)}"
        when = base + dt.timedelta(seconds=rng.randint(0, 86400 * 60))
        raw.append((who, f"s{i}", when))
        rows.append(commit(f"s{i}", committer=who, date=when))
    got = dict(ops.commit_gaps(commits(rows)).select("sha", "time_diff").collect())
    assert got == _brute_gaps(raw)
    order = [r.sha for r in ops.commit_gaps(commits(rows)).select("sha").collect()]
    assert order == [sha for _, sha, _ in sorted(raw, key=lambda r: (r[2], r[1]))]


def test_commit_gaps_equal_timestamps(commits):
    same = "2019-02-01T10:00:00"
    df = commits([
        commit("x2", committer="c", date=same),
        commit("x1", committer="c", date=same),
        commit("w", committer="c", date="2019-01-30T10:00:00"),
    ])
    got = dict(ops.commit_gaps(df).select("sha", "time_diff").collect())
    assert got == {"w": 0, "x1": 2, "x2": 0}


def test_commit_gaps_copies_of_one_commit(commits):
    # the same commit in three repositories, first of its day: one copy gets the gap
    df = commits([
        commit("p", committer="c", date="2019-01-01T10:00:00"),
        commit("x", committer="c", date="2019-01-05T10:00:00", url_="https://api.github.com/repos/a/r/commits/x"),
        commit("x", committer="c", date="2019-01-05T10:00:00", url_="https://api.github.com/repos/b/r/commits/x"),
        commit("x", committer="c", date="2019-01-05T10:00:00", url_="https://api.github.com/repos/c/r/commits/x"),
        commit("y", committer="c", date="2019-01-05T11:00:00"),
    ])
    got = sorted((r.sha, r.time_diff) for r in ops.commit_gaps(df).collect())
    assert got == [("p", 0), ("x", 0), ("x", 0), ("x", 4), ("y", 0)]


def test_commit_gaps_many_copies_counted_before_the_window(commits):
    # copies of one commit at the first instant of a day: counted by a
    # partial aggregate, generated again after the window, one takes the gap
    copy = commit("x", committer="c", date="2019-01-05T10:00:00")
    rows = [commit("p", committer="c", date="2019-01-01T10:00:00")] + [copy] * 5000
    rows.append(commit("y", committer="c", date="2019-01-05T11:00:00"))
    out = ops.commit_gaps(commits(rows))
    got = [(r.sha, r.time_diff) for r in out.select("sha", "time_diff").collect()]
    assert len(got) == 5002
    assert got[0] == ("p", 0) and got[-1] == ("y", 0)
    assert sorted(got[1:-1]) == [("x", 0)] * 4999 + [("x", 4)]
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in text and "row_number" in text


def test_commit_gaps_one_commit_in_many_forks(commits):
    # same sha and date in many repositories: the smallest url takes the gap
    rows = [commit("p", committer="c", date="2019-01-01T10:00:00")]
    rows += [
        commit("x", committer="c", date="2019-01-05T10:00:00", url_=f"https://api.github.com/repos/o{i:04d}/r/commits/x")
        for i in range(3000)
    ]
    got = ops.commit_gaps(commits(rows)).select("sha", "url", "time_diff").collect()
    assert len(got) == 3001
    gaps = [(r.sha, r.url) for r in got if r.time_diff != 0]
    assert gaps == [("x", "https://api.github.com/repos/o0000/r/commits/x")]
    assert [r.url for r in got[1:]] == sorted(r.url for r in got[1:])


def test_commit_gaps_with_a_map_column(commits):
    # a column of any type is only carried along
    from pyspark.sql import functions as F

    df = commits([
        commit("p", committer="c", date="2019-01-01T10:00:00"),
        commit("x", committer="c", date="2019-01-05T10:00:00"),
        commit("x", committer="c", date="2019-01-05T10:00:00"),
    ]).withColumn("tags", F.create_map(F.lit("k"), F.col("sha")))
    got = sorted((r.sha, r.time_diff) for r in ops.commit_gaps(df).collect())
    assert got == [("p", 0), ("x", 0), ("x", 4)]


def test_commit_gaps_with_a_variant_column(commits):
    df = commits([
        commit("p", committer="c", date="2019-01-01T10:00:00"),
        commit("x", committer="c", date="2019-01-05T10:00:00"),
        commit("x", committer="c", date="2019-01-05T10:00:00"),
    ]).selectExpr("*", "parse_json(concat('{\"a\":\"', sha, '\"}')) AS extra")
    got = sorted((r.sha, r.time_diff, r.a) for r in ops.commit_gaps(df).selectExpr(
        "sha", "time_diff", "variant_get(extra, '$.a', 'string') AS a").collect())
    assert got == [("p", 0, "p"), ("x", 0, "x"), ("x", 4, "x")]


def test_commits_by_committer_with_a_frame_of_names(commits, spark):
    df = commits([commit(f"s{i}", committer=f"c{i % 4}", date=f"2019-01-0{1 + i}T10:00:00") for i in range(8)])
    names = spark.createDataFrame([("c1",), ("c3",), ("c1",), (None,)], "name string")
    listed = ops.commits_by_committer(df, ["c1", "c3"]).collect()
    assert ops.commits_by_committer(df, names).collect() == listed and len(listed) == 4


def test_commits_by_committer_copies_keep_their_order(commits):
    rows = [commit("x", committer="c", date="2019-01-05T10:00:00")] * 3000
    rows += [commit("a", committer="c", date="2019-01-01T10:00:00"), commit("z", committer="c", date="2019-01-06T10:00:00")]
    got = [r.sha for r in ops.commits_by_committer(commits(rows), ["c"]).collect()]
    assert got == ["a"] + ["x"] * 3000 + ["z"]


def test_commit_gaps_rows_without_date_stay_out_of_the_windows(commits):
    rows = [commit(f"n{i}", committer="c", date=None) for i in range(500)] + [commit("n0", committer="c", date=None)] * 500
    rows += [commit("a", committer="c", date="2019-01-01T10:00:00"), commit("b", committer="c", date="2019-01-03T10:00:00")]
    out = ops.commit_gaps(commits(rows))
    assert sorted((r.sha, r.time_diff) for r in out.collect() if r.time_diff) == [("b", 2)] and out.count() == 1002


def test_commit_gaps_keeps_rows_without_date(commits):
    df = commits([
        commit("a", committer="c", date="2019-01-01T10:00:00"),
        commit("n1", committer="c", date=None),
        commit("n2", committer="c", date=None),
        commit("b", committer="c", date="2019-01-03T10:00:00"),
    ])
    got = dict(ops.commit_gaps(df).select("sha", "time_diff").collect())
    assert got == {"a": 0, "n1": 0, "n2": 0, "b": 2}


def test_weekly_commits_iso_year_option(commits):
    df = commits([commit("a", date="2018-12-31T10:00:00"), commit("b", date="2021-01-02T10:00:00")])
    got = sorted(tuple(r) for r in ops.weekly_commits(df, iso_year=True).collect())
    assert got == [("repo", 1, 2019, 1), ("repo", 53, 2020, 1)]


def test_unordered_variants_give_the_same_rows(commits):
    rows = [commit(f"s{i}", committer=f"c{i % 3}", date=f"2019-01-{1 + i % 9:02d}T0{i % 10}:00:00") for i in range(40)]
    df = commits(rows)
    a = sorted(tuple(r) for r in ops.commit_gaps(df).select("sha", "time_diff").collect())
    b = sorted(tuple(r) for r in ops.commit_gaps(df, ordered=False).select("sha", "time_diff").collect())
    assert a == b
    assert "rangepartitioning" not in ops.commit_gaps(df, ordered=False)._jdf.queryExecution().executedPlan().toString()
    c = sorted(tuple(r) for r in ops.commits_by_committer(df, ["c1"], ordered=False).collect())
    assert c == sorted(tuple(r) for r in ops.commits_by_committer(df, ["c1"]).collect())
