"""Checks in the reference's own test style: seeded samples, ``describe`` of a
result column, ``take(n)`` on ordered output, all on the commit view."""

from __future__ import annotations

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from commitlake import operators as ops
from commitlake.sources import commits_view

from conftest import TESTDATA


@pytest.fixture(scope="module")
def view(spark):
    df = commits_view(spark, f"{TESTDATA}/sf0.01", with_files=False).cache()
    yield df
    df.unpersist()


def test_ranking_take_is_ordered(view):
    top = view.groupBy(F.col("commit.author.name").alias("a")).count().collect()
    want = sorted(((-r["count"], r.a.lower(), r.a) for r in top))[:25]
    got = ops.author_ranking(view).take(25)
    assert [r["rank"] for r in got] == list(range(25))
    assert [(-r.n_commits, r.author.lower(), r.author) for r in got] == want


def test_commit_gaps_describe(view):
    rows = view.where(F.col("commit.committer.name") == "GitHub").select(
        F.col("commit.committer.date").alias("d"), "sha"
    ).collect()
    rows.sort(key=lambda r: (r.d, r.sha))
    diffs = [0] + [(b.d.date() - a.d.date()).days for a, b in zip(rows, rows[1:])]
    stats = {r.summary: r.time_diff for r in ops.commit_gaps(view, "GitHub").describe("time_diff").collect()}
    assert int(stats["count"]) == len(diffs)
    assert float(stats["mean"]) == pytest.approx(statistics.mean(diffs))
    assert float(stats["stddev"]) == pytest.approx(statistics.stdev(diffs))
    assert (int(stats["min"]), int(stats["max"])) == (min(diffs), max(diffs))


def test_weekday_and_delay_on_seeded_sample(view):
    sample = view.sample(fraction=0.2, seed=0).cache()
    try:
        rows = sample.select(
            F.col("commit.committer.date").alias("c"), F.col("commit.author.date").alias("a")
        ).collect()
        weekday = {}
        for r in rows:
            day = (r.c.date().isoweekday() % 7) + 1  # Sunday = 1
            weekday[day] = weekday.get(day, 0) + 1
        assert dict(tuple(r) for r in ops.weekday_commits(sample).collect()) == weekday

        delays = [int((r.c - r.a) / dt.timedelta(seconds=1)) for r in rows]
        assert ops.commit_delay(sample).where(F.col("commit_time_diff").isNull()).count() == 0
        stats = {r.summary: r.commit_time_diff for r in ops.commit_delay(sample).describe("commit_time_diff").collect()}
        assert int(stats["count"]) == len(delays)
        assert (int(stats["min"]), int(stats["max"])) == (min(delays), max(delays))
        assert float(stats["mean"]) == pytest.approx(statistics.mean(delays))
    finally:
        sample.unpersist()


def test_revert_streaks_on_sample_match_brute_force(view):
    sample = view.sample(fraction=0.5, seed=0).cache()
    try:
        rows = sample.select(F.col("commit.author.name").alias("a"), F.col("commit.message").alias("m")).collect()
        per = {}
        for r in rows:
            if r.m.startswith("Revert"):
                per.setdefault(r.a, []).append(r.m.count("Revert"))
        want = {a: (max(v), v.count(max(v))) for a, v in per.items()}
        got = {r.author: (r.streak, r.n) for r in ops.revert_streaks(sample).collect()}
        assert got == want
    finally:
        sample.unpersist()
