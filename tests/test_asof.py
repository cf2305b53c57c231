"""As-of join against a direct search, with hot keys split over parts."""

from __future__ import annotations

import random
import re

import pytest
from conftest import commit, file, url

from commitlake import operators as ops
from commitlake.operators import asof
from commitlake.plans.inspect import RED_FLAGS, plan_text


def brute(left, right, strict):
    out = []
    for k, t, x in left:
        fits = [(u, a, b) for j, u, a, b in right if None not in (k, t, u) and j == k and (u < t if strict else u <= t)]
        key = lambda r: (r[0], r[1] is not None, r[1] or 0, r[2])
        out.append((k, t, x, max(fits, key=key, default=None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("strict, partitions", [(False, 8), (True, 3), (False, 1)])
def test_against_a_direct_search(spark, strict, partitions):
    r = random.Random(partitions)
    # key 0 holds most rows of both sides, and some long stretches without a right row
    some_key = lambda: r.choice([0, 0, 0, 0, 1, 2, 3, None])
    left = [(some_key(), r.choice([None, *range(60)]), i) for i in range(300)] + [(0, 100 + i, i) for i in range(200)]
    right = [(some_key(), r.choice([None, *range(0, 60, 3)]), r.choice([None, 1, 2]), str(i)) for i in range(60)]
    right += right[:5]
    df = ops.as_of_join(
        spark.createDataFrame(left, "k long, t long, x long"), spark.createDataFrame(right, "k long, t long, a long, b string"),
        ["k"], "t", strict=strict, partitions=partitions,
    )
    got = sorted([(x.k, x.t, x.x, None if x.found is None else tuple(x.found)) for x in df.collect()], key=str)
    assert got == brute(left, right, strict)


def test_empty_sides_and_names(spark):
    left = spark.createDataFrame([(1, 5)], "k long, t long")
    none = spark.createDataFrame([], "k long, t long, v string")
    assert [x.found for x in ops.as_of_join(left, none, ["k"], "t").collect()] == [None]
    assert ops.as_of_join(left.limit(0), none, ["k"], "t").count() == 0
    with pytest.raises(ValueError):
        ops.as_of_join(left.withColumnRenamed("k", "found"), none, ["found"], "t")


def test_previous_versions_of_a_hot_file(commits):
    rows = [
        commit(sha=f"s{i:03d}", url_=url("o", "r", f"s{i:03d}"), date=f"2019-01-{1 + i // 4:02d}T00:00:0{i % 2}", files=[file("hot.py", sha=f"f{i:03d}")])
        for i in range(80)
    ]
    got = {r.sha: r for r in ops.previous_versions(commits(rows).repartition(4)).collect()}
    dates = {f"s{i:03d}": (1 + i // 4, i % 2) for i in range(80)}
    for sha, own in dates.items():
        before = [(d, f"f{s[1:]}", s) for s, d in dates.items() if d < own]
        want = max(before, default=(None, None, None))
        assert (got[sha].previous_file_sha, got[sha].previous_sha) == want[1:]


def test_plan_has_no_nested_loop(spark):
    left = spark.range(100).selectExpr("id % 3 AS k", "id AS t")
    text = plan_text(ops.as_of_join(left, left, ["k"], "t", partitions=4))
    assert not RED_FLAGS["nested_loop"].search(text) and not RED_FLAGS["cartesian"].search(text)


@pytest.fixture
def short_stretches(monkeypatch):
    monkeypatch.setattr(asof, "TOGETHER", 20)
    monkeypatch.setattr(asof, "SAMPLED", 1)


@pytest.mark.parametrize("strict, partitions", [(False, 8), (True, 8), (True, None)])
def test_long_keys_are_cut_into_stretches(spark, short_stretches, strict, partitions):
    r = random.Random(str(partitions))
    some_key = lambda: r.choice([0, 0, 0, 0, 1, 2, None])
    # most rows of key 0 are at one time; stretches of it have no right row
    left = [(some_key(), r.choice([None, 7, 7, 7, *range(60)]), i) for i in range(300)] + [(0, 100 + i, i) for i in range(200)]
    right = [(some_key(), r.choice([None, 7, 7, *range(0, 60, 3)]), r.choice([None, 1, 2]), str(i)) for i in range(90)]
    df = ops.as_of_join(
        spark.createDataFrame(left, "k long, t long, x long").repartition(3), spark.createDataFrame(right, "k long, t long, a long, b string"),
        ["k"], "t", strict=strict, partitions=partitions,
    )
    assert sorted([(x.k, x.t, x.x, None if x.found is None else tuple(x.found)) for x in df.collect()], key=str) == brute(left, right, strict)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("together", [20, 10_000])
def test_left_rows_as_right_rows(spark, monkeypatch, short_stretches, strict, together):
    monkeypatch.setattr(asof, "TOGETHER", together)
    r = random.Random(5)
    left = [(r.choice([0, 0, 0, 1, None]), r.choice([None, 7, 7, 7, *range(60)]), r.choice([None, i, 3])) for i in range(300)]
    df = ops.as_of_join(spark.createDataFrame(left, "k long, t long, x long").repartition(3), {"a": "x", "b": "k"}, ["k"], "t", strict=strict, partitions=6)
    want = brute(left, [(k, t, x, k) for k, t, x in left], strict)
    assert sorted([(x.k, x.t, x.x, None if x.found is None else tuple(x.found)) for x in df.collect()], key=str) == want


def test_one_shuffle_of_the_rows(spark):
    """Rows are dealt once and never written (before: twice, and a checkpoint between)."""
    left = spark.range(100).selectExpr("id % 3 AS k", "id AS t", "id AS x")
    text = plan_text(ops.as_of_join(left, {"x": "x"}, ["k"], "t", strict=True)).split("\n\n", 1)[0]
    assert text.count("Exchange") == 1 and "ExistingRDD" not in text


def test_left_rows_are_not_doubled(spark):
    """Each row is shuffled and sorted once (before: doubled behind the shuffle)."""
    left = spark.range(100).selectExpr("id % 3 AS k", "id AS t", "id AS x")
    text = plan_text(ops.as_of_join(left, {"x": "x"}, ["k"], "t", strict=True)).split("\n\n", 1)[0]
    assert "Generate" not in text and text.count("Sort") == 1


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("together", [20, 10_000])
def test_hashes_come_back_as_they_were(spark, monkeypatch, short_stretches, strict, together):
    monkeypatch.setattr(asof, "TOGETHER", together)
    r = random.Random(6)
    texts = ["00ff", "00fe", "00f", "00FF", "", "0", "zz", "00ff00", "é", "ff ", None]
    left = [(r.choice([0, 0, 1, None]), r.choice([None, 3, 3, *range(20)]), r.choice(texts)) for _ in range(200)]
    df = ops.as_of_join(spark.createDataFrame(left, "k long, t long, x string").repartition(3), {"a": "x"}, ["k"], "t", strict=strict, partitions=4, hashes=["x"])

    def found(k, t):
        fits = [(u, x is not None, (x or "").encode()) for j, u, x in left if None not in (k, t, u) and j == k and (u < t if strict else u <= t)]
        best = max(fits, default=None)
        return best and (best[0], best[2].decode() if best[1] else None)

    want = sorted(((k, t, x, found(k, t)) for k, t, x in left), key=str)
    assert sorted([(x.k, x.t, x.x, x.found and tuple(x.found)) for x in df.collect()], key=str) == want


def test_hashes_are_shuffled_as_bytes(spark, commits):
    text = plan_text(ops.previous_versions(commits([commit(files=[file("a")])])))
    sent = [x for x in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text) if "_octets" in x]
    assert len(sent) == 1 and sent[0].count("_octets#") == 2 and not re.search(r"_c\d+#", sent[0])
