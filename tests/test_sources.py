"""JSON (multi-line and lines) and Parquet sources, date normalisation."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlake.plans import summarize
from commitlake.plans.inspect import plan_text
from commitlake.schema import COMMIT, normalise_dates
from commitlake.sources import commits_view, load_commits
from commitlake.streaming import stream_commits
from commitlake import operators as ops

from conftest import TESTDATA

RECORD = {
    "_id": {"$oid": "5ce6929e6480fd0d91d3106a"},
    "sha": "65a88dce81af6d4dc6751deab202fa8eeadaf9c0",
    "url": "https://api.github.com/repos/own/rep/commits/65a88dce",
    "commit": {
        "author": {"name": "A", "email": "a@x", "date": "2019-01-27T07:09:13.000Z"},
        "committer": {"name": "GitHub", "email": "g@x", "date": "2019-01-27T07:10:00.000Z"},
        "message": "Revert x",
        "tree": {"sha": "t"},
        "comment_count": 0,
        "verification": {"verified": True, "reason": "valid"},
    },
    "parents": [{"sha": "p1"}],
    "stats": {"total": 3, "additions": 2, "deletions": 1},
    "files": [{"sha": "f", "filename": "a.py", "status": "added", "additions": 2,
               "deletions": 1, "changes": 3}],
}


def _variants():
    missing = json.loads(json.dumps(RECORD))
    missing["sha"] = "second"
    del missing["stats"]
    del missing["files"]
    missing["commit"]["committer"]["date"] = "not a date"
    offset = json.loads(json.dumps(RECORD))
    offset["sha"] = "third"
    offset["commit"]["committer"]["date"] = "2019-01-27T09:10:00.000+02:00"
    return [RECORD, missing, offset]


def _check(df):
    rows = {r["sha"]: r for r in df.select("sha", "commit", "stats", "files", "_id").collect()}
    first = rows[RECORD["sha"]]
    assert first.commit.committer.date == dt.datetime(2019, 1, 27, 7, 10, 0)
    assert first.commit.author.date == dt.datetime(2019, 1, 27, 7, 9, 13)
    assert first.stats.total == 3 and first.files[0].filename == "a.py"
    assert "$oid" in first._id
    second = rows["second"]
    assert second.commit.committer.date is None
    assert second.stats is None and second.files is None
    # an explicit offset is moved to UTC
    assert rows["third"].commit.committer.date == dt.datetime(2019, 1, 27, 7, 10, 0)
    assert dict(df.dtypes)["commit"].count("timestamp_ntz") == 2


def test_multiline_json(spark):
    folder = tempfile.mkdtemp(prefix="cl-json-")
    with open(os.path.join(folder, "a.json"), "w") as fh:
        json.dump(_variants(), fh, indent=2)
    _check(load_commits(spark, folder, fmt="json"))


def test_json_lines(spark):
    folder = tempfile.mkdtemp(prefix="cl-jsonl-")
    with open(os.path.join(folder, "a.jsonl"), "w") as fh:
        for rec in _variants():
            fh.write(json.dumps(rec) + "\n")
    _check(load_commits(spark, folder, fmt="jsonl"))


def test_dates_do_not_depend_on_session_zone(spark):
    folder = tempfile.mkdtemp(prefix="cl-tz-")
    with open(os.path.join(folder, "a.jsonl"), "w") as fh:
        fh.write(json.dumps(RECORD) + "\n")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        df = load_commits(spark, folder, fmt="jsonl")
        row = ops.weekday_commits(df).first()
        assert df.first().commit.committer.date == dt.datetime(2019, 1, 27, 7, 10, 0)
        assert row.day == 1  # 2019-01-27 is a Sunday in UTC (Monday in Tokyo)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_normalise_zone_aware_timestamps(spark):
    schema = T.StructType([T.StructField("commit", T.StructType([
        T.StructField("author", T.StructType([T.StructField("date", T.TimestampType())])),
        T.StructField("committer", T.StructType([T.StructField("date", T.TimestampType())])),
    ]))])
    instant = dt.datetime(2019, 1, 27, 7, 10, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([((((instant,), (instant,))),)], schema)
    out = normalise_dates(df).first()
    assert out.commit.committer.date == dt.datetime(2019, 1, 27, 7, 10)


def test_parquet_roundtrip_and_pruning(spark):
    path = tempfile.mkdtemp(prefix="cl-pq-") + "/commits"
    commits_view(spark, f"{TESTDATA}/sf0.001").write.parquet(path)
    df = load_commits(spark, path, fmt="parquet")
    assert df.schema.simpleString() == COMMIT.simpleString()
    assert df.count() == spark.read.parquet(f"{TESTDATA}/sf0.001/orders.parquet").count()
    plan = df.select(F.col("commit.committer.name")).where(F.col("commit.committer.name") == "GitHub")
    summary = summarize(plan)
    assert summary.read_schemas == ["struct<commit:struct<committer:struct<name:string>>>"]
    assert "EqualTo(commit.committer.name,GitHub)" in str(summary.pushed_filters)


def test_stream_matches_batch(spark):
    folder = tempfile.mkdtemp(prefix="cl-stream-")
    view = commits_view(spark, f"{TESTDATA}/sf0.001", with_files=False)
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    view.withColumn("commit", F.col("commit").withField(
        "committer.date", F.date_format("commit.committer.date", iso)).withField(
        "author.date", F.date_format("commit.author.date", iso))).write.json(folder + "/in")
    stream = stream_commits(spark, folder + "/in", fmt="jsonl")
    query = (
        ops.weekly_commits(stream).writeStream.outputMode("complete").format("memory")
        .queryName("weekly_stream_test").option("checkpointLocation", folder + "/ckpt").start()
    )
    try:
        query.processAllAvailable()
        got = sorted(tuple(r) for r in spark.sql("select * from weekly_stream_test").collect())
    finally:
        query.stop()
    want = sorted(tuple(r) for r in ops.weekly_commits(view).collect())
    assert got == want


def test_stream_runs_listed_operators(spark):
    folder = tempfile.mkdtemp(prefix="cl-stream2-")
    view = commits_view(spark, f"{TESTDATA}/sf0.001", with_files=True)
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    view.withColumn("commit", F.col("commit").withField(
        "committer.date", F.date_format("commit.committer.date", iso)).withField(
        "author.date", F.date_format("commit.author.date", iso))).write.json(folder + "/in")
    stream = stream_commits(spark, folder + "/in", fmt="jsonl", max_files_per_trigger=2)
    cases = {
        "cl_count": (ops.commit_count(stream), "complete", ops.commit_count(view)),
        "cl_ext": (ops.file_extensions(stream), "update", ops.file_extensions(view)),
        "cl_stats": (ops.committer_repo_stats(stream), "update", ops.committer_repo_stats(view)),
        "cl_delay": (ops.commit_delay(stream).select("sha", "commit_time_diff"), "append",
                     ops.commit_delay(view).select("sha", "commit_time_diff")),
    }
    for name, (query_df, mode, batch) in cases.items():
        query = (
            query_df.writeStream.outputMode(mode).format("memory").queryName(name)
            .option("checkpointLocation", f"{folder}/ckpt-{name}").start()
        )
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        got = spark.sql(f"select * from {name}")
        if mode == "update":
            # later updates of a key replace earlier ones: keep the largest count
            keys = [c for c in got.columns if c not in ("n", "total", "additions", "deletions")]
            got = got.groupBy(*keys).agg(*[F.max(c).alias(c) for c in got.columns if c not in keys])
        assert sorted(tuple(r) for r in got.select(*batch.columns).collect()) == \
            sorted(tuple(r) for r in batch.collect()), name


def test_broken_json_records(spark):
    folder = tempfile.mkdtemp(prefix="cl-bad-")
    with open(os.path.join(folder, "a.jsonl"), "w") as fh:
        fh.write(json.dumps(RECORD) + "\nnot json\n" + json.dumps(RECORD) + "\n")
    assert load_commits(spark, folder, fmt="jsonl").count() == 3
    assert len(load_commits(spark, folder, fmt="jsonl", mode="DROPMALFORMED").select("sha").collect()) == 2
    kept = load_commits(spark, folder, fmt="jsonl", corrupt="_bad").cache()
    assert [r["_bad"] for r in kept.where("_bad IS NOT NULL").collect()] == ["not json"]
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        load_commits(spark, folder, fmt="jsonl", mode="FAILFAST").select("sha").collect()


@pytest.mark.parametrize("name", ["load_commits_json", "load_commits_jsonl"])
def test_source_query_built_twice(spark, name):
    import __spark_entry__ as registry

    first, again = (registry.commit_queries()[name](spark, f"{TESTDATA}/sf0.001") for _ in range(2))
    assert sorted(map(tuple, first.select("sha").collect())) == sorted(map(tuple, again.select("sha").collect()))


def test_parquet_stream_with_zone_aware_dates(spark):
    folder = tempfile.mkdtemp(prefix="cl-tzstream-")
    view = commits_view(spark, f"{TESTDATA}/sf0.001", with_files=False).limit(20)
    aware = view.withColumn("commit", F.col("commit").withField(
        "committer.date", F.col("commit.committer.date").cast("timestamp")))
    aware.write.parquet(folder + "/in")
    stream = stream_commits(spark, folder + "/in", fmt="parquet")
    assert dict(stream.select("commit.committer.date").dtypes)["date"] == "timestamp_ntz"
    query = ops.commit_count(stream).writeStream.outputMode("complete").format("memory").queryName("aware").start()
    try:
        query.processAllAvailable()
        assert spark.sql("select * from aware").first()[0] == 20
    finally:
        query.stop()


def test_lines_come_through_the_shuffle_as_they_were(spark, tmp_path):
    """Small values of a line travel in one number where they fit; others as they are."""
    lines = [(1, 7, n, q, flag) for n, q, flag in [(1, 3.9, "A"), (15, 0.0, "R"), (16, 5.0, "N"), (-1, 6.0, "X"), (3, -2.5, None), (4, 1e15, "A"), (None, 8.0, "R"), (6, None, "N")]]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(7, "a b")], "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(1, 2, 1234.5), (2, 2, None)], "o_orderkey long, o_custkey long, o_totalprice double").withColumn("o_orderdate", F.lit("1995-01-01").cast("timestamp_ntz")).write.parquet(str(tmp_path / "orders.parquet"))
    view = commits_view(spark, str(tmp_path))
    one, two = view.orderBy("_id").collect()
    kinds = {"A": "added", "R": "removed", "N": "modified"}
    key = lambda x: tuple((v is not None, v) for v in x)
    want = [(None if q is None else int(q), kinds.get(flag)) for _, _, _, q, flag in lines]
    assert sorted([(f.additions, f.status) for f in one.files], key=key) == sorted(want, key=key)
    names = {f.additions: f.filename for f in one.files}
    assert (names[3], names[None], names[5], names[6], names[-2], names[10**15]) == ("a_b.scala", "a_b.", None, None, "a_b", ".a_b")
    shas = {hashlib.sha1(f"f1-{n}-7".encode()).hexdigest() for _, _, n, _, _ in lines if n is not None} | {None}
    assert {f.sha for f in one.files} == shas
    assert (one.stats.additions, two.stats.additions, two.files) == (1234 % 500, None, [])
    sent = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan_text(view))
    assert sum("l_packed#" in x for x in sent) >= 1 and not any("o_totalprice#" in x for x in sent)
