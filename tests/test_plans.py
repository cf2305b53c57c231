"""Plan shape: what each registered query reads, pushes down and shuffles.

Checked on a materialised nested Parquet commit table with broadcast joins
off, i.e. the shape the plans have when the inputs are large.
"""

from __future__ import annotations

import re
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as registry
from commitlake.plans import plan_text, summarize
from commitlake.sources import commits_view, load_commits

from conftest import TESTDATA

# Queries with exactly one SinglePartition exchange, and why it is bounded:
#   commit_count   - final step of a global count (one partial row per task)
#   author_ranking - running total over the part sizes (one row per part)
SINGLE_PARTITION = {"commit_count": 1, "author_ranking": 1}


@pytest.fixture(scope="module")
def table(spark):
    path = tempfile.mkdtemp(prefix="cl-plan-") + "/commits"
    commits_view(spark, f"{TESTDATA}/sf0.001").write.parquet(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield load_commits(spark, path, fmt="parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", sorted(registry.OPERATOR_QUERIES))
def test_no_unscalable_nodes(table, name):
    _files, query = registry.OPERATOR_QUERIES[name]
    summary = summarize(query(table))
    assert not summary.flags["python_udf"], name
    assert not summary.flags["cartesian"], name
    assert not summary.flags["nested_loop"], name
    assert summary.single_partition == SINGLE_PARTITION.get(name, 0), name
    # With automatic broadcasts off, a broadcast in the plan is a hint in
    # the code; the only one allowed is the rank's table of part offsets
    # (as many rows as parts).
    if name != "author_ranking":
        assert summary.broadcasts == 0, name


def test_the_check_can_fail(table):
    numbered = table.select("sha", F.row_number().over(Window.orderBy("sha")).alias("rn"))
    assert summarize(numbered).single_partition == 1 and summarize(numbered).flags["single_partition"]
    mapped = table.select("sha").mapInPandas(lambda it: it, "sha string")
    grouped = table.select("sha").groupBy("sha").applyInPandas(lambda d: d, "sha string")
    assert summarize(mapped).flags["python_udf"] and summarize(grouped).flags["python_udf"]
    pairs = table.select("sha").crossJoin(table.select("url"))
    assert summarize(pairs).flags["cartesian"] or summarize(pairs).flags["nested_loop"]


def _q(table, name):
    return registry.OPERATOR_QUERIES[name][1](table)


def test_filters_reach_the_scan(table):
    assert "In(commit.author.name" in str(summarize(_q(table, "user_stats")).pushed_filters)
    assert "StringStartsWith(commit.message,Revert)" in str(summarize(_q(table, "revert_streaks")).pushed_filters)
    assert "EqualTo(commit.committer.name,GitHub)" in str(
        summarize(_q(table, "commits_by_committer")).pushed_filters
    )


READS = {
    "commit_count": ["struct<>"],
    "file_extensions": ["struct<files:array<struct<filename:string>>>"],
    "weekday_commits": ["struct<commit:struct<committer:struct<date:timestamp_ntz>>>"],
    "file_commits": ["struct<sha:string,url:string,files:array<struct<filename:string>>>"],
    "file_history": ["struct<url:string,files:array<struct<filename:string,additions:bigint,deletions:bigint>>>"],
    "latest_files": [
        "struct<sha:string,url:string,commit:struct<committer:struct<date:timestamp_ntz>>,"
        "files:array<struct<sha:string,filename:string,status:string,additions:bigint>>>",
        "struct<url:string,files:array<struct<filename:string>>>",
    ],
    "commit_gaps": [
        "struct<sha:string,url:string,commit:struct<committer:struct<name:string,date:timestamp_ntz>>>"
    ],
    "branch_points": ["struct<parents:array<struct<sha:string>>>", "struct<sha:string>"],
}


@pytest.mark.parametrize("name", sorted(READS))
def test_nested_columns_are_pruned(table, name):
    assert sorted(set(summarize(_q(table, name)).read_schemas)) == sorted(READS[name])


def test_branch_points_join_adds_no_shuffle(table):
    # two aggregations hash-partitioned on sha; the join reuses both
    summary = summarize(_q(table, "branch_points"))
    assert summary.exchanges == 2 and summary.hash_exchanges == 2


def test_latest_files_limits_before_the_shuffle(table):
    text = plan_text(_q(table, "latest_files"))
    tree = text.split("\n\n", 1)[0]
    below_exchange = tree.split("Exchange", 1)[1]
    assert "WindowGroupLimit" in below_exchange


def test_commit_gaps_windows_only_days_and_copies(table):
    text = plan_text(_q(table, "commit_gaps"))
    tree = text.split("\n\n", 1)[0]
    # the rows meet their days in joins by (committer, day); the window by
    # committer alone is over the aggregated days
    assert re.search(r"hashpartitioning\(_key#\d+, \d+\)", text)
    by_committer = re.findall(r"hashpartitioning\(_w\d+#\d+|hashpartitioning\(_key#\d+\.who", text)
    assert by_committer
    assert tree.count("SortMergeJoin") == 2
    assert summarize(_q(table, "commit_gaps")).range_exchanges == 1


def test_author_ranking_has_no_global_window(table):
    # positions come from a checkpointed range partitioning; the only
    # single-partition step is the running total over the part sizes
    text = plan_text(_q(table, "author_ranking"))
    assert text.count("SinglePartition") == 1
    assert "BroadcastExchange" in text
    assert "row_number" not in text
