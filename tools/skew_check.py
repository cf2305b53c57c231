"""Run the join/window operators on a deliberately skewed commit table.

Usage: python tools/skew_check.py [sf_dir]

The table is the commit view with:
* every third commit moved to committer ``hot`` on one calendar day,
* every third commit's first parent replaced by one hot parent sha,
* every other third without a committer date, at committer ``hot``,
* 20,000 extra copies of one commit (same sha, same repository) at the first
  instant of a day, and as many at a later instant,
* one commit of the hot committer in 20,000 forks (same sha and date).

Adaptive skew-join thresholds are scaled down to this data size. For each
operator the final plan is checked for skew-split shuffle reads, and the
event log (written to a fresh scratch folder) gives the largest and the
median task time of the heaviest stage.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from commitlake import operators as ops  # noqa: E402
from commitlake.session import build_session  # noqa: E402
from commitlake.sources import commits_view, load_commits  # noqa: E402


def skewed_table(spark, sf_dir: str, path: str) -> None:
    view = commits_view(spark, sf_dir, with_files=True)
    k = F.col("_id").cast("bigint")
    hot_day = F.timestamp_add("SECOND", k % 86000, F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))
    hot_parent = F.array(F.struct(F.sha1(F.lit("c1")).alias("sha")))
    moved = view.withColumn(
        "commit",
        F.when(
            k % 3 == 0,
            F.col("commit")
            .withField("committer.name", F.lit("hot"))
            .withField("committer.date", hot_day),
        ).otherwise(F.col("commit")),
    ).withColumn("parents", F.when(k % 3 == 1, hot_parent).otherwise(F.col("parents")))
    no_date = F.col("commit").withField("committer.name", F.lit("hot")).withField(
        "committer.date", F.lit(None).cast("timestamp_ntz")
    )
    moved = moved.withColumn("commit", F.when(k % 3 == 2, no_date).otherwise(F.col("commit")))
    many = spark.range(20000).withColumnRenamed("id", "_c")

    def times(rows, at: str):
        date = F.lit(at).cast("timestamp_ntz")
        hot = F.col("commit").withField("committer.name", F.lit("hot")).withField("committer.date", date)
        return rows.withColumn("commit", hot).crossJoin(F.broadcast(many))

    one = moved.where(k == 1)
    first = times(one, "1999-01-01 00:00:00").drop("_c")
    early = one.withColumn("sha", F.lit("0"))
    early = early.withColumn("commit", F.col("commit").withField("committer.name", F.lit("hot")).withField(
        "committer.date", F.lit("1999-02-01 00:00:00").cast("timestamp_ntz")))
    later = times(one, "1999-02-01 12:00:00").drop("_c")
    fork = F.concat(F.lit("https://api.github.com/repos/o"), F.col("_c").cast("string"), F.lit("/r/commits/x"))
    forks = times(one, "1999-03-01 00:00:00").withColumn("url", fork).drop("_c")
    moved.unionByName(first).unionByName(early).unionByName(later).unionByName(forks).write.parquet(path)


def stage_task_times(log_dir: str) -> tuple[dict[int, list[float]], dict[int, str]]:
    """Task durations per stage, and the job group (query name) of each stage."""
    times: dict[int, list[float]] = {}
    group: dict[int, str] = {}
    for name in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(name) or name.endswith(".crc") or "appstatus" in name:
            continue
        with open(name) as fh:
            for line in fh:
                event = json.loads(line)
                kind = event.get("Event")
                if kind == "SparkListenerTaskEnd":
                    info = event["Task Info"]
                    times.setdefault(event["Stage ID"], []).append(
                        (info["Finish Time"] - info["Launch Time"]) / 1000.0
                    )
                elif kind == "SparkListenerJobStart":
                    label = (event.get("Properties") or {}).get("spark.jobGroup.id", "setup")
                    for stage in event.get("Stage IDs", []):
                        group[stage] = label
    return times, group


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="skew-")
    log_dir = os.path.join(scratch, "events")
    os.makedirs(log_dir)
    spark = build_session(
        app="commitlake-skew",
        **{
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            "spark.sql.shuffle.partitions": "16",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        },
    )
    path = os.path.join(scratch, "commits")
    skewed_table(spark, sf_dir, path)
    commits = load_commits(spark, path, fmt="parquet")
    print("rows", commits.count(), file=sys.stderr)
    runs = {
        "commit_gaps": lambda: ops.commit_gaps(commits),
        "commits_by_committer": lambda: ops.commits_by_committer(commits, ["hot"]),
        "fork_points": lambda: ops.fork_points(commits),
        "branch_points": lambda: ops.branch_points(commits),
        "latest_files": lambda: ops.latest_files(commits, fields=("filename", "sha")),
        "author_ranking": lambda: ops.author_ranking(commits),
        "repo_committers": lambda: ops.repo_committers(commits),
    }
    for name, make in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        df = make()
        t0 = time.perf_counter()
        # Count through the query's own execution: no rows travel to Python,
        # and the same adaptive plan is finalised, so it can be read after.
        execution = df._jdf.queryExecution()
        rows = execution.toRdd().count()
        elapsed = time.perf_counter() - t0
        plan = execution.executedPlan().toString()
        print(
            json.dumps(
                {
                    "query": name,
                    "rows": rows,
                    "sec": round(elapsed, 2),
                    "skew_split_reads": plan.count("skewed"),
                    "single_partition": plan.count("SinglePartition"),
                }
            )
        )
    spark.stop()
    times, group = stage_task_times(log_dir)
    per_query: dict[str, list[tuple[int, list[float]]]] = {}
    for stage, ts in times.items():
        per_query.setdefault(group.get(stage, "setup"), []).append((stage, ts))
    for name in runs:
        stages = per_query.get(name, [])
        if not stages:
            continue
        stage, ts = max(stages, key=lambda st: max(st[1]))
        print(
            json.dumps(
                {
                    "query": name,
                    "stages": len(stages),
                    "slowest_stage": stage,
                    "tasks": len(ts),
                    "max_task_sec": round(max(ts), 3),
                    "median_task_sec": round(statistics.median(ts), 3),
                }
            )
        )


if __name__ == "__main__":
    main()
