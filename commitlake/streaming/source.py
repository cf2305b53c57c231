"""S0 for Structured Streaming: commits arriving as files in a folder.

The reference is batch-only; this is the same source as
``commitlake.sources.load_commits`` for ``readStream``, so operators that
are plain aggregations or row-wise columns can be kept up to date as new
commit files land:

* row-wise (append mode): ``commit_age``, ``commit_delay``;
* aggregations (complete or update mode): ``commit_count``,
  ``file_extensions``, ``user_stats``, ``weekly_commits``,
  ``weekday_commits``, ``committer_repo_stats``.

Operators built on non-time windows or on joins of the table with itself
(rankings, gaps, newest files, branch and fork points) are batch-only, as
Structured Streaming does not support those shapes.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from commitlake.schema import COMMIT, normalise_dates
from commitlake.sources.commits import read_json


def stream_commits(
    spark: SparkSession, path: str, fmt: str = "jsonl", max_files_per_trigger: int | None = None
) -> DataFrame:
    """A streaming DataFrame of commits from files appearing under ``path``."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt in ("json", "jsonl"):
        df = read_json(reader, path, fmt)
    elif fmt == "parquet":
        # a stream needs its schema beforehand: that of the files that are there
        # (whatever type their dates have), else the commit schema
        try:
            schema = spark.read.parquet(path).schema
        except AnalysisException:
            schema = COMMIT
        df = reader.schema(schema).parquet(path)
    else:
        raise ValueError(f"fmt must be json, jsonl or parquet, not {fmt!r}")
    return normalise_dates(df)
