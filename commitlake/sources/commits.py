"""Read commit records.

The records come as JSON (one pretty-printed document or array per file, or
JSON Lines) or as Parquet with the nested commit schema. JSON is always read
with the commit schema, so there is no inference pass over the data; Parquet
brings its own. Both dates come out as UTC ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlake.schema import COMMIT_JSON, normalise_dates
from commitlake.sources.json_ranges import record_texts

FORMATS = ("json", "json_ranges", "jsonl", "parquet")
MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def read_json(reader, path, fmt: str, mode: str = "PERMISSIVE", corrupt: str | None = None) -> DataFrame:
    """JSON commits by a batch or streaming reader (see ``load_commits``)."""
    schema = COMMIT_JSON if corrupt is None else T.StructType([*COMMIT_JSON.fields, T.StructField(corrupt, T.StringType())])
    reader = reader.schema(schema).option("mode", mode).option("multiLine", fmt == "json")
    if corrupt is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.json(path)


def read_json_ranges(spark: SparkSession, paths: list[str], mode: str = "PERMISSIVE", corrupt: str | None = None) -> DataFrame:
    """JSON commits of large files, each read in many tasks (see ``json_ranges``)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    names = [f.name for f in COMMIT_JSON.fields]
    bad = corrupt or "_corrupt"
    schema = COMMIT_JSON
    options = {"mode": "FAILFAST"}
    if mode != "FAILFAST":
        schema = T.StructType([*COMMIT_JSON.fields, T.StructField(bad, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    rows = record_texts(spark, paths).select(F.from_json("value", schema, options).alias("commit_row"))
    if mode == "DROPMALFORMED":
        rows = rows.where(F.col(f"commit_row.{bad}").isNull())
    if corrupt is not None:
        return rows.select(*(f"commit_row.{n}" for n in names), (F.col(f"commit_row.{bad}") if mode != "FAILFAST" else F.lit(None).cast("string")).alias(corrupt))
    return rows.select(*(f"commit_row.{n}" for n in names))


def load_commits(
    spark: SparkSession, path: str | list[str], fmt: str = "json", mode: str = "PERMISSIVE", corrupt: str | None = None
) -> DataFrame:
    """Load commits from ``path`` (a file, a folder or a list of either).

    ``fmt``:

    * ``"json"``: multi-line JSON. Spark reads each such file in one task: for
      many small files.
    * ``"json_ranges"``: the same for large files, which are split into tasks by
      byte ranges. A file that is not JSON loses only the records that are not,
      while ``"json"`` takes the whole file for one record.
    * ``"jsonl"``: one JSON object per line; files are split into tasks.
    * ``"parquet"``: nested Parquet; only the columns an operator uses are
      read, and filters on them reach the scan.

    Malformed dates, a missing ``stats`` and a missing ``files`` come out as
    NULL. ``mode`` says what a record that is not JSON becomes: a commit of
    NULLs, counted like others (``PERMISSIVE``), nothing (``DROPMALFORMED``) or
    an error (``FAILFAST``). With ``corrupt`` its text is kept in a column of
    that name.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt in ("json", "jsonl"):
        df = read_json(spark.read, paths, fmt, mode, corrupt)
    elif fmt == "json_ranges":
        df = read_json_ranges(spark, paths, mode, corrupt)
    elif fmt == "parquet":
        df = spark.read.parquet(*paths)
    else:
        raise ValueError(f"fmt must be one of {FORMATS}, not {fmt!r}")
    return normalise_dates(df)
