"""The nested commit schema and date normalisation.

One row is one commit as returned by the GitHub commits API: people, dates,
message, parents, change statistics and the touched files. Dates are held as
``timestamp_ntz`` in UTC wall-clock time, so that day, week and weekday
functions give the same answer under any session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_FIELDS = ("commit.author.date", "commit.committer.date")


def _commit_user(date_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("email", T.StringType()),
            T.StructField("date", date_type),
        ]
    )


USER = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("login", T.StringType()),
        T.StructField("avatar_url", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("site_admin", T.BooleanType()),
    ]
)

STATS = T.StructType(
    [
        T.StructField("total", T.LongType()),
        T.StructField("additions", T.LongType()),
        T.StructField("deletions", T.LongType()),
    ]
)

FILE = T.StructType(
    [
        T.StructField("sha", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("additions", T.LongType()),
        T.StructField("deletions", T.LongType()),
        T.StructField("changes", T.LongType()),
        T.StructField("blob_url", T.StringType()),
        T.StructField("raw_url", T.StringType()),
        T.StructField("contents_url", T.StringType()),
        T.StructField("patch", T.StringType()),
    ]
)

FILE_FIELDS = tuple(f.name for f in FILE.fields)

PARENT = T.StructType([T.StructField("sha", T.StringType())])


def commit_schema(date_type: T.DataType = T.TimestampNTZType()) -> T.StructType:
    """The full commit schema with the given type for the two dates."""
    commit_data = T.StructType(
        [
            T.StructField("author", _commit_user(date_type)),
            T.StructField("committer", _commit_user(date_type)),
            T.StructField("message", T.StringType()),
            T.StructField("tree", T.StructType([T.StructField("sha", T.StringType())])),
            T.StructField("comment_count", T.LongType()),
            T.StructField(
                "verification",
                T.StructType(
                    [
                        T.StructField("verified", T.BooleanType()),
                        T.StructField("reason", T.StringType()),
                    ]
                ),
            ),
        ]
    )
    return T.StructType(
        [
            T.StructField("_id", T.StringType()),
            T.StructField("node_id", T.StringType()),
            T.StructField("sha", T.StringType()),
            T.StructField("url", T.StringType()),
            T.StructField("commit", commit_data),
            T.StructField("author", USER),
            T.StructField("committer", USER),
            T.StructField("parents", T.ArrayType(PARENT)),
            T.StructField("stats", STATS),
            T.StructField("files", T.ArrayType(FILE)),
        ]
    )


# Canonical in-memory schema: dates as UTC wall-clock timestamp_ntz.
COMMIT = commit_schema(T.TimestampNTZType())
# Read schema for JSON: dates as text, parsed by ``normalise_dates``.
COMMIT_JSON = commit_schema(T.StringType())

def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())


def to_utc_ntz(value: Column, data_type: T.DataType) -> Column:
    """Turn a date column of any supported type into UTC ``timestamp_ntz``.

    * ``timestamp_ntz`` is taken as UTC wall-clock time already.
    * ``timestamp`` (an instant) is moved to UTC through its epoch
      microseconds, which does not depend on the session time zone.
    * text (ISO 8601, e.g. ``2019-01-27T07:09:13.000Z``) is parsed as an
      instant first; text that does not parse gives NULL, as a missing
      date does.
    """
    if isinstance(data_type, T.TimestampNTZType):
        return value
    if isinstance(data_type, T.StringType):
        value = F.try_to_timestamp(value)
    elif not isinstance(data_type, T.TimestampType):
        raise TypeError(f"unsupported date type {data_type.simpleString()}")
    return F.timestamp_add("MICROSECOND", F.unix_micros(value), _epoch_ntz())


def _field_type(schema: T.StructType, path: str) -> T.DataType | None:
    current: T.DataType = schema
    for part in path.split("."):
        if not isinstance(current, T.StructType) or part not in current.fieldNames():
            return None
        current = current[part].dataType
    return current


def normalise_dates(df: DataFrame) -> DataFrame:
    """Rewrite both commit dates as UTC ``timestamp_ntz`` in place."""
    commit = F.col("commit")
    changed = False
    for path in DATE_FIELDS:
        data_type = _field_type(df.schema, path)
        if data_type is None or isinstance(data_type, T.TimestampNTZType):
            continue
        inner = path.split(".", 1)[1]
        commit = commit.withField(inner, to_utc_ntz(F.col(path), data_type))
        changed = True
    return df.withColumn("commit", commit) if changed else df
