from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from commitlake.schema import COMMIT  # noqa: E402
from commitlake.session import LOCAL_CONF  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[*]").appName("commitlake-tests")
    for key, value in {**LOCAL_CONF, "spark.sql.shuffle.partitions": "8"}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="commitlake-test-ckpt-"))
    yield session
    session.stop()


def ts(text: str) -> dt.datetime:
    """A naive UTC datetime from ISO text."""
    return dt.datetime.fromisoformat(text)


def url(owner: str, repo: str, sha: str = "x") -> str:
    return f"https://api.github.com/repos/{owner}/{repo}/commits/{sha}"


def file(filename, sha="fs", status="modified", additions=1, deletions=0, patch=None):
    return (sha, filename, status, additions, deletions, additions + deletions, None, None, None, patch)


def commit(
    sha="s",
    url_=None,
    author="alice",
    committer=None,
    date="2019-01-01T00:00:00",
    authored=None,
    message="Fix",
    parents=(),
    stats=(0, 0, 0),
    files=(),
):
    """One commit row of the COMMIT schema; ``stats=None`` means missing."""
    committer = author if committer is None else committer
    cdate = ts(date) if isinstance(date, str) else date
    adate = cdate if authored is None else (ts(authored) if isinstance(authored, str) else authored)
    return (
        None,
        None,
        sha,
        url(author, "repo", sha) if url_ is None else url_,
        (
            (author, None, adate),
            (committer, None, cdate),
            message,
            (None,),
            0,
            (False, None),
        ),
        None,
        None,
        [(p,) for p in parents],
        None if stats is None else tuple(stats),
        list(files),
    )


@pytest.fixture
def commits(spark):
    def make(rows):
        return spark.createDataFrame(rows, COMMIT)

    return make
