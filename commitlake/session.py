"""Session helpers.

The library itself never creates a session: every operator is a plain
``DataFrame -> DataFrame`` function. These helpers are for tests, the bench
and small local runs. On a cluster, pass your own session and leave the
settings below to the cluster's defaults where they are already set.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every local run of this project uses. ``spark.sql.session.timeZone``
# only matters for frames whose dates are zone-aware ``timestamp``; the loaders
# of this package normalise dates to ``timestamp_ntz`` in UTC, see
# ``commitlake.schema.normalise_dates``.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "8g",
    # remove checkpoint files (the ranked parts of author_ranking) once the
    # frames that use them are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", app: str = "commitlake", **conf: str) -> SparkSession:
    """Create (or reuse) a session with the project's local settings."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``; that value is always
    used as it is. Only a local-mode session without the setting (one process,
    as in tests) gets a fresh folder of its own; elsewhere a missing setting is
    an error, because a machine-local folder is not reachable from other
    executors. Spark removes checkpoint files once their frames are gone where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on, as in
    ``LOCAL_CONF``; a cluster's session should set it too.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server") from None
        return configured
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for the cluster"
        )
    local = tempfile.mkdtemp(prefix="commitlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a written intermediate table below the checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
