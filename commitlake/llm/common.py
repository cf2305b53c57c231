"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.session import ensure_checkpoint_dir

#: ASCII white space: the bytes that ``[^\x20\x09-\x0D]+`` leaves out, and the
#: bytes that ``bytes.split()`` splits at.
SPACES = b" \t\n\x0b\x0c\r"
#: Bytes of texts that a task turns into Python objects at once.
RUN_BYTES = 4_000_000


#: Rows of an Arrow batch: texts are long, so Spark's own 10,000 are too many.
BATCH_ROWS = 2000


def prepare(spark: SparkSession) -> None:
    """Session settings of the Python tasks: small Arrow batches, unless the
    session has a setting of its own; and workers on this machine find the
    package wherever the session was started (on a cluster it is installed or
    shipped)."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if spark.sparkContext.master.startswith("local"):
        spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the session's shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Narrow rows that are broadcast at most (some 32 bytes each).
SMALL_ROWS = 500_000


def small(rows: DataFrame) -> DataFrame:
    """Checkpointed narrow rows, to be broadcast where a count shows that they are
    few (Spark knows no size of a checkpoint); where they are more, Spark joins
    by a shuffle."""
    return F.broadcast(rows) if rows.count() <= SMALL_ROWS else rows


def release() -> None:
    """Hands a task's memory back to the system: Python workers live on, and run the
    tasks of other stages beside the executor's own memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(_LIBC, "malloc_trim", None):  # glibc only
        trim(0)


_LIBC = ctypes.CDLL(None)


def text_bytes(texts: pa.Array) -> list:
    """UTF-8 bytes of each text (None stays None), without a detour over str."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return texts.cast(kind).to_pylist()


def runs(texts: pa.Array, size: int = RUN_BYTES) -> Iterator[pa.Array]:
    """The texts in slices of about ``size`` bytes (one longer text at least), so
    that a task holds few of a batch's texts as Python objects at once."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at, done = 0, 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield texts.slice(at, end - at)
        at, done = end, int(ends[end - 1])


def crc_mod(key, n: int) -> Column:
    """crc32 of a column's text form, modulo n (null for null)."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % n


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, lengthened until it clashes with no column in any case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def struct_array(fields: dict[str, pa.Array]) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
