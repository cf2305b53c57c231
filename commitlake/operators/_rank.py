"""Global 0-based position of rows in a total order, without one task.

``row_number().over(Window.orderBy(...))`` moves every row into a single
task (``Exchange SinglePartition``). This is the DataFrame form of
``sortBy(...).zipWithIndex()``:

1. range-partition the rows on the order keys into ``partitions`` parts
   (Spark samples the keys for the bounds, so parts are balanced when the
   keys are distinct) and sort inside each part;
2. record the part number and the position inside the part, and write that
   to the checkpoint folder, so every later reader sees the same numbers
   (a recomputation after a lost executor reads the checkpoint);
3. count the rows per part: a table of at most ``partitions`` rows, whose
   running total gives each part's offset; it is broadcast (size bound:
   the number of parts, fixed by the caller);
4. position = offset of the part + position inside the part.

The order keys must make the order total (e.g. end with a unique name);
otherwise equal keys get arbitrary, though still unique, positions, and a
key shared by many rows cannot be split across parts. A part may hold up to
2^33 rows (the position inside it is the low 33 bits of
``monotonically_increasing_id``); choose ``partitions`` so that rows / parts
stays far below that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlake.session import ensure_checkpoint_dir

# Position inside a part is the low 33 bits of monotonically_increasing_id().
_LOCAL_BITS = 33


def global_position(
    df: DataFrame, order: Sequence[Column], name: str = "position", partitions: int | None = None
) -> DataFrame:
    """``df`` plus ``name`` (bigint, 0-based) following ``order``.

    Eager: the ranged rows are checkpointed when this is called.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn(
            "_local",
            F.monotonically_increasing_id() - F.shiftleft(F.col("_part").cast("bigint"), _LOCAL_BITS),
        )
        .checkpoint(eager=True)
    )
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(
        "_part",
        F.coalesce(
            F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_offset"),
    )
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop("_part", "_local", "_offset")
    )


def rank_by_count(
    df: DataFrame, name: str, count: str, rank: str = "rank", partitions: int | None = None
) -> DataFrame:
    """Add ``rank`` (bigint, 0 = largest count) to one-row-per-name ``df``.

    Ties on the count are broken by ``lower(name)`` and then by ``name``,
    NULL names first; names are unique, so the order is total.
    """
    order = [F.desc(count), F.asc_nulls_first(F.lower(F.col(name))), F.asc_nulls_first(name)]
    return global_position(df, order, rank, partitions)
