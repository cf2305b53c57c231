"""S0 for large files: a JSON array over many lines (or in one), read by byte ranges.

Spark's own multi-line JSON reader takes a file in one task. Here a file is read as
text in pieces that end at ``}``, so Spark splits it into byte ranges of
``spark.sql.files.maxPartitionBytes`` like any text file, on every storage that it
reaches. What a range starts with is not known to the task that reads it: it may be
in a string, where brackets mean nothing, or deep inside a record. So there are two
passes:

1. every range tells, for a start outside and a start inside a string, in which of
   the two it ends, by how much the depth of brackets has changed, and how low it went;
   a running total over a file's ranges, a row for each, then settles how each starts,
   and in which range the record that is open there has begun;
2. every range cuts out its records. The parts of a record that lies on several
   ranges are put together by the range that it begins in: two parts of a range
   at most leave their task.

Bounds: a task holds one record and one Arrow batch of pieces; a row for each range is
broadcast while they are few, beyond that ranges are dealt to their rows by a
shuffle. A compressed file is one range, as everywhere in Spark.

Defined results. A file holds an array of objects, or objects after one another; each
top-level object is a record. Other values in the array are no records. Text is UTF-8.
What follows the end of the array, and a file without objects, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.session import ensure_checkpoint_dir

#: Rows of ranges that are broadcast at most.
BROADCAST_RANGES = 100_000

#: What a byte may be outside of a string, or end it.
_QUOTE, _ESCAPE, _OBJECT, _ARRAY, _CLOSING = 1, 2, 3, 4, 5
_KIND = np.zeros(256, np.uint8)
_KIND[list(b'"\\{[}]')] = (_QUOTE, _ESCAPE, _OBJECT, _ARRAY, _CLOSING, _CLOSING)
_RANGE = "file long, start long"
_SUMMARY = f"{_RANGE}, first string, out_ends boolean, out_depth long, out_low long, in_ends boolean, in_depth long, in_low long"


def record_texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``value``: the text of each top-level object of the files."""
    # a piece is short: files are told apart by a hash, not by a path on every piece
    pieces = spark.read.text(paths, lineSep="}").select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    starts = pieces.mapInArrow(_summaries, _SUMMARY).groupBy("file").applyInPandas(_settle, f"{_RANGE}, inside boolean, depth long, base long, owner long")
    # cut: the first pass is over all of the files, and several jobs read its rows
    ensure_checkpoint_dir(spark)
    starts = starts.checkpoint(eager=True)
    few = starts.count() <= BROADCAST_RANGES
    if few:
        dealt = pieces.join(F.broadcast(starts), ["file", "start"])
    else:
        numbered = pieces.withColumn("piece", F.monotonically_increasing_id())
        dealt = numbered.join(starts, ["file", "start"]).repartition("file", "start").sortWithinPartitions("file", "start", "piece")
    cut = dealt.select("file", "start", "value", "inside", "depth", "base", "owner").mapInArrow(_records, "file long, owner long, start long, value string")
    whole = cut.where("owner IS NULL").select("value")
    # the parts of a record, by the range that it begins in
    parts = cut.where("owner IS NOT NULL").groupBy("file", "owner")
    parts = parts.agg(F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts"))
    joined = parts.select(F.concat_ws("", F.col("parts.value")).alias("value"))
    return whole.unionByName(joined)


def _brackets(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Positions and kinds of all brackets, whether the number of quotes before each is odd,
    and the number of quotes. A text ends at a bracket, so no escape reaches into the next."""
    kind = _KIND[text]
    at = np.flatnonzero(kind)
    kind = kind[at]
    escapes = at[kind == _ESCAPE]
    if len(escapes):
        # every other one of escapes in a row counts, from the first on
        first = np.concatenate([[True], np.diff(escapes) != 1])
        counts = (escapes - escapes[first][np.cumsum(first) - 1]) % 2 == 0
        stays = (kind != _ESCAPE) & ~((kind == _QUOTE) & np.isin(at, escapes[counts] + 1, assume_unique=True))
        at, kind = at[stays], kind[stays]
    quotes = np.cumsum(kind == _QUOTE)
    own = kind >= _OBJECT
    return at[own], kind[own], quotes[own] % 2 == 1, int(quotes[-1]) if len(quotes) else 0


def _texts(batches: Iterator[pa.RecordBatch], more: int = 0) -> Iterator[tuple]:
    """file, start, further columns and text of the pieces of a range in a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = (batch.column(i).to_numpy() for i in (0, 1))
        new = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        for at, end in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows], strict=True):
            pieces = batch.column(2).slice(at, end - at)
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, end - at], pa.int32()), pieces), "}")[0]
            yield (int(file[at]), int(start[at]), *(c[at].as_py() for c in batch.columns[3 : 3 + more]), text.as_buffer().to_pybytes() + b"}")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _SUMMARY.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
    own, first, odd, scans = None, None, False, ()

    def row() -> pa.RecordBatch:
        values = [*own, first, *(x for inside, (depth, low) in enumerate(scans) for x in (bool(inside) != odd, depth, low))]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    for file, start, text in _texts(batches):
        if own != (file, start):
            if own:
                yield row()
            # quotes so far; depth and its least for a start outside and a start inside a string
            own, first, odd, scans = (file, start), None, False, [(0, 0), (0, 0)]
        if first is None:
            first = text.lstrip(b"\xef\xbb\xbf \t\r\n")[:1].decode("latin-1") or None
        _, kind, after, quotes = _brackets(np.frombuffer(text, np.uint8))
        step = np.where(kind == _CLOSING, -1, 1)
        for inside, (depth, low) in enumerate(scans):
            depths = depth + np.cumsum(step[after == (bool(inside) != odd)])
            if len(depths):
                scans[inside] = int(depths[-1]), min(low, int(depths.min()))
        odd ^= quotes % 2 == 1
    if own:
        yield row()


def _settle(ranges):
    """How each range of a file starts: in a string or not, at which depth, and in which
    range the open record begins (null: none is open). ``base``: the records' depth."""
    ranges = ranges.sort_values("start")
    first = next((x for x in ranges["first"] if x is not None), None)
    base = 1 if first == "[" else 0
    inside, depth, owner, rows = False, 0, None, []
    for r in ranges.itertuples():
        rows.append((r.file, r.start, inside, depth, base, owner))
        kind = "in" if inside else "out"
        change, low = getattr(r, f"{kind}_depth"), getattr(r, f"{kind}_low")
        closed = owner is None or depth + low <= base
        inside, depth = bool(getattr(r, f"{kind}_ends")), depth + int(change)
        owner = None if depth <= base else r.start if closed else owner
    import pandas as pd

    out = pd.DataFrame(rows, columns=["file", "start", "inside", "depth", "base", "owner"])
    return out.astype({"owner": "Int64"})


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records (owner null), and for each range the end of the record that is open
    at its start and the beginning of the one that is open at its end."""
    own, inside, depth, base, owner, held, open_ = None, False, 0, 0, None, [], False
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        kinds = (("file", pa.int64()), ("owner", pa.int64()), ("start", pa.int64()), ("value", pa.string()))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, (_, k) in enumerate(kinds)], [n for n, _ in kinds])

    def close() -> None:
        if own and depth > base and any(held):
            out.append((own[0], own[1] if owner is None else owner, own[1], b"".join(held)))

    for file, start, is_inside, at_depth, at_base, open_in, text in _texts(batches, 4):
        if own != (file, start):
            close()
            own, inside, depth, base, owner, held = (file, start), is_inside, at_depth, at_base, open_in, []
            open_ = depth > base
        at, kind, after, quotes = _brackets(np.frombuffer(text, np.uint8))
        outside = after == inside
        at, kind = at[outside], kind[outside]
        depths = depth + np.cumsum(np.where(kind == _CLOSING, -1, 1))
        begins = (kind == _OBJECT) & (depths == base + 1)
        found = np.flatnonzero(begins | ((kind == _CLOSING) & (depths == base)))
        # ``owner``: the range before this one that the open record begins in
        begin = 0 if open_ else None
        for p, opens in zip(at[found].tolist(), begins[found].tolist(), strict=True):
            if opens:
                begin = p
            elif begin is not None:
                out.append((file, owner, start, b"".join(held) + text[begin : p + 1]))
                owner, held, begin = None, [], None
        if len(depths):
            depth = int(depths[-1])
        inside ^= quotes % 2 == 1
        open_ = depth > base and begin is not None
        if open_:
            held.append(text[begin:])
        if len(out) >= 1000:
            yield batch()
            out = []
    close()
    yield batch()
