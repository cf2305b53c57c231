"""Benchmark decontamination.

A window is ``n`` consecutive normalised words of a benchmark item; an item
with fewer words, but not none, is one window. The windows form a hash set
that is broadcast to the tasks; each task slides over the words of its whole
texts, looks window fingerprints up and verifies every hit word by word. A
document word inside any occurrence of a window is hit.

Size of what is broadcast: at most ``max_windows`` windows of at most ``n``
words at a time. A larger benchmark is dealt into blocks of that size by a
hash of the window, and the corpus is scanned once for each block; the hits
of the blocks are joined into one result, so nothing is left out.

Defined results: a null or empty text has no words and no hits; words are
runs of bytes that are ASCII letters, digits or not ASCII, with A-Z
lower-cased; rows that repeat are judged one by one; an item without words
gives no window; an item whose id is null still marks words but is not listed;
an empty benchmark hits nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlake.llm.common import cut, free_name, release, struct_array, text_bytes
from commitlake.llm.common import runs as run_of

#: Words of a window.
N = 10
#: Windows that are broadcast at once: some 50 MB at ten words.
MAX_WINDOWS = 200_000
#: Words that a task holds as an array at once.
_STRIDE = 1_000_000

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Maps word bytes to their lower-case form and all others to a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_RESULT = "n_words long, runs array<struct<first:long,last:long>>, items array<string>"
_SPANS = "array<struct<start:long,end:long>>"


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def windows(benchmark: DataFrame, n: int = N, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (window, item): the window as its words joined by spaces."""

    def cut_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wins = [], []
            for key, body in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                w = words(body)
                for i in range(max(len(w) - n, 0) + 1 if w else 0):
                    ids.append(key)
                    wins.append(b" ".join(w[i : i + n]))
            yield pa.RecordBatch.from_arrays([pa.array(wins, pa.binary()), pa.array(ids, pa.string())], ["win", "item"])

    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(cut_items, "win binary, item string").distinct()


class WindowIndex:
    """Windows of one block: words numbered, fingerprints sorted by length."""

    def __init__(self, rows: list[tuple[bytes, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        items: dict[bytes, list[str]] = {}
        for win, item in rows:
            own = items.setdefault(win, [])
            if item is not None:
                own.append(item)
        by_length: dict[int, list[bytes]] = {}
        for win in items:
            by_length.setdefault(win.count(b" ") + 1, []).append(win)
        self.lengths = []
        for length, wins in by_length.items():
            table = np.array(
                [[number(w, len(self.vocabulary)) for w in win.split(b" ")] for win in wins], np.int64
            ).reshape(len(wins), length)
            for seed in range(1, 1000):
                prints = fingerprints(table.T, seed)
                order = np.argsort(prints)
                if len(prints) < 2 or (np.diff(prints[order]) != 0).all():
                    break
            self.lengths.append((length, seed, prints[order], table[order], [items[wins[i]] for i in order]))


def fingerprints(columns, seed: int) -> np.ndarray:
    """64-bit values of windows given as one array for each word position."""
    factor = np.uint64(0x9E3779B97F4A7C15 + 2 * seed)
    total = np.full(len(columns[0]), seed, np.uint64)
    for c in columns:
        total = (total ^ c.astype(np.uint64)) * factor
        total ^= total >> np.uint64(29)
    return total


def scan(texts: list[bytes | None], index: WindowIndex) -> Iterator[tuple[int, list[tuple[int, int]], set[str]]]:
    """For each text: words, hit runs of word numbers (end exclusive), items."""
    at = 0
    while at < len(texts):
        ids, size = [], 0
        while at + len(ids) < len(texts) and size < _STRIDE:
            w = words(texts[at + len(ids)])
            ids.append(np.fromiter(map(index.vocabulary.get, w, repeat(-1)), np.int64, len(w)))
            size += len(w)
        yield from _scan_block(ids, index)
        at += len(ids)


def _scan_block(ids: list[np.ndarray], index: WindowIndex):
    gap = np.array([-1])
    flat = np.concatenate([x for own in ids for x in (own, gap)])
    ends = np.cumsum([len(x) + 1 for x in ids])
    starts = ends - [len(x) + 1 for x in ids]
    unknown = np.concatenate([[0], np.cumsum(flat < 0)])
    marks, found = np.zeros(len(flat) + 1, np.int64), [set() for _ in ids]
    for length, seed, prints, table, items in index.lengths:
        if len(flat) < length:
            continue
        at = np.flatnonzero(unknown[length:] == unknown[:-length])
        if not len(at):
            continue
        got = fingerprints([flat[at + j] for j in range(length)], seed)
        k = np.minimum(np.searchsorted(prints, got), len(prints) - 1)
        same = prints[k] == got
        at, k = at[same], k[same]
        same = (flat[at[:, None] + np.arange(length)] == table[k]).all(axis=1)
        at, k = at[same], k[same]
        np.add.at(marks, at, 1)
        np.add.at(marks, at + length, -1)
        doc = np.searchsorted(ends, at, side="right")
        for pair in np.unique(np.stack([doc, k], axis=1), axis=0) if len(at) else ():
            found[pair[0]].update(items[pair[1]])
    hit = np.cumsum(marks)[:-1] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    runs: list[list[tuple[int, int]]] = [[] for _ in ids]
    for first, last in edge.reshape(-1, 2).tolist():
        d = int(np.searchsorted(ends, first, side="right"))
        runs[d].append((first - int(starts[d]), last - int(starts[d])))
    for own, r, f in zip(ids, runs, found, strict=True):
        yield len(own), r, f


def _union(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted([*a, *b]):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _scanner(broadcast):
    """Arrow function of (text, hits so far) to hits with this block's added."""

    def hits(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, before in batches:
            n, runs, items = [], [], []
            found = (row for part in run_of(texts) for row in scan(text_bytes(part), broadcast.value))
            rows = zip(found, before.to_pylist(), strict=True)
            for (size, new, names), old in rows:
                if old:
                    new = _union(new, [(x["first"], x["last"]) for x in old["runs"]])
                    names = names | set(old["items"])
                n.append(size)
                runs.append([{"first": a, "last": b} for a, b in new])
                items.append(sorted(names))
            span = pa.struct([("first", pa.int64()), ("last", pa.int64())])
            yield struct_array(
                {
                    "n_words": pa.array(n, pa.int64()),
                    "runs": pa.array(runs, pa.list_(span)),
                    "items": pa.array(items, pa.list_(pa.string())),
                }
            )
        release()

    return F.arrow_udf(hits, _RESULT).asNondeterministic()


def with_hits(
    docs: DataFrame, benchmark: DataFrame, out: str, n: int = N, text: str = "text", max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, runs, items.

    Every registered window is looked for in every whole text.
    """
    spark = docs.sparkSession
    wins = cut(windows(benchmark, n))
    blocks = max(1, math.ceil(wins.count() / max_windows))
    block = F.pmod(F.xxhash64("win", "item"), F.lit(blocks))
    result = docs.withColumn(out, F.lit(None).cast(f"struct<{_as_fields(_RESULT)}>"))
    for b in range(blocks):
        rows = [(bytes(r.win), r.item) for r in wins.where(block == b).collect()]
        index = spark.sparkContext.broadcast(WindowIndex(rows))
        # each block's hits replace those so far; between blocks the lineage is
        # cut, so that a task holds one block's index at a time
        result = result.withColumn(out, _scanner(index)(F.col(text).cast("string"), F.col(out)))
        if b + 1 < blocks:
            result = cut(result)
    return result


def _as_fields(ddl: str) -> str:
    return ", ".join(f"{name}:{kind}" for name, kind in (x.split(" ", 1) for x in ddl.split(", ")))


def n_hit(hits: str):
    return F.aggregate(f"{hits}.runs", F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"])


def hit_spans(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code-point spans (end exclusive) of runs of word numbers."""
    at = [m.span() for m in _WORD.finditer(text)]
    return [
        (len(text[: at[a][0]].decode("utf-8", "replace")), len(text[: at[b - 1][1]].decode("utf-8", "replace")))
        for a, b in runs
    ]


def _span_udf():
    def spans(texts: pa.Array, runs: pa.Array) -> pa.Array:
        out = []
        for body, own in zip(text_bytes(texts), runs.to_pylist(), strict=True):
            at = hit_spans(body, [(r["first"], r["last"]) for r in own]) if own else []
            out.append([{"start": a, "end": b} for a, b in at])
        return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))

    return F.arrow_udf(spans, _SPANS)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, mode: str = "drop", n: int = N, max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """Clean documents, with the columns of ``docs``.

    ``mode`` ``drop`` leaves contaminated documents out; ``cut`` keeps them and
    removes the hit spans from their text.
    """
    if mode not in ("drop", "cut"):
        raise ValueError(f"unknown mode {mode!r}")
    hits = free_name(docs.columns, "hits")
    found = with_hits(docs, benchmark, hits, n, max_windows=max_windows)
    if mode == "drop":
        return found.where(F.size(f"{hits}.runs") == 0).drop(hits)

    def without(texts: pa.Array, runs: pa.Array) -> pa.Array:
        out = []
        for body, own in zip(texts.to_pylist(), runs.to_pylist(), strict=True):
            for start, end in reversed(hit_spans(body.encode(), [(r["first"], r["last"]) for r in own])) if own else ():
                body = body[:start] + body[end:]
            out.append(body)
        return pa.array(out, pa.string())

    clean = F.arrow_udf(without, "string")
    return found.withColumn("text", clean(F.col("text").cast("string"), F.col(f"{hits}.runs"))).drop(hits)


def report(docs: DataFrame, benchmark: DataFrame, n: int = N, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, items and hit spans of every document row."""
    found = with_hits(docs.select("doc_id", "text"), benchmark, "hits", n, max_windows=max_windows)
    return found.select(
        "doc_id",
        "hits.n_words",
        n_hit("hits").alias("n_hit"),
        "hits.items",
        _span_udf()(F.col("text").cast("string"), F.col("hits.runs")).alias("spans"),
    )
