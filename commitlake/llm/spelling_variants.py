"""Spelling variants: words at edit distance one, and the form each goes to.

Method. A word is described by its length and by how many of its code points fall
into each of ``GROUPS`` letter groups. One edit changes this little: an inserted code
point is a surplus of one in one group, a deleted one a deficit of one, a replaced
one both. A trie arranges the words by their length, then by the counts of
successive groups. A search goes down it depth first and spends, level by level, a
budget of one surplus and one deficit; the words in the leaves that it reaches are
verified code point by code point.

In Spark. The upper levels of the trie are a table of nodes with counts, two groups
deeper in each round, until each node has ``LEAF`` words at most. Searches go down
these levels as joins, all of a round at once: a search that reaches a node of at
most ``LEAF`` words is dealt to it, any other goes on to the next level. Below such
a node the trie is built and searched in one task, for ``SEARCHES`` searches at a
time: a node that many searches reach is dealt out with as many copies of its
words. Words whose groups are all alike and that are more than ``LEAF`` are cut into
parts, and every search meets every part. So no task holds more than a block of
either side, and none is dropped. Every pair is found once: the search is made by
its shorter word, or between words of one length by the smaller one.

Defined results: see ``variants``; words with a null or a null count are left out; a
word that repeats counts with the sum of its counts; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.llm.common import cut, runs, small, text_bytes

#: Letter groups: code points by their remainder.
GROUPS = 16
#: The groups in the order of the trie's levels.
LEVELS = (5, 1, 9, 15, 14, 4, 2, 3, 8, 12, 13, 0, 7, 6, 10, 11)
#: Words of a node that one task searches, and searches at a time.
LEAF, SEARCHES = 20_000, 20_000
#: Words of a node of the task's own trie that are compared at once.
_FEW = 16
#: Distinct words that a task counts before it hands its counts on.
_COUNTED = 200_000


def count_words(docs: DataFrame, least_length: int = 6, slips: int | None = 199) -> DataFrame:
    """word, n: the maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of all whole texts, A-Z
    lower-cased, of at least ``least_length`` code points.

    ``slips``: where it divides h, the crc32 of ``<doc_id>:<run>``, the run loses its
    code point h % length (None: no run does; a null id: none of its document's).
    Counted in the tasks first, then by word.
    """

    long_runs = re.compile(f"[a-zÀ-ÿ]{{{max(least_length, 1)},}}").findall

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            at = 0
            for part in runs(batch.column(1)):
                for body in text_bytes(part):
                    if body:
                        _count(counts, body, ids[at])
                    at += 1
                if len(counts) > _COUNTED:
                    yield _rows(counts)
                    counts = Counter()
        yield _rows(counts)

    def _count(counts: Counter, body: bytes, key: str | None) -> None:
        own = Counter(long_runs(body.lower().decode()))  # shorter runs give no word
        slipped = []
        if slips and key is not None:
            begin = zlib.crc32(f"{key}:".encode())
            for word in [w for w in own if not zlib.crc32(w.encode(), begin) % slips]:
                at = zlib.crc32(word.encode(), begin) % len(word)
                slipped.append((word[:at] + word[at + 1 :], own.pop(word)))
        counts.update(own)
        for word, n in slipped:
            if len(word) >= least_length:
                counts[word] += n

    def _rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    texts = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vectors(words: list[str]) -> np.ndarray:
    """A row for each word: how many of its code points are in each group, by level."""
    sizes = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    level = np.argsort(LEVELS)[points % GROUPS]
    at = np.repeat(np.arange(len(words)), sizes) * GROUPS + level
    out = np.bincount(at, minlength=len(words) * GROUPS).reshape(-1, GROUPS)
    return out.astype(np.int16) if sizes.max(initial=0) < 1 << 14 else out


def _counts(word: Column) -> Column:
    """The counts of the trie's levels, as an array."""

    def build(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for words in batches:
            yield pa.array(list(vectors(words.to_pylist()).astype(np.int32)), pa.list_(pa.int32()))

    return F.arrow_udf(build, "array<int>").asNondeterministic()(word)


#: What a search may still spend: (deficit, surplus) by what it looks for. A word of
#: one code point more has a surplus; one of the same length may have both.
_LONGER, _SAME = 1, 0


def near_pairs(words: DataFrame, leaf: int = LEAF, searches: int = SEARCHES) -> DataFrame:
    """a, b: pairs of distinct words of ``words`` (column word, distinct) that differ
    by one inserted, deleted or replaced code point, each pair once."""
    rows = cut(words.select("word", F.length("word").alias("size"), _counts(F.col("word")).alias("v")))
    step = 2
    index = rows.select("word", "v", F.xxhash64("size").alias("node"))
    # a search: what it has left of its budget, and the node that it has reached
    longer = F.explode(F.array(F.lit(_SAME), F.lit(_LONGER))).alias("longer")
    open_ = rows.select("word", "v", "size", longer).select(
        "word", "v", "longer", F.lit(1).alias("more"), (1 - F.col("longer")).alias("less"),
        F.xxhash64(F.col("size") + F.col("longer")).alias("node"),
    )
    held, asked = [], []
    for depth in range(0, GROUPS + 1, step):
        sizes = cut(index.groupBy("node").agg(F.count("*").alias("m")))
        done = sizes.where(F.col("m") <= leaf) if depth < GROUPS else sizes
        done = small(done.select("node", F.ceil(F.col("m") / leaf).alias("parts")))
        held.append(index.join(done, "node").select("node", "word", "parts"))
        asked.append(open_.join(done, "node").select("node", "word", "longer", "parts"))
        deep = sizes.where(F.col("m") > leaf).select("node")
        if depth == GROUPS or deep.isEmpty():
            break
        deep = small(deep)
        index = index.join(deep, "node").select("word", "v", _below("node", depth, step, "v").alias("node"))
        open_ = _descend(open_.join(deep, "node"), depth, step)
    return _search(_union(held), _union(asked), searches)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _below(node: str, depth: int, step: int, v: str) -> Column:
    """The node below by the counts of the next ``step`` levels."""
    return F.xxhash64(F.col(node), *(F.col(v)[depth + i] for i in range(step)))


def _descend(open_: DataFrame, depth: int, step: int) -> DataFrame:
    """Searches at the next ``step`` levels: each way to spend what they have left."""
    ways = [(0, 0)]
    ways += [(i + 1, 0) for i in range(step)] + [(0, i + 1) for i in range(step)]
    ways += [(i + 1, j + 1) for i in range(step) for j in range(step) if i != j]
    # the level of the surplus and that of the deficit (0: none)
    spent = F.explode(F.array(*(F.struct(F.lit(i).alias("up"), F.lit(j).alias("down")) for i, j in ways)))
    out = open_.withColumn("s", spent).where("(s.up = 0 OR more > 0) AND (s.down = 0 OR less > 0)")
    counts = [
        F.col("v")[depth + i] + (F.col("s.up") == i + 1).cast("int") - (F.col("s.down") == i + 1).cast("int")
        for i in range(step)
    ]
    out = out.where(F.least(*counts) >= 0)
    return out.select(
        "word", "v", "longer",
        (F.col("more") - (F.col("s.up") > 0).cast("int")).alias("more"),
        (F.col("less") - (F.col("s.down") > 0).cast("int")).alias("less"),
        F.xxhash64("node", *counts).alias("node"),
    )


def _search(held: DataFrame, asked: DataFrame, searches: int) -> DataFrame:
    blocks = small(cut(asked.groupBy("node").agg(F.ceil(F.count("*") / searches).alias("asks"))))
    draw = F.xxhash64("word")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    side = ["node", "part", "ask", "longer", "word"]
    held = held.join(blocks, "node").withColumn("part", F.pmod(draw, F.col("parts"))).withColumn("ask", every("asks"))
    asked = asked.join(blocks, "node").withColumn("ask", F.pmod(draw, F.col("asks"))).withColumn("part", every("parts"))
    both = held.withColumn("longer", F.lit(-1)).select(side).unionByName(asked.select(side))
    both = both.select(F.xxhash64("node", "part", "ask").alias("cell"), "longer", "word")
    both = both.repartition("cell").sortWithinPartitions("cell", "longer")
    return both.mapInArrow(_cells, "a string, b string")


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells come one after the other, the words of a cell before its searches."""
    cell, words, found = None, {-1: [], _SAME: [], _LONGER: []}, ([], [])

    def close() -> None:
        for a, b in _pairs(words):
            found[0].append(a)
            found[1].append(b)

    for batch in batches:
        for own, kind, word in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != cell:
                close()
                cell, words = own, {-1: [], _SAME: [], _LONGER: []}
            words[kind].append(word)
        if len(found[0]) > 10_000:
            yield _edges(found)
            found = ([], [])
    close()
    yield _edges(found)


def _edges(found: tuple[list[str], list[str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in found], ["a", "b"])


def _pairs(words: dict[int, list[str]]) -> Iterator[tuple[str, str]]:
    held = words[-1]
    if not held:
        return
    trie = vectors(held)
    for kind in (_SAME, _LONGER):
        asked = words[kind]
        if not asked:
            continue
        v = vectors(asked)
        less = np.full(len(asked), 1 - kind)
        ask, own = _descend_all(trie, v, np.ones(len(asked), np.int64), less)
        for a, b in verified(asked, held, ask, own, kind):
            if kind == _LONGER or a < b:
                yield a, b


def _descend_all(trie: np.ndarray, v: np.ndarray, more: np.ndarray, less: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Searches and words whose vectors fit: all searches go down the trie together,
    each node keeping those whose budget reaches it."""
    order = np.lexsort(trie.T[::-1])
    trie = trie[order]
    ask, own = [], []
    stack = [(0, len(trie), 0, np.arange(len(v)), more, less)]
    while stack:
        first, last, level, alive, more, less = stack.pop()
        if not len(alive):
            continue
        if level == GROUPS or last - first <= _FEW:
            # a leaf: what is left of the vectors, at once
            at, w = level, np.arange(first, last)
            for some in range(0, len(alive), 4096):
                part = slice(some, some + 4096)
                change = trie[first:last, at:][None, :, :] - v[alive[part], at:][:, None, :]
                up, down = np.maximum(change, 0).sum(axis=2), np.maximum(-change, 0).sum(axis=2)
                s, t = np.nonzero((up <= more[part, None]) & (down <= less[part, None]))
                ask.append(alive[part][s])
                own.append(order[w[t]])
            continue
        column = trie[first:last, level]
        edges = np.concatenate([[0], np.flatnonzero(column[1:] != column[:-1]) + 1, [len(column)]])
        mine = v[alive, level]
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            change = int(column[i]) - mine
            reach = np.flatnonzero((change <= more) & (-change <= less))
            if len(reach):
                c = change[reach]
                stack.append(
                    (first + i, first + j, level + 1, alive[reach], more[reach] - np.maximum(c, 0), less[reach] + np.minimum(c, 0))
                )
    none = np.empty(0, np.int64)
    return (np.concatenate(ask), np.concatenate(own)) if ask else (none, none)


def _points(words: list[str]) -> np.ndarray:
    """A row of code points for each word, filled up with zeros."""
    sizes = np.array([len(w) for w in words], np.int64)
    out = np.zeros((len(words), int(sizes.max(initial=0)) + 1), np.uint32)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return out


def verified(asked: list[str], held: list[str], ask: np.ndarray, own: np.ndarray, longer: int) -> Iterator[tuple[str, str]]:
    """The pairs (asked[i], held[j]) that one edit turns into each other; the held word
    has ``longer`` code points more."""
    sizes = [np.array([len(w) for w in words], np.int64) for words in (asked, held)]
    fits = sizes[1][own] - sizes[0][ask] == longer
    ask, own = ask[fits], own[fits]
    a, b = _points(asked), _points(held)
    width = max(a.shape[1], b.shape[1]) + 1
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    block = max(1, 4_000_000 // width)
    for at in range(0, len(ask), block):
        i, j = ask[at : at + block], own[at : at + block]
        differ = a[i] != b[j]
        if longer:  # equal up to the first difference, and from there on shifted by one
            before = np.logical_or.accumulate(differ, axis=1)
            hit = ~(before[:, :-1] & (a[i, :-1] != b[j, 1:])).any(axis=1)
        else:
            hit = differ.sum(axis=1) == 1
        for x, y in zip(i[hit].tolist(), j[hit].tolist(), strict=True):
            yield asked[x], held[y]


def variants(words: DataFrame, times: int = 5, leaf: int = LEAF, searches: int = SEARCHES) -> DataFrame:
    """word, n, n_near, form, form_n, root for each word of ``words`` (word, n).

    Two words are near if they differ by one inserted, deleted or replaced code
    point. ``form``: the near word of largest n (ties: smallest by code points), if
    that n is at least ``times`` the word's own, else null; ``root``: the word that
    the forms lead to, the word itself without one. ``times`` is 2 or more, so
    that forms make no circle.
    """
    if times < 2:
        raise ValueError("times must be 2 or more")
    known = words.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    known = cut(known)
    pairs = cut(near_pairs(known.select("word"), leaf, searches))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(known.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b")
    best = F.min(F.struct((-F.col("n_b")).alias("m"), F.col("b").alias("b"))).alias("best")
    near = near.groupBy("a").agg(F.count("*").alias("n_near"), best)
    found = known.join(near.withColumnRenamed("a", "word"), "word", "left")
    formed = -F.col("best.m") >= times * F.col("n")
    found = cut(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best.b")).alias("form"), F.when(formed, -F.col("best.m")).alias("form_n"),
        )
    )
    roots = _roots(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def _roots(steps: DataFrame) -> DataFrame:
    """word, root: a word's root becomes its root's root until none has one."""
    steps = cut(steps)
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = cut(steps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        steps = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return steps
