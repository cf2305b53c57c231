"""N-gram Jaccard join by set-relation skipping.

A document's set holds its distinct ``n``-word shingles as 64-bit hashes. Two
documents are linked when ``100 * intersection >= percent * union``. The result
is each document's connected component.

Index lists by position, with block skip. A set is ordered by hash and cut, by
position in the hash space, into ``d + 1`` blocks, d being the largest
symmetric difference of two linked sets of its size class. Linked sets differ
in at most d shingles, so at least one block is the same in both: a block's
content is the key of an index list, and all blocks in which two sets differ
are skipped unread. Common shingles cause no long lists, as a list is shared
only by sets that agree in a whole block. Empty blocks agree in many sets that have
nothing in common: there are some more blocks than d + 1, and a set with more filled
blocks than a linked set can differ in is not listed by its empty ones, as one of the filled ones is
the same too. Size classes grow by a half; a set
that may be linked into the next class is listed there too. Sets alike have one
entry.

Answers from a similar set's answers. All lists with the same smallest member,
their leader, are worked on together. Each member is first compared with its
leader alone, which gives the first components. Members in their leader's component
have their answers from the leader's: pairs among them are skipped. A member
outside is compared with the members of about its size, in bounded blocks of sets, so the
work of a very large group of near copies is dealt out over many tasks and no pair
list is made. Every comparison runs twice: first by parities, a bit for each shingle or two,
which tell whether the shingles that fall on it are even or odd in number: two sets differ in as many
shingles at least as their parities differ in bits, so sets that differ in too many are skipped
without being read. Only what is left meets as whole sets.

Defined results: words are runs of ``[^\\x20\\x09-\\x0D]`` with A-Z lower-cased; a
text of fewer words than ``n`` is one shingle; a null or empty text, or one
without words, has an empty set and is linked with nothing; rows with one id
that are not linked count as the documents they are, and a component's id is the
smallest id in it (null where it has none); an empty table gives no rows.
Shingles and sets are told apart by 64- and 128-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commitlake.llm.common import cut, free_name, mix64, release, runs, small, struct_array, text_bytes

N = 3
PERCENT = 90
#: Sets of one block of comparisons; of parities, which are small, so many times more.
BLOCK, PARITIES = 256, 32
#: Words whose hashes a task remembers.
_WORDS = 200_000
#: A list is hot from a share of 1 / _HOT of the sampled rows on, and ``_RARE`` rows.
_HOT, _RARE, _SAMPLED = 100_000, 50, 64
_SET = "n long, h1 long, h2 long, parity binary"


class Rule(NamedTuple):
    n: int = N
    percent: int = PERCENT

    def classes(self, upto: int) -> list[int]:
        """First sizes of the size classes."""
        first, step = [1], 1
        while first[-1] <= upto:
            step = max(first[-1] + 1, first[-1] * 3 // 2)
            first.append(step)
        return first

    def differ(self, size: int) -> int:
        """Largest symmetric difference of two linked sets of at most ``size``:
        x + y - 2 o with o >= percent / (100 + percent) * (x + y)."""
        return 2 * size * (100 - self.percent) // (100 + self.percent)

    def differs_from(self, size: int, most: int) -> int:
        """Largest symmetric difference of a set of ``size`` and a linked one of at most
        ``most``."""
        return (size + min(100 * size // self.percent, most)) * (100 - self.percent) // (100 + self.percent)

    def blocks(self, most: int) -> int:
        """Blocks of a class with sets of at most ``most`` shingles: one more than linked
        sets can differ in, and as many as are likely to be empty in a set."""
        least = self.differ(most) + 1
        empty = least * math.exp(-most / least)
        return least + math.ceil(empty + 3 * math.sqrt(empty))

    def linked(self, both, sizes):
        """Whether sets with ``sizes`` shingles together share ``both``."""
        return 100 * both >= self.percent * (sizes - both)

    def may_link(self, differ, sizes):
        """Whether sets that differ in ``differ`` shingles at least can be linked."""
        return (100 + self.percent) * differ <= (100 - self.percent) * sizes


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > _WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: bytes | None, n: int, hashes: dict) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    w = text.lower().split() if text else []
    if not w:
        return np.empty(0, np.uint64)
    h = mix64(np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w)))
    size = min(n, len(w))
    out = np.full(len(w) - size + 1, size, np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - size + 1 + i]
    return np.unique(mix64(out))


def list_keys(s: np.ndarray, rule: Rule, starts: list[int]) -> np.ndarray:
    """Keys of the index lists that a set is in."""
    if not len(s):
        return np.empty(0, np.int64)
    own = int(np.searchsorted(starts, len(s), side="right")) - 1
    places = [own]
    while 100 * len(s) >= rule.percent * starts[places[-1] + 1]:  # may be linked into the next class
        places.append(places[-1] + 1)
    content = np.concatenate([[np.uint64(0)], np.cumsum(mix64(s + np.uint64(1)), dtype=np.uint64)])
    keys = []
    for c in places:
        most = starts[c + 1] - 1
        blocks = rule.blocks(most)
        edges = (np.arange(blocks + 1, dtype=np.float64) * (2.0**64 / blocks))[1:-1].astype(np.uint64)
        at = np.concatenate([[0], np.searchsorted(s, edges), [len(s)]])
        name = np.uint64(c) * np.uint64(1 << 32) + np.arange(blocks, dtype=np.uint64)
        lists = mix64((content[at[1:]] - content[at[:-1]]) ^ mix64(name + np.uint64(1)))
        filled = at[1:] > at[:-1]
        # more blocks are filled than a linked set can differ in: one of them is the same there
        if np.count_nonzero(filled) > rule.differs_from(len(s), most):
            lists = lists[filled]
        keys.append(lists)
    # 48 bits: lists that fall together only mean more to compare
    return (np.concatenate(keys) >> np.uint64(16)).view(np.int64)


def _identity(s: np.ndarray) -> tuple[int, int]:
    import xxhash

    raw = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def _sets(text: Column, rule: Rule, lists: bool) -> Column:
    """Struct of the set's size, 128-bit identity, parity and, if asked, index lists."""

    def build(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes, starts = _Hashes(), rule.classes(1)
        for texts in batches:
            n, own, bits, keys = [], [], [], []
            for body in (t for part in runs(texts) for t in text_bytes(part)):
                s = shingles(body, rule.n, hashes)
                n.append(len(s))
                own.append(_identity(s))
                bits.append(parity(s))
                if lists:
                    starts = _upto(starts, len(s), rule)
                    keys.append(list_keys(s, rule, starts))
            h1, h2 = (pa.array([x[k] for x in own], pa.int64()) for k in (0, 1))
            fields = {"n": pa.array(n, pa.int64()), "h1": h1, "h2": h2, "parity": pa.array(bits, pa.binary())}
            yield struct_array({**fields, "lists": _list_array(keys)} if lists else fields)
        del hashes
        release()

    return F.arrow_udf(build, _SET + ", lists array<long>" * lists).asNondeterministic()(text)


def _listed(text: Column, rule: Rule) -> Column:
    """Struct of the first half of the set's identity and its index lists."""

    def build(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes, starts = _Hashes(), rule.classes(1)
        for texts in batches:
            h1, keys = [], []
            for body in (t for part in runs(texts) for t in text_bytes(part)):
                s = shingles(body, rule.n, hashes)
                starts = _upto(starts, len(s), rule)
                h1.append(_identity(s)[0])
                keys.append(list_keys(s, rule, starts))
            yield struct_array({"h1": pa.array(h1, pa.int64()), "lists": _list_array(keys)})
        del hashes
        release()

    return F.arrow_udf(build, "h1 long, lists array<long>")(text)


def _upto(starts: list[int], size: int, rule: Rule) -> list[int]:
    """The size classes, more of them where a set is that large."""
    return rule.classes(400 * size // rule.percent) if 200 * size >= rule.percent * starts[-2] else starts


def _list_array(keys: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
    ends = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


def parity(s: np.ndarray) -> bytes:
    """A bit for each of a power of two of buckets, as many as shingles at least: whether
    the number of shingles in it is odd."""
    size = 1 << max(6, (len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).tobytes()


def _folded(bits: bytes, size: int) -> np.ndarray:
    """The parity for ``size`` bytes of buckets, half or a quarter ... of its own."""
    x = np.frombuffer(bits, np.uint8)
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def _shingle_udf(text: Column, n: int) -> Column:
    """The set itself: its sorted hashes as raw bytes."""

    def build(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = _Hashes()
        for texts in batches:
            sets = [shingles(t, n, hashes).tobytes() for part in runs(texts) for t in text_bytes(part)]
            yield pa.array(sets, pa.binary())
        del hashes
        release()

    return F.arrow_udf(build, "binary").asNondeterministic()(text)


def components(edges: DataFrame, nodes: tuple[str, str] = ("a", "b")) -> DataFrame:
    """node, label: the smallest node that each node of the edges can reach.

    Labels travel over the edges and then jump to their label's label, so long
    chains take few rounds; each round's lineage is cut.
    """
    a, b = nodes
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = cut(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct())
    labels = both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label"))
    labels = cut(labels)
    while True:
        heard = both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("theirs")), "other")
        least = heard.groupBy("node").agg(F.min("theirs").alias("m"))
        near = labels.join(least, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "m").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = cut(
            near.join(jump, "label", "left").select("node", "old", F.least("label", "further").alias("label"))
        )
        labels = new.select("node", "label")
        if new.where("label <> old").isEmpty():
            return labels


class JaccardJoin:
    """The join over ``docs`` (doc_id, text). A node is a distinct set.

    ``members``: row identity (doc_id, t: hash of the text), n and node of every
    document row; ``labels``: node, label of the nodes that have links.
    ``keep_lists``: whether index lists are checkpointed with the sets (quicker), or
    made again where they are dealt (less disk).
    """

    def __init__(self, docs: DataFrame, n: int = N, percent: int = PERCENT, block: int = BLOCK, keep_lists: bool = True):
        self.rule, self.block = Rule(n, percent), block
        text = F.col("text").cast("string")
        rows = docs.select("doc_id", text.alias("text"))
        self.texts = rows.select("doc_id", "text", F.xxhash64("text").alias("t"))
        made = self.texts.select("doc_id", "t", _sets(F.col("text"), self.rule, keep_lists).alias("s")).select("doc_id", "t", "s.*")
        made = cut(made)
        if keep_lists:
            self.lists = made.select("doc_id", "t", "h1", "lists")
        else:
            self.lists = self.texts.select("doc_id", "t", _listed(F.col("text"), self.rule).alias("s")).select("doc_id", "t", "s.*")
        node = F.when(F.col("n") > 0, F.struct("h1", "h2"))
        self.members = made.select("doc_id", "t", "n", node.alias("node"))
        self.labels = self._labels(made)

    def _labels(self, made: DataFrame) -> DataFrame:
        pairs = self._leaders()
        wanted = cut(pairs.select("h1").union(pairs.select("leader")).distinct())
        # one document of each set, found in the tasks first: copies of a set never meet as rows
        one = made.where("n > 0").groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "t")).alias("one"), F.first("n").alias("n"), F.first("parity").alias("parity"))
        one = one.join(wanted, "h1").select("h1", "h2", F.col("one.doc_id").alias("id"), F.col("one.t").alias("t"), "n", "parity")
        one = cut(one)
        repeated = not made.groupBy("doc_id", "t").count().where("count > 1").isEmpty()
        pairs = self._measured(pairs, one, repeated)
        near = components(pairs.where("linked").select("a", "b"))
        more = self._outside(pairs, near, one, repeated)
        if more is None:
            return near
        return components(pairs.where("linked").select("a", "b").union(more))

    def _read(self, nodes: DataFrame, one: DataFrame, repeated: bool) -> DataFrame:
        """node, set: the whole sets of ``nodes`` (h1, h2), from a document of each."""
        own = small(cut(one.join(nodes, ["h1", "h2"], "left_semi").select("h1", "h2", "id", "t")))
        same = (F.col("t0") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("id"))
        texts = self.texts.withColumnRenamed("t", "t0").join(own, same)
        sets = texts.select(F.struct("h1", "h2").alias("node"), _shingle_udf(F.col("text"), self.rule.n).alias("set"))
        return sets.dropDuplicates(["node"]) if repeated else sets

    def _leaders(self) -> DataFrame:
        """h1, leader: the smallest members of the lists that a set is in.

        Lists are dealt by their key, once.
        A list with very many rows (found by the counts of a sample of rows; at
        most ``_HOT`` lists) is not dealt: its leader comes from a
        pre-aggregated minimum and is broadcast to its members.
        """
        listed = self.lists.select("h1", F.explode("lists").alias("list"))
        ends = (F.min("h1").alias("leader"), F.max("h1").alias("last"))
        some = self.lists.where(F.pmod(F.xxhash64("doc_id", "t"), F.lit(_SAMPLED)) == 0)
        counts = some.select(F.explode("lists").alias("list")).groupBy("list").count()
        least = max(_RARE, math.ceil((counts.agg(F.sum("count")).first()[0] or 0) / _HOT))
        hot = cut(counts.where(F.col("count") >= least).select("list"))
        heated = not hot.isEmpty()
        dealt = listed.join(F.broadcast(hot), "list", "left_anti") if heated else listed
        # lists that are not hot are short
        of_list = W.partitionBy("list")
        pairs = dealt.select("list", "h1", F.min("h1").over(of_list).alias("leader"), F.max("h1").over(of_list).alias("last"))
        pairs = pairs.where("leader < last").select("list", "h1", "leader")
        if heated:
            # copies of a set are one row of each task
            hottest = cut(listed.join(F.broadcast(hot), "list").distinct())
            top = hottest.groupBy("list").agg(*ends).where("leader < last")
            pairs = pairs.unionByName(hottest.join(F.broadcast(cut(top.select("list", "leader"))), "list"))
        return cut(pairs.where("h1 <> leader").select("h1", "leader").distinct())

    def _measured(self, pairs: DataFrame, one: DataFrame, repeated: bool) -> DataFrame:
        """a, b, n_a, parity, linked: each member a compared with its leader b, by their
        parities and, where these allow a link, as whole sets."""
        rule = self.rule

        def may(x: pa.Array, y: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
            out = []
            for p, q, sizes in zip(x.to_pylist(), y.to_pylist(), (n.to_numpy() + m.to_numpy()).tolist(), strict=True):
                size = min(len(p), len(q))
                out.append(bool(rule.may_link(int(np.bitwise_count(_folded(p, size) ^ _folded(q, size)).sum()), sizes)))
            return pa.array(out, pa.bool_())

        def compare(x: pa.Array, y: pa.Array) -> pa.Array:
            linked = []
            for p, q in zip(x.to_pylist(), y.to_pylist(), strict=True):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                linked.append(bool(rule.linked(both, len(p) + len(q))))
            return pa.array(linked, pa.bool_())

        a = one.select("h1", F.struct("h1", "h2").alias("a"), F.col("n").alias("n_a"), "parity")
        b = one.select(F.col("h1").alias("leader"), F.struct("h1", "h2").alias("b"), F.col("n").alias("n_b"), F.col("parity").alias("parity_b"))
        both = pairs.join(a, "h1").join(b, "leader")
        allowed = F.arrow_udf(may, "boolean").asNondeterministic()("parity", "parity_b", "n_a", "n_b")
        both = cut(both.select("a", "b", "n_a", "parity", allowed.alias("may")))
        near = both.where("may").select("a", "b")
        sets = self._read(near.select("a.h1", "a.h2").union(near.select("b.h1", "b.h2")).distinct(), one, repeated)
        sets = cut(sets)
        near = near.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
        near = near.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
        near = near.select("a", "b", F.arrow_udf(compare, "boolean").asNondeterministic()("set_a", "set_b").alias("linked"))
        near = cut(near).where("linked")
        return cut(both.drop("may").join(near, ["a", "b"], "left").withColumn("linked", F.coalesce("linked", F.lit(False))))

    def _outside(self, pairs: DataFrame, near: DataFrame, one: DataFrame, repeated: bool) -> DataFrame | None:
        """Links between members of one leader that are in different components."""
        label = near.select(F.col("node").alias("a"), "label")
        rows = pairs.join(label, "a", "left").select(
            F.col("b").alias("leader"), F.col("a").alias("node"), "n_a", "parity", F.coalesce("label", "a").alias("label")
        )
        top = near.select(F.col("node").alias("leader"), F.col("label").alias("top"))
        rows = rows.join(top, "leader", "left").withColumn("top", F.coalesce("top", "leader"))
        # a leader with one member more is done; so is one whose members all are in its component
        open_ = rows.groupBy("leader").agg(F.count("*").alias("m"), F.count_if(F.col("label") != F.col("top")).alias("o"))
        open_ = small(cut(open_.where("m > 1 AND o > 0").select("leader")))
        # cells of about one size: linked sets are in the same or in neighbouring cells
        size = F.floor(F.log("n_a") / (1.001 * -math.log(self.rule.percent / 100)))
        rows = rows.join(open_, "leader").select(
            "leader", "node", "label", (F.col("label") != F.col("top")).alias("out"), size.alias("size"),
            F.struct("n_a", "parity").alias("apart"),
        )
        rows = cut(rows)
        if rows.isEmpty():
            return None
        cells = rows.groupBy("leader", "size").agg(F.count("*").alias("m"), F.count_if("out").alias("o"))
        block = self.block * PARITIES
        parts = cells.select("leader", "size", F.ceil(F.col("m") / block).alias("parts"), F.ceil(F.col("o") / block).alias("asks"))
        # work: a part of a cell's members against a part of the outside members
        # of the same or a neighbouring cell
        near_cells = F.explode(F.array(*(F.col("size") + i for i in (-1, 0, 1))))
        work = parts.where("asks > 0").select("leader", F.col("size").alias("q_size"), "asks", near_cells.alias("size"))
        work = small(cut(work.join(parts.select("leader", "size", "parts"), ["leader", "size"])))
        draw = F.xxhash64("node")
        held = rows.join(work, ["leader", "size"]).select(
            "leader", "node", "label", "apart", "q_size", "size",
            F.pmod(draw, F.col("parts")).alias("part"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("asks") - 1)).alias("ask"),
            F.lit(0).alias("asking"),
        )
        asked = rows.where("out").select("leader", "node", "label", "apart", F.col("size").alias("q_size"))
        asked = asked.join(work, ["leader", "q_size"]).select(
            "leader", "node", "label", "apart", "q_size", "size",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
            F.pmod(draw, F.col("asks")).alias("ask"),
            F.lit(1).alias("asking"),
        )
        cell = F.xxhash64("leader", "q_size", "size", "part", "ask")
        both = held.unionByName(asked).select(cell.alias("cell"), "asking", "node", "label", "apart.*")
        both = both.repartition("cell").sortWithinPartitions("cell", "asking")
        left = cut(both.mapInArrow(self._may_be_linked(), f"cell long, asking int, {_ROW}"))
        nodes = cut(left.select("node.h1", "node.h2").distinct())
        if nodes.isEmpty():
            return None
        # what is left of a block, again in blocks: each part of the held sets meets all that ask
        own = left.where("asking = 0").groupBy("cell").agg(F.ceil(F.count("*") / self.block).alias("parts"))
        left = left.join(small(cut(own)), "cell")
        every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
        part = F.explode(F.when(F.col("asking") == 1, every).otherwise(F.array(F.pmod(F.xxhash64("node"), F.col("parts")))))
        left = left.select("cell", part.alias("part"), "asking", "node", "label").withColumn("cell", F.xxhash64("cell", "part"))
        left = left.join(self._read(nodes, one, repeated), "node")
        left = left.select("cell", "asking", "node", "label", "set").repartition("cell").sortWithinPartitions("cell", "asking")
        return cut(left.mapInArrow(self._compare(), _EDGE).distinct())

    def _may_be_linked(self):
        """Of each cell, the rows whose parities allow a link across the two sides."""
        rule = self.rule

        def rows(cell: int, held: list[tuple], asks: list[tuple]) -> Iterator[tuple]:
            if not held or not asks:
                return
            size = min(len(r[3]) for r in (*held, *asks))
            bits = np.stack([_folded(r[3], size) for r in held])
            n = np.array([r[2] for r in held], np.int64)
            numbers: dict[tuple, int] = {}
            label = np.array([numbers.setdefault(tuple(r[1].values()), len(numbers)) for r in held])
            hit = np.zeros(len(held), bool)
            for r in asks:
                differ = np.bitwise_count(bits ^ _folded(r[3], size)).sum(axis=1, dtype=np.int64)
                near = rule.may_link(differ, n + r[2]) & (label != numbers.get(tuple(r[1].values()), -1))
                if near.any():
                    hit |= near
                    yield cell, 1, r[0], r[1]
            for i in np.flatnonzero(hit):
                yield cell, 0, held[i][0], held[i][1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cell, sides = None, ([], [])
            for batch in batches:
                x, out = batch.to_pydict(), []
                for i in range(batch.num_rows):
                    if x["cell"][i] != cell:
                        out += rows(cell, *sides)
                        cell, sides = x["cell"][i], ([], [])
                    sides[x["asking"][i]].append((x["node"][i], x["label"][i], x["n_a"][i], x["parity"][i]))
                yield _batch(out)
            yield _batch(list(rows(cell, *sides)))
            del sides
            release()

        return run

    def _compare(self):
        rule = self.rule

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cell, held = None, None
            for batch in batches:
                x = batch.to_pydict()
                out: list[tuple] = []
                for i in range(batch.num_rows):
                    if x["cell"][i] != cell:
                        cell, held = x["cell"][i], _Held(rule)
                    node, s = x["node"][i], np.frombuffer(x["set"][i], np.uint64)
                    label = (x["label"][i]["h1"], x["label"][i]["h2"])
                    if x["asking"][i]:
                        out += ((node, other) for other in held.links(node, label, s))
                    else:
                        held.add(node, label, s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([e[k] for e in out], _NODE) for k in (0, 1)], ["a", "b"]
                )
            del held
            release()

        return run

    def rows(self) -> DataFrame:
        """doc_id, t, n, label (the component; null for empty sets) of every row."""
        found = self.members.join(self.labels, "node", "left")
        return found.select("doc_id", "t", "n", F.coalesce("label", "node").alias("label"))

    def result(self) -> DataFrame:
        """doc_id, n, component_id of every document row."""
        rows = self.rows()
        # cut, so that a join with a large component can be split
        least = cut(rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id")))
        linked = rows.join(least, "label").select("doc_id", "n", "component_id")
        alone = self.members.where("node IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
        return linked.unionByName(alone)


_NODE = pa.struct([("h1", pa.int64()), ("h2", pa.int64())])
_EDGE = "a struct<h1:long,h2:long>, b struct<h1:long,h2:long>"
_ROW = "node struct<h1:long,h2:long>, label struct<h1:long,h2:long>"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("cell", pa.int64()), ("asking", pa.int32()), ("node", _NODE), ("label", _NODE))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(kinds)], [n for n, _ in kinds])


class _Held:
    """A bounded block of sets with an inverted index from shingle to sets."""

    def __init__(self, rule: Rule):
        self.rule, self.rows, self.sets, self.ready = rule, [], [], False
        self.joined: dict[tuple, tuple] = {}

    def add(self, node: dict, label: tuple, s: np.ndarray) -> None:
        self.rows.append((node, label))
        self.sets.append(s)

    def _index(self) -> None:
        sizes = np.array([len(s) for s in self.sets], np.int64)
        flat = np.concatenate(self.sets)
        order = np.argsort(flat, kind="stable")
        self.owner = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.shingle, self.first = np.unique(flat[order], return_index=True)
        self.last = np.append(self.first[1:], len(flat))
        self.sizes, self.ready = sizes, True
        numbers: dict[tuple, int] = {}
        self.label = np.array([numbers.setdefault(label, len(numbers)) for _, label in self.rows])

    def links(self, node: dict, label: tuple, s: np.ndarray) -> Iterator[dict]:
        """Linked sets in components that no link of this block has joined yet, one of each:
        a block gives fewer links than it has components on both sides."""
        if not self.rows:
            return
        if not self.ready:
            self._index()
        at = np.minimum(np.searchsorted(self.shingle, s), len(self.shingle) - 1)
        at = at[self.shingle[at] == s]
        first, last = self.first[at], self.last[at]
        n = last - first
        if not n.sum():
            return
        gather = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        both = np.bincount(self.owner[gather], minlength=len(self.sizes))
        hit = np.flatnonzero(self.rule.linked(both, self.sizes + len(s)))
        hit = hit[np.unique(self.label[hit], return_index=True)[1]]
        own = self._root(label)
        for i in hit:
            other = self._root(self.rows[i][1])
            if other != own:
                self.joined[other] = own
                yield self.rows[i][0]

    def _root(self, label: tuple) -> tuple:
        """Of the components that links of this block have joined, the one that stands for all."""
        path = []
        while label in self.joined:
            path.append(label)
            label = self.joined[label]
        for x in path[:-1]:
            self.joined[x] = label
        return label


def one_of_each(docs: DataFrame, n: int = N, percent: int = PERCENT, keep_lists: bool = True) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest
    id (of these, with the smallest text hash). Empty sets all stay."""
    rows = JaccardJoin(docs, n, percent, keep_lists=keep_lists).rows().where("label IS NOT NULL")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t")
    # both sides are cut, so that a join with a large component can be split
    kept = cut(rows.groupBy("label").agg(F.min(own).alias("kept")))
    rows = cut(rows.groupBy("label", "doc_id", "t").agg(F.count("*").alias("c"))).join(kept, "label")
    t, own_id, own_t, times, stays = (
        free_name(docs.columns, x) for x in ("text_hash", "kept_id", "kept_hash", "kept_times", "kept_stays")
    )
    rows = rows.select(
        F.col("doc_id").alias(own_id), F.col("t").alias(own_t), F.col("c").alias(times), (own == F.col("kept")).alias(stays)
    )
    rows = cut(rows)
    hashed = docs.withColumn(t, F.xxhash64(F.col("text").cast("string")))
    same = hashed["doc_id"].eqNullSafe(F.col(own_id)) & (hashed[t] == F.col(own_t))
    gone = small(cut(rows.where(~F.col(stays))))
    out = hashed.join(gone, same, "left_anti")
    again = rows.where(F.col(stays) & (F.col(times) > 1))
    if again.isEmpty():
        return out.drop(t)
    # a kept document whose row is repeated
    repeated = hashed.join(again, same, "left_semi").dropDuplicates(["doc_id", t])
    return out.join(again, same, "left_anti").unionByName(repeated).drop(t)
