"""Periodic runs of words: maximal repetitions, and texts without them.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) and at least ``max(least, 2 * q)`` words that no neighbouring word extends.

Method. The words of a text become numbers. Ukkonen's algorithm builds the suffix
tree of the sequence and the one of its reversal; a tour of a tree gives, between
each two successive leaves, the depth of their lowest common ancestor, and a
sparse table of minima over it answers in constant time how far two suffixes
agree. The longest Lyndon word from each position, for the order of the suffixes
and for its reverse, is a candidate root (every run has its root among these);
each root is extended to the right by the tree of the sequence and to the left by
the tree of the reversal, and stays if it reaches two periods.

What is left unread, exactly. Two copies of a root share half of ``least`` words
in a row at least. So every word of a run lies in a window of that many words that
occurs again in the text, and nearer than half the length of the stretch that such
windows cover. Windows without such a copy are dropped until nothing changes;
trees are built over each remaining stretch. A text without a repeated window has
no run.

Defined results: words are runs of ``[^\\x20\\x09-\\x0D]``; a null or empty text, or one
without words, has no runs and an empty collapsed text; rows that repeat get equal
results; an empty table gives no rows; other columns are not looked at. A task
holds one text's trees at a time, about 700 bytes for each word of a stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from commitlake.llm.common import runs, struct_array, text_bytes

#: Fewest words of a run.
LEAST = 12
RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class SuffixTree:
    """Ukkonen's tree of a sequence of numbers from 1 on, closed by a 0.

    ``order``: the suffixes in the order of a tour that takes children by their first
    number; ``shared``: for each but the first of them, the depth of the lowest
    common ancestor with the one before.
    """

    def __init__(self, numbers: list[int]):
        s = [*numbers, 0]
        starts, lengths, links, kids = self._build(s)
        self._tour(len(s), starts, lengths, kids)
        self.place = np.empty(len(s), np.int64)
        self.place[self.order] = np.arange(len(s))
        self._minima()

    @staticmethod
    def _build(s: list[int]) -> tuple[list[int], list[int], list[int], list[dict]]:
        """Start and length of each inner node's edge, its suffix link and its
        children by first number: inner nodes by number, leaves as ``~suffix``."""
        starts, lengths, links, kids = [0], [0], [0], [{}]
        leaf_start: list[int] = []  # by suffix
        node, edge, length = 0, 0, 0  # the active point: below node, on the edge of s[edge]
        for i, c in enumerate(s):
            waiting = 0  # an inner node made in this step whose link is not known yet
            while len(leaf_start) <= i:
                if not length:
                    edge = i
                first = s[edge]
                child = kids[node].get(first)
                if child is None:
                    kids[node][first] = ~len(leaf_start)
                    leaf_start.append(i)
                    if waiting:
                        links[waiting] = node
                        waiting = 0
                else:
                    if child >= 0:
                        if length >= lengths[child]:  # walk down
                            length -= lengths[child]
                            edge += lengths[child]
                            node = child
                            continue
                        begin = starts[child]
                    else:
                        begin = leaf_start[~child]
                    if s[begin + length] == c:
                        length += 1
                        if waiting:
                            links[waiting] = node
                        break
                    new = len(starts)
                    starts.append(begin)
                    lengths.append(length)
                    links.append(0)
                    kids.append({s[begin + length]: child, c: ~len(leaf_start)})
                    kids[node][first] = new
                    leaf_start.append(i)
                    if child >= 0:
                        starts[child] += length
                        lengths[child] -= length
                    else:
                        leaf_start[~child] += length
                    if waiting:
                        links[waiting] = new
                    waiting = new
                if node:
                    node = links[node]
                elif length:
                    length -= 1
                    edge = len(leaf_start)
        return starts, lengths, links, kids

    def _tour(self, n: int, starts: list[int], lengths: list[int], kids: list[dict]) -> None:
        order: list[int] = []
        shared: list[int] = []
        stack, turn = [(0, 0)], 0  # node and its parent's depth
        fresh = True
        while stack:
            node, depth = stack.pop()
            if fresh:  # the first step after a leaf leaves the common ancestor
                turn, fresh = depth, False
            if node < 0:
                order.append(~node)
                shared.append(turn)
                fresh = True
                continue
            depth += lengths[node]
            children = kids[node]
            stack.extend([(children[k], depth) for k in sorted(children, reverse=True)])
        self.order = np.array(order, np.int64)
        self.shared = np.array(shared, np.int32)

    def _minima(self) -> None:
        self.table = [self.shared]
        width = 1
        while 2 * width <= len(self.shared):
            below = self.table[-1]
            self.table.append(np.minimum(below[:-width], below[width:]))
            width *= 2

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common numbers of the suffixes from a and from b on (a and b differ)."""
        p, q = self.place[a], self.place[b]
        low, high = np.minimum(p, q) + 1, np.maximum(p, q)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at, minima = np.flatnonzero(level == k), self.table[k]
            out[at] = np.minimum(minima[low[at]], minima[high[at] - (1 << int(k)) + 1])
        return out


def lyndon_roots(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the longest Lyndon word from each position: up to the
    next smaller suffix, and for the reversed order the next greater one."""
    values = rank.tolist()
    start, end = [], []
    smaller: list[int] = []
    greater: list[int] = []
    for i, v in enumerate(values):
        while smaller and values[smaller[-1]] > v:
            start.append(smaller.pop())
            end.append(i)
        smaller.append(i)
        while greater and values[greater[-1]] < v:
            start.append(greater.pop())
            end.append(i)
        greater.append(i)
    start = np.array(start, np.int64)
    return start, np.array(end, np.int64) - start


def runs_of(numbers: list[int], least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence, by start and period."""
    n = len(numbers)
    if n < max(least, 2):
        return np.empty((0, 3), np.int64)
    forward, backward = SuffixTree(numbers), SuffixTree(numbers[::-1])
    start, period = lyndon_roots(forward.place)
    fits = start + period < n  # the closing 0 is in no run
    start, period = start[fits], period[fits]
    right = forward.agree(start, start + period)
    # left of a position i, the reversal goes on from n - i
    inner = start > 0
    left = np.zeros(len(start), np.int64)
    left[inner] = backward.agree(n - start[inner], n - start[inner] - period[inner])
    length = left + period + right
    found = length >= np.maximum(2 * period, least)
    return np.unique(np.stack([start - left, length, period], axis=1)[found], axis=0)


def covered(words: np.ndarray, least: int = LEAST) -> np.ndarray:
    """First and last-but-one positions of the stretches that can hold runs."""
    k = least // 2
    none = np.empty((0, 2), np.int64)
    if len(words) < least or k < 1:
        return np.array([[0, len(words)]]) if len(words) and k < 1 else none
    n = len(words) - k + 1
    window = np.zeros(n, np.uint64)
    for i in range(k):
        window = window * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    by = np.argsort(window, kind="stable")
    same = np.flatnonzero(window[by[1:]] == window[by[:-1]])
    if not len(same):
        return none
    one, two = by[same], by[same + 1]
    far = np.full(n, len(words), np.int64)
    far[one] = two - one
    far[two] = np.minimum(far[two], two - one)
    at = np.unique(np.concatenate([one, two]))
    while len(at):
        breaks = np.flatnonzero(at[1:] > at[:-1] + k) + 1
        first, last = at[np.concatenate([[0], breaks])], at[np.concatenate([breaks - 1, [len(at) - 1]])] + k
        length = last - first
        sizes = np.diff(np.concatenate([[0], breaks, [len(at)]]))
        stays = 2 * far[at] <= np.repeat(np.where(length >= least, length, 0), sizes)
        if stays.all():
            return np.stack([first, last], axis=1)
        at = at[stays]
    return none


def text_runs(words: list[bytes], least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs of a text's words."""
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    found = []
    for first, last in covered(hashes, least).tolist():
        number: dict[bytes, int] = {}
        own = runs_of([number.setdefault(w, len(number) + 1) for w in words[first:last]], least)
        own[:, 0] += first
        found.append(own)
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def repeats(found: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n words lies in a run, after the run's first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edge)[:n] > 0


def periodic_runs(text: Column, least: int = LEAST) -> Column:
    """Struct ``RESULT`` of each whole text: its number of words, its runs, and its
    words, joined by one space, without those that repeat a run's first period."""

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sizes, flat, ends, kept = [], [np.empty((0, 3), np.int64)], [0], []
            for body in (t for part in runs(texts) for t in text_bytes(part)):
                words = (body or b"").split()
                found = text_runs(words, least)
                if len(found):
                    gone = repeats(found, len(words))
                    kept.append(b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()]))
                else:
                    kept.append(b" ".join(words))
                sizes.append(len(words))
                flat.append(found)
                ends.append(ends[-1] + len(found))
            each = np.concatenate(flat)
            fields = {name: pa.array(each[:, i]) for i, name in enumerate(("start", "length", "period"))}
            yield struct_array(
                {
                    "n_words": pa.array(sizes, pa.int64()),
                    "runs": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct_array(fields)),
                    "collapsed": pa.array(kept, pa.binary()).cast(pa.string()),
                }
            )

    return F.arrow_udf(find, RESULT).asNondeterministic()(text.cast("string"))
