"""Periodic runs against brute force; the parts of the method on their own."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from conftest import TESTDATA
from helpers import awkward, empty
from pyspark.sql import functions as F

from commitlake.llm import queries
from commitlake.llm.common import prepare
from commitlake.llm.periodic_runs import LEAST, SuffixTree, covered, periodic_runs, repeats, runs_of, text_runs


def brute(words, least=LEAST):
    """All (start, length, period), by start and period, from the definition."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, 2 * q):
                smaller = any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q))
                out += [] if smaller else [(i, length, q)]
            i = max(j, i + 1)
    return sorted(out, key=lambda x: (x[0], x[2]))


def made_up(r, n):
    k = r.choice([1, 2, 2, 3, 5, 30])
    words = [b"w%d" % r.randrange(k) for _ in range(n)]
    if r.random() < 0.6 and n > 14:
        a, p = r.randrange(n), r.randint(1, 12)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("least", [12, 2, 5, 7])
def test_runs_against_the_definition(least):
    r = random.Random(least)
    for _ in range(300):
        words = made_up(r, r.randint(0, 70))
        assert [tuple(x) for x in text_runs(words, least).tolist()] == brute(words, least)


def test_trees_tell_how_far_two_suffixes_agree():
    r = random.Random(3)
    for _ in range(60):
        s = [r.randint(1, 3) for _ in range(r.randint(2, 40))]
        tree = SuffixTree(s)
        closed = [*s, 0]
        assert sorted(range(len(closed)), key=lambda i: closed[i:]) == tree.order.tolist()
        a, b = np.array([(i, j) for i in range(len(s)) for j in range(len(s)) if i != j]).T

        def common(i, j):
            n = 0
            while i + n < len(closed) and j + n < len(closed) and closed[i + n] == closed[j + n]:
                n += 1
            return n

        assert tree.agree(a, b).tolist() == [common(i, j) for i, j in zip(a, b, strict=True)]


def test_stretches_hold_every_run_and_skip_far_copies():
    passage = [b"p%d" % i for i in range(30)]
    filler = [b"f%d" % i for i in range(500)]
    words = passage + filler + passage
    hashes = np.array([hash(w) for w in words], np.int64).view(np.uint64)
    assert not len(covered(hashes))  # copies, but no run
    words = filler + passage * 3
    hashes = np.array([hash(w) for w in words], np.int64).view(np.uint64)
    assert covered(hashes).tolist() == [[500, 590]]
    assert text_runs(words).tolist() == [[500, 90, 30]]


def test_long_period_and_one_word():
    assert runs_of([1] * 5000).tolist() == [[0, 5000, 1]]
    words = list(range(1, 2001)) * 3
    assert runs_of(words).tolist() == [[0, 6000, 2000]]


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def test_repeats():
    found = np.array([[2, 12, 3], [10, 20, 10]])
    assert np.flatnonzero(repeats(found, 40)).tolist() == [*range(5, 14), *range(20, 30)]


def test_awkward_rows_and_an_empty_table(spark):
    prepare(spark)
    df = awkward(spark)
    rows = df.withColumn("runs", periodic_runs(F.col("text"))).collect()
    assert len(rows) == df.count()
    for r in rows:
        words = (r.text or "").encode().split()
        found = brute(words) if len(words) < 100 else [tuple(x) for x in text_runs(words).tolist()]
        assert r.runs.n_words == len(words) and [tuple(x) for x in r.runs.runs] == found
        assert r.runs.collapsed == b" ".join(collapsed(words, found)).decode()
    assert empty(spark).select(periodic_runs(F.col("text"))).count() == 0


def test_op11_against_the_contract(spark):
    sf = f"{TESTDATA}/sf0.001"
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, sf).collect()}
    planted = 0
    for doc in spark.read.parquet(f"{sf}/documents.parquet").collect():
        words, h = (doc.text or "").encode().split(), zlib.crc32(str(doc.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        found = brute(words) if n < 400 else [tuple(x) for x in text_runs(words).tolist()]
        r = got[doc.doc_id]
        assert r.n_runs == len(found)
        if found:
            start, length, period = min(found, key=lambda x: (-x[1], x[0], x[2]))
            assert (r.start, r.length, r.period) == (start, length, period)
            assert r.exponent_milli == 1000 * length // period
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest()
    assert planted > 5
