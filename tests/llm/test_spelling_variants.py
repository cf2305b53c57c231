"""Spelling variants against brute force; the trie's search on its own."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from conftest import TESTDATA
from helpers import awkward, empty
from pyspark.sql import functions as F

from commitlake.llm import queries
from commitlake.llm.common import prepare
from commitlake.llm.spelling_variants import count_words, near_pairs, variants, vectors


def near(a, b):
    """Whether one insertion, deletion or replacement makes a of b."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(texts, least=6, slips=199):
    counts = Counter()
    for key, text in texts:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{key}:{w}".encode())
            if slips and key is not None and h % slips == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1 :]
            if len(w) >= least:
                counts[w] += 1
    return counts


def brute(counts, times=5):
    words, out = sorted(counts), set()
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    beside = {w: [x for k in (-1, 0, 1) for x in by_length.get(len(w) + k, []) if near(w, x)] for w in words}
    form = {}
    for w in words:
        if beside[w]:
            best = min(beside[w], key=lambda x: (-counts[x], x))
            if counts[best] >= times * counts[w]:
                form[w] = best
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.add((w, counts[w], len(beside[w]), form.get(w), counts.get(form.get(w)), root))
    return out


def found(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def vocabulary(r, n):
    words = {"".join(r.choice("abqré") for _ in range(r.randint(1, 5))) for _ in range(n)}
    words |= {"".join(r.sample("stones", 6)) for _ in range(60)}  # one vector
    words |= {"x" * k for k in range(1, 300, 7)} | {"x" * 300, "x" * 301, "x" * 300 + "y"}
    return {w: r.choice([5, 6, 30, 31, 150, 800, 5000]) for w in sorted(words)}


@pytest.mark.parametrize("leaf, searches", [(20_000, 20_000), (10, 7), (1, 1)])
def test_variants_against_all_pairs(spark, leaf, searches):
    prepare(spark)
    counts = vocabulary(random.Random(leaf), 150)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(variants(df, leaf=leaf, searches=searches)) == brute(counts)


def test_each_pair_once(spark):
    prepare(spark)
    counts = vocabulary(random.Random(1), 120)
    rows = near_pairs(spark.createDataFrame([(w,) for w in counts], "word string"), leaf=20, searches=9).collect()
    pairs = [frozenset((r.a, r.b)) for r in rows]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {frozenset((a, b)) for a in counts for b in counts if a < b and near(a, b)}


def test_one_edit_changes_a_vector_by_one_surplus_and_one_deficit():
    v = vectors(["stone", "stones", "stome", ""])
    assert v.sum(axis=1).tolist() == [5, 6, 5, 0]
    assert abs(v[1] - v[0]).sum() == 1 and sorted((v[2] - v[0])[v[2] != v[0]].tolist()) == [-1, 1]


def test_ties_nulls_repeated_and_empty_tables(spark):
    prepare(spark)
    rows = [("stones", 5), ("stoned", 50), ("stoneb", 50), ("stones", 5), (None, 9), ("alone!", None)]
    df = spark.createDataFrame(rows, "word string, n long").withColumn("a", F.lit(1)).withColumn("node", F.lit(1))
    got = found(variants(df))
    assert ("stones", 10, 2, "stoneb", 50, "stoneb") in got and len(got) == 3
    assert variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        variants(df, times=1)


def test_words_of_awkward_texts(spark):
    prepare(spark)
    df = awkward(spark)
    texts = [(r.doc_id, r.text) for r in df.collect()]
    for least, slips in ((6, 199), (1, 2), (3, None)):
        got = {r.word: r.n for r in count_words(df, least, slips).collect()}
        assert got == brute_words(texts, least, slips)
    assert count_words(empty(spark)).count() == 0


def test_a_slip_does_not_slip_again(spark):
    prepare(spark)
    rows = [(i, "stonesx stonesx stones STONES Été×÷abc " * 3) for i in range(200)]
    got = count_words(spark.createDataFrame(rows, "doc_id long, text string"), 4, 3).collect()
    assert {r.word: r.n for r in got} == brute_words(rows, 4, 3)


def test_op12_against_the_contract(spark):
    sf = f"{TESTDATA}/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    counts = {w: n for w, n in brute_words([(d.doc_id, d.text) for d in docs]).items() if n >= 5}
    got = found(queries.op12_spelling_variants(spark, sf))
    assert got == brute(counts) and any(x[3] for x in got)
