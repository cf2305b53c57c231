from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import awkward, empty, random_text
from pyspark.sql import functions as F

from commitlake.llm import common
from commitlake.llm import jaccard_join as J


def brute_set(text, n=3):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ")
    w = [x for x in w if x]
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n, 0) + 1)} if w else set()


def brute(texts, percent=90, n=3):
    """Smallest id reachable by links, over all pairs."""
    sets = {i: brute_set(t, n) for i, t in texts.items()}
    label = {i: i for i in texts}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                label[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def edited(r, words, edits):
    w = list(words)
    for _ in range(edits):
        w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
    return w


def family_texts(seed):
    """Families of near copies at all distances, chains, copies, short texts."""
    r = random.Random(seed)
    out = []
    for f in range(12):
        base = [f"w{r.randrange(300)}" for _ in range(r.choice([3, 8, 12, 30, 60, 150]))]
        w = base
        for _ in range(14):
            w = edited(r, w if r.random() < 0.4 else base, r.choice([0, 1, 1, 2, 3]))
            out.append(" ".join(w))
            if r.random() < 0.2:
                out.append(" ".join(w).upper())
    out += [random_text(r, n) for n in (1, 1, 2, 2, 3, 4) for _ in range(3)] + ["a b", "A b", "", None]
    r.shuffle(out)
    return dict(enumerate(out))


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)


@pytest.mark.parametrize(("seed", "block", "rare"), [(1, 256, 50), (2, 2, 50), (3, 3, 2)])
def test_components_equal_brute_force(spark, monkeypatch, seed, block, rare):
    # small blocks deal a group's comparisons over many tasks; a small _RARE sends
    # lists the way of hot ones; no broadcast of candidates
    monkeypatch.setattr(J, "_RARE", rare)
    if rare < 50:
        monkeypatch.setattr(J, "_SAMPLED", 1)
        monkeypatch.setattr(J, "_HOT", 10**9)
        monkeypatch.setattr(common, "SMALL_ROWS", 0)
    texts = family_texts(seed)
    got = {r.doc_id: (r.n, r.component_id) for r in J.JaccardJoin(frame(spark, texts), block=block).result().collect()}
    assert got == brute(texts)


def test_other_threshold_and_one_large_cloud(spark):
    r = random.Random(8)
    base = [f"w{r.randrange(400)}" for _ in range(80)]
    texts = {i: " ".join(edited(r, base, r.randrange(9))) for i in range(150)}
    got = {x.doc_id: (x.n, x.component_id) for x in J.JaccardJoin(frame(spark, texts), percent=70, block=16).result().collect()}
    assert got == brute(texts, 70)
    got = {x.doc_id: (x.n, x.component_id) for x in J.JaccardJoin(frame(spark, texts), block=16).result().collect()}
    assert got == brute(texts)


def test_five_words_and_80_percent(spark):
    texts = family_texts(9)
    got = {r.doc_id: (r.n, r.component_id) for r in J.JaccardJoin(frame(spark, texts), n=5, percent=80, block=16, keep_lists=False).result().collect()}
    assert got == brute(texts, 80, 5)


def test_the_pipeline_deals_lists_without_python_tasks(spark, monkeypatch):
    # lists made anew by Python tasks, while the shuffle fills the heap, took the pipeline over an executor's memory
    import corpus_pipeline

    def fails(*_):
        raise AssertionError("lists are made a second time")

    monkeypatch.setattr(J, "_listed", fails)
    words = [f"w{i}" for i in range(60)]
    docs = frame(spark, {0: " ".join(words), 1: " ".join([*words[:-1], "x"]), 2: "another text of six words here", 3: None})
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == [0, 2, 3]


def test_a_block_gives_no_more_links_than_join_its_components():
    # near copies in components of their own: every pair of them was a link
    r = np.random.default_rng(4)
    base = np.unique(r.integers(0, 2**63, 400, dtype=np.uint64))
    sets = [np.sort(np.delete(base, i)) for i in range(60)] + [np.unique(r.integers(0, 2**63, 400, dtype=np.uint64)) for _ in range(5)]
    held = J._Held(J.Rule(5, 80))
    for i in range(0, 65, 2):
        held.add({"h1": i, "h2": 0}, (i, 0), sets[i])
    links = [(i, other["h1"]) for i in range(1, 65, 2) for other in held.links({"h1": i, "h2": 0}, (i, 0), sets[i])]
    assert len(links) == 59
    root = list(range(65))
    for a, b in links:
        root = [root[a] if x == root[b] else x for x in root]
    assert len(set(root[:60])) == 1 and len(set(root)) == 6


def test_parities_never_miss_a_link():
    r, rule = random.Random(6), J.Rule(3, 90)
    import numpy as np

    for _ in range(300):
        a = np.array(sorted(r.getrandbits(64) for _ in range(r.choice([1, 5, 60, 70, 300]))), np.uint64)
        b = np.unique(np.concatenate([a[[r.random() < 0.95 for _ in a]], np.array([r.getrandbits(64) for _ in range(r.randrange(4))], np.uint64)]))
        p, q = J.parity(a), J.parity(b)
        size = min(len(p), len(q))
        differ = int(np.bitwise_count(J._folded(p, size) ^ J._folded(q, size)).sum())
        both = len(np.intersect1d(a, b))
        assert differ <= len(a) + len(b) - 2 * both
        if len(b) and rule.linked(both, len(a) + len(b)):
            assert rule.may_link(differ, len(a) + len(b))


@pytest.mark.parametrize("percent", [80, 90])
def test_empty_blocks_are_no_lists_and_no_link_is_missed(percent):
    r = np.random.default_rng(percent)
    rule = J.Rule(5, percent)
    starts = rule.classes(1000)

    def some(n):
        return np.unique(r.integers(0, 2**64, n, dtype=np.uint64))

    def keys(s):
        return set(J.list_keys(s, rule, starts).tolist())

    # sets that have nothing in common share a list only where a set has few filled blocks
    alone = [keys(some(300)) for _ in range(200)]
    assert sum(bool(a & b) for i, a in enumerate(alone) for b in alone[:i]) < 200
    for _ in range(200):
        s = some(int(r.integers(1, 60)) if r.random() < 0.7 else int(r.integers(60, 400)))
        # as far apart as linked sets can be: shingles go, come or are replaced
        y, others = s, some(len(s))
        for gone in range(len(s)):
            for come in (len(s), gone, 0):
                t = np.union1d(s[gone:], others[:come]) if r.random() < 0.5 else np.union1d(r.permutation(s)[gone:], others[:come])
                if rule.linked(len(np.intersect1d(s, t)), len(s) + len(t)):
                    y = t
            if 100 * (len(s) - gone) < percent * len(s):
                break
        assert keys(s) & keys(y), (s, y)


def test_long_chain_of_components(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (1001, 1000), (2000, 2000)]
    got = {r.node: r.label for r in J.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000, 2000: 2000}


def test_one_of_each(spark):
    texts = family_texts(5)
    docs = frame(spark, texts).withColumn("n", F.lit("own"))
    kept = J.one_of_each(docs)
    want = brute(texts)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (n, c) in want.items() if not n or c == i}


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    rows = J.JaccardJoin(docs.select("doc_id", "text")).result().collect()
    assert len(rows) == docs.count()
    by = {(r.doc_id, r.n): r.component_id for r in rows}
    assert by[0, 0] == 0 and by[1, 0] == 1 and by[None, 0] is None and by[None, 1] is None
    long = max(n for _, n in by)
    assert long > 20_000 and by[6, long] == by[7, long] == 6 and by[3, 1] == 3
    kept = J.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(50) == 2 and 7 not in ids and ids.count(None) == 2 and {0, 1, 2, 3, 6} <= set(ids)
    assert J.JaccardJoin(empty(spark).select("doc_id", "text")).result().count() == 0
    assert J.one_of_each(empty(spark)).count() == 0
