from __future__ import annotations

import re

import pytest
from helpers import awkward, empty

from commitlake.llm import decontaminate as D


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, n=10):
    w, hit, found = split(text), set(), set()
    for item, body in items:
        b = split(body)
        for i in range(max(len(b) - n, 0) + 1 if b else 0):
            win = b[i : i + n]
            for j in range(len(w) - len(win) + 1):
                if w[j : j + len(win)] == win:
                    hit.update(range(j, j + len(win)))
                    if item is not None:
                        found.add(str(item))
    return len(w), len(hit), sorted(found)


ITEMS = [(1, "alpha beta gamma delta"), (2, " ".join(f"w{i}" for i in range(15))), (None, "rare words"), (4, None), (5, "!!"), (1, "Zwei \u00c4PFEL"), (12, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12")]
TEXTS = [
    "x ALPHA, beta gamma-delta y alpha beta gamma delta",
    " ".join(f"w{i}" for i in range(13)) + " end",
    "only rare   words here",
    "zwei \u00c4pfel zwei \u00c4PFEL",
    "alpha beta gamma",
    "",
    None,
]


@pytest.fixture
def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("block", [D.MAX_WINDOWS, 4])
def test_hits_equal_brute_force(spark, bench, block):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r for r in D.report(docs, bench, max_windows=block).collect()}
    for i, t in enumerate(TEXTS):
        assert (got[i].n_words, got[i].n_hit, list(got[i]["items"])) == brute(t, ITEMS), t
        cut = "".join(t[s.start : s.end] for s in got[i].spans) if t else ""
        assert sum(len(split(t[s.start : s.end])) for s in got[i].spans) == got[i].n_hit, cut


def test_modes(spark, bench):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    left = {r.doc_id for r in D.decontaminate(docs, bench).collect()}
    assert left == {i for i, t in enumerate(TEXTS) if not brute(t, ITEMS)[1]}
    cut = {r.doc_id: r.text for r in D.decontaminate(docs, bench, mode="cut").collect()}
    assert cut[2] == "only  here" and cut[1] == " end" and cut[4] == TEXTS[4] and cut[6] is None
    with pytest.raises(ValueError):
        D.decontaminate(docs, bench, mode="other")


def test_awkward_rows_and_empty_tables(spark, bench):
    docs = awkward(spark)
    clean = D.decontaminate(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert D.report(docs, bench).count() == docs.count()
    assert D.decontaminate(empty(spark), bench).count() == 0
    assert D.report(docs, bench.where("item_id > 99")).where("n_hit > 0").count() == 0


def test_long_text_with_hits_at_its_ends(spark, bench):
    text = "rare words " + "filler " * 200_000 + "alpha beta gamma delta"
    row = D.report(spark.createDataFrame([(1, text)], "doc_id long, text string"), bench).first()
    assert (row.n_words, row.n_hit, list(row["items"])) == (200_006, 6, ["1"])
