from __future__ import annotations

import collections
import random
import re
from math import comb

import pytest
from conftest import TESTDATA
from helpers import awkward, empty, random_text
from pyspark.sql import functions as F

from commitlake.llm import quality_rules as Q
from commitlake.llm import queries

SPACE = r"\x20\x09-\x0D"


def brute(text):
    t = text or ""
    w = re.findall(f"[^{SPACE}]+", t)
    wins = list(zip(w, w[1:], w[2:]))
    c = collections.Counter(wins)
    hit = {i + j for i, x in enumerate(wins) if c[x] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if re.search(f"[^{SPACE}]", x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), len(lines),
        len(re.findall(f"[A-Z]", t)),
    )


def test_counts_equal_brute_force():
    r = random.Random(1)
    texts = [None, "", "a", "a a a a", "a b c a b c", "x\n x\nx\n\n\t\n x", "É日 # $| < >", "a\x1cb\x85c d"]
    texts += [random_text(r, r.randrange(200), r.choice([2, 5, 500])) for _ in range(200)]
    got = list(Q.count([t.encode() if t is not None else None for t in texts]))
    assert got == [brute(t) for t in texts]


def test_most_rejected_is_the_exact_binomial_bound():
    for n, risk, alpha in ((10, 0.3, 0.05), (200, 0.05, 0.01), (40, 0.01, 0.001)):
        k = Q.most_rejected(n, risk, alpha)
        tail = lambda k: sum(comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(k + 1))
        assert (k == -1 or tail(k) <= alpha) and tail(k + 1) > alpha
    assert Q.most_rejected(0, 0.1, 0.05) == -1


@pytest.fixture(scope="module")
def counted(spark):
    """Two strata; bad documents of ``a`` have many symbols."""
    r = random.Random(5)
    rows = []
    for i in range(6000):
        bad = i % 10 == 0
        text = " ".join(f"w{r.randrange(5000)}" + ("#$" if bad else "") for _ in range(60))
        rows.append((i, "a" if i % 4 else None if i % 8 else "few", text, not bad))
    df = spark.createDataFrame(rows, "doc_id long, stratum string, text string, good boolean").repartition(4)
    return df.withColumn("c", Q.text_counts(F.col("text"))).select("doc_id", "stratum", "good", "c.*").cache()


def test_cutoffs_keep_good_documents(counted):
    judged = Q.with_verdict(counted, F.col("good")).collect()
    a = [r for r in judged if r.stratum == "a"]
    assert sum(not r.kept for r in a if r.good) <= Q.RISK * sum(r.good for r in a)
    assert not any(r.kept for r in a if not r.good)
    # too few labels vouch for nothing, so nothing is rejected
    few = counted.where("stratum = 'few'").limit(150)
    assert all(r.kept for r in Q.with_verdict(few, F.col("good")).collect())


def brute_rules(rows, risk=Q.RISK, alpha=Q.ALPHA):
    """stratum -> (cutoff of each feature, n), from rows of (stratum, levels, good)."""
    names, out = list(Q.features()), {}
    strata = {r[0] for r in rows if r[2]}
    for s in strata:
        own = [r for r in rows if r[0] == s]
        good = [r for r in own if r[2]]
        allowed = Q.most_rejected(len(good), risk, alpha / len(strata))
        for t in Q.STEPS:
            # the lowest level from the second on that a share of t or less reaches
            cut = [next((x for x in range(1, Q.GRID + 1) if sum(r[1][f] >= x for r in own) <= t * len(own)), None) for f in range(len(names))]
            if sum(any(c is not None and r[1][f] >= c for f, c in enumerate(cut)) for r in good) > allowed:
                break
            out[s] = ({names[f]: c for f, c in enumerate(cut) if c is not None}, len(good))
    return out


def rows_of(counted):
    found = counted.where(~Q.base_failed()).select("stratum", "good", *(Q.level(c).alias(f) for f, c in Q.features().items()))
    return [(r.stratum, [r[f] for f in Q.features()], bool(r.good)) for r in found.collect()]


def test_cutoffs_equal_brute_force(counted):
    chosen = {}
    for r in Q.cutoffs(counted.where(~Q.base_failed()), F.col("good")).collect():
        chosen.setdefault(r.stratum, ({}, r.n))[0][r.feature] = r.cutoff
    want = brute_rules(rows_of(counted))
    assert chosen == want and set(want) == {"a", "few", None}


def test_kept_equals_brute_force(spark):
    """The query's verdicts, over its own table and labels."""
    sf = f"{TESTDATA}/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("lang").alias("stratum"), F.col("text"))
    quality = {}
    for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality IS NOT NULL").collect():
        quality[r.doc_id] = min(quality.get(r.doc_id, 1), r.quality)
    counted = docs.select("doc_id", "stratum", Q.text_counts(F.col("text")).alias("c")).select("doc_id", "stratum", "c.*")
    found = counted.select("doc_id", "stratum", Q.base_failed().alias("failed"), *(Q.level(c).alias(f) for f, c in Q.features().items())).collect()
    rows = [(r.stratum, [r[f] for f in Q.features()], quality.get(r.doc_id) == 1) for r in found if not r.failed]
    rules, names = brute_rules(rows), list(Q.features())
    want = {}
    for r in found:
        cuts = rules.get(r.stratum, ({}, 0))[0]
        want[r.doc_id] = not r.failed and not any(r[f] >= cuts[f] for f in names if f in cuts)
    assert {r.doc_id: r.kept for r in queries.op7_quality_rules(spark, sf).collect()} == want


def test_false_rejection_stays_within_the_risk():
    """Simulated: of many samples of good documents, few choose a rule that rejects more."""
    r, n, risk, alpha = random.Random(3), 400, Q.RISK, Q.ALPHA
    allowed, bad = Q.most_rejected(n, risk, alpha), 0
    rates = [0.001 * k for k in range(1, 60)]  # of the rules, lax to strict
    for _ in range(600):
        draws = sorted(r.random() for _ in range(n))
        chosen = 0.0
        for rate in rates:
            if sum(x < rate for x in draws) > allowed:
                break
            chosen = rate
        bad += chosen > risk
    assert bad / 600 <= alpha + 0.02


def test_columns_of_the_same_names_are_replaced(spark, counted):
    rows = counted.limit(50).withColumn("kept", F.lit("own")).withColumn("of_stratum", F.lit(1)).withColumn("cutoff_upper", F.lit(2))
    judged = Q.with_verdict(rows, F.col("good"))
    assert judged.columns.count("kept") == 1 and judged.schema["kept"].dataType.simpleString() == "boolean"
    assert judged.where("of_stratum = 1 AND cutoff_upper = 2").count() == 50


def test_awkward_rows_and_empty_tables(spark):
    for docs in (awkward(spark), empty(spark)):
        c = docs.withColumn("c", Q.text_counts(F.col("text"))).select("doc_id", F.col("lang").alias("stratum"), "c.*")
        judged = Q.with_verdict(c, F.lit(False)).collect()
        assert len(judged) == docs.count()
        for r in judged:
            assert r.kept == (not r.base_failed)
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
