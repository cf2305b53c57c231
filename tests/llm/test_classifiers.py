"""Language ID, toxicity and quality: held-out accuracy and defined results."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import TESTDATA
from helpers import awkward, empty
from pyspark.sql import functions as F

from commitlake.llm import language_id as L
from commitlake.llm import quality_classifier as Q
from commitlake.llm import queries
from commitlake.llm import toxicity as T

SF = f"{TESTDATA}/sf0.01"


def labelled(spark, rows, label):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], f"doc_id long, {label} int")


# --- language ID -----------------------------------------------------------


def test_language_on_held_out_documents(spark):
    found = queries.op2_language_id(spark, SF)
    assert found.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_gradients_equal_differences():
    r = np.random.default_rng(1)
    net = L.ByteNet(["a", "b", "c"])
    net.embed, net.filters = net.embed.astype(float), net.filters.astype(float)
    net.out = net.out.astype(float) * 5
    x, y = r.integers(90, 120, (6, L.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])
    loss = lambda: -np.log(net_probabilities(net, x)[np.arange(6), y]).mean()
    grads = net._gradients(x, y)
    for name, at in (("out", (3, 1)), ("filters", (1, 2)), ("embed", (100, 3))):
        w = getattr(net, name)
        w[at] += 1e-5
        up = loss()
        w[at] -= 2e-5
        down = loss()
        w[at] += 1e-5
        assert grads[name][at] == pytest.approx((up - down) / 2e-5, abs=2e-3)


def net_probabilities(net, x):
    _, values, _ = net._pool(x)
    top = np.maximum(values.reshape(len(x), -1, len(net.bias)).max(axis=1) + net.bias, 0)
    return L._softmax(top @ net.out + net.out_bias)


def test_language_of_every_window_counts(spark):
    docs = spark.createDataFrame(
        [(i, ["el perro y la casa son de todos nosotros ", "the dog and the house are all of ours "][i % 2] * 30, ["es", "en"][i % 2]) for i in range(80)],
        "doc_id long, text string, lang string",
    )
    net = L.train(docs, epochs=15)
    es, en = b"el perro y la casa son de todos nosotros ", b"the dog and the house are all of ours "
    assert [x[0] for x in net.predict([es * 9 + en * 300, es * 300 + en * 9, es, en])] == ["en", "es", "es", "en"]


def test_language_defined_results(spark):
    docs = awkward(spark)
    net = L.train(docs)
    assert net.classes == ["en", "fr"]
    rows = {r.doc_id: r.l for r in docs.select("doc_id", L.language(F.col("text"), net).alias("l")).collect()}
    for i in (0, 1, 2, 5):
        assert (rows[i].lang, rows[i].score) == ("und", 0.0)
    assert rows[9].lang in net.classes and rows[6] == rows[7]
    kept = L.accepted(docs, net)
    assert kept.columns == docs.columns and kept.where("doc_id IN (0, 1, 2, 5)").count() == 0
    none = L.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert list(none.predict([b"abc", None])) == [("und", 0.0)] * 2
    assert L.accepted(docs, none).count() == docs.count()
    one = L.train(docs.where("lang = 'en'"))
    assert list(one.predict([b"abc", b"?"])) == [("en", 1.0), ("und", 0.0)]
    assert L.train(empty(spark)).classes == [] and L.accepted(empty(spark), net).count() == 0


def test_language_sample_is_bounded_and_reads_whole_texts(spark):
    rows = [(i, f"{'abc ' * 200}{i} {'xyz ' * 100}", f"l{i % 7}") for i in range(210)]
    rows += [(None, "the same row", "l1")] * 300 + [(i, None, "l2") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    found = L.sample(docs, per_language=10, most=3)
    by = {}
    for lang, win in found:
        by.setdefault(lang, []).append(win)
    assert set(by) <= {"l1", "l0", "l2"} and len(by) == 3  # the most frequent, then the smallest
    assert all(len(w) <= 10 * 5 for w in by.values())
    assert any(w.startswith(b"xyz"[:1]) or b"xyz" in w for w in by["l0"])  # windows to the end of the text
    assert found == L.sample(docs.repartition(3), per_language=10, most=3)
    assert len(L.sample(docs, per_language=10, most=3, taught=5)) < len(found)


# --- toxicity --------------------------------------------------------------


def test_documents_of_one_class_only(spark):
    """Labels of both classes, but documents of one: its smoothed share."""
    docs = spark.createDataFrame([(i, f"w{i} idiot text") for i in range(6)], "doc_id long, text string")
    for found, want in ((1, 7 / 8), (0, 1 / 8)):
        rows = [(i, found) for i in range(6)] + [(100 + i, 1 - found) for i in range(50)]
        toxic = spark.createDataFrame(rows, "doc_id long, toxic int")
        assert T.train(docs, toxic).score("idiot") == pytest.approx(want)
        assert Q.train(docs, toxic.withColumnRenamed("toxic", "quality")).scores([b"idiot", None]).tolist() == pytest.approx([want, want])
    gone = spark.createDataFrame([(100, 0), (101, 1)], "doc_id long, toxic int")
    assert T.train(docs, gone).score("idiot") == 0.5
    assert Q.train(docs, gone.withColumnRenamed("toxic", "quality")).scores([b"idiot"]).tolist() == [0.5]


def test_counterfactual_sentences_are_of_whole_texts(spark):
    text = "one two three four five. " * 40 + "the muslim family lives here."
    sampled = spark.createDataFrame([(1, 0, text), (2, 1, "a b c d e.")], "doc_id long, y int, text string")
    known = {w: i for i, w in enumerate(sorted({*T.words(text), *T.words("a b c d e")}))}
    found = T.mentions(sampled, known)
    assert len(found) == 42 and known[b"muslim"] in found[0]
    assert T.mentions(sampled, known, 1) == found[:1]


def auc(score, y):
    order = np.argsort(np.argsort(score)) + 1
    n1, n0 = sum(y), len(y) - sum(y)
    return (order[np.array(y) == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_toxicity_on_held_out_documents(spark):
    sf = f"{TESTDATA}/sf0.1"
    found = queries.op9_toxicity(spark, sf)
    assert found.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    assert auc([r.score for r in rows], [r.toxic for r in rows]) > 0.97
    assert np.mean([r.predicted == 1 for r in rows if r.toxic == 0]) < 0.01
    assert all(r.predicted == (r.score >= 0.5) for r in rows)


def biased(r, n=1500):
    """Insults are toxic; ``muslim`` is named in toxic texts more often."""
    rows = []
    for i in range(n):
        toxic = int(i % 4 == 0)
        w = [f"w{r.randrange(200)}" for _ in range(20)]
        if toxic:
            w[3] = r.choice(["idiot", "moron"])
        if r.random() < (0.8 if toxic else 0.05):
            w[7] = "muslim"
        rows.append((i, " ".join(w) + ".", toxic))
    return rows


def test_counterfactuals_lower_the_weight_of_identity_terms(spark):
    docs, labels = labelled(spark, biased(random.Random(1)), "toxic")
    fair, plain = T.train(docs, labels, fair=20.0), T.train(docs, labels, fair=0.0)
    neutral = "the muslim family lives here with the christian family"
    assert plain.weights[b"muslim"] > 0.4
    assert abs(fair.weights.get(b"muslim", 0)) < 0.4 * plain.weights[b"muslim"]
    assert fair.score(neutral) < 0.3
    assert fair.score("you idiot w1 w2") > 0.5

    def change(model):  # of the logit, when one group is named in place of another
        logits = [np.log(p / (1 - p)) for p in (model.score(neutral), model.score(neutral.replace("muslim", "jewish")))]
        return abs(logits[0] - logits[1])

    assert change(fair) < 0.4 * change(plain)


def test_toxicity_defined_results(spark):
    docs, labels = labelled(spark, biased(random.Random(2), 200), "toxic")
    labels = labels.union(labels.limit(5)).union(spark.createDataFrame([(None, 1), (3, None)], labels.schema))
    model = T.train(docs.union(docs.limit(3)), labels)
    assert model.score(None) == model.score("") == model.score("unknownword") < 0.5
    assert model.score("x " * 300_000 + "IDIOT") == model.score("idiot x")
    rows = awkward(spark).select("doc_id", T.toxicity(F.col("text"), model).alias("s")).collect()
    assert len(rows) == awkward(spark).count() and all(0 <= r.s <= 1 for r in rows)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert T.train(docs, none).score("idiot") == 0.5
    assert T.train(docs, labels.where("toxic = 0")).score("idiot") < 0.05


# --- quality ---------------------------------------------------------------


def test_quality_on_held_out_documents(spark):
    sf = f"{TESTDATA}/sf0.1"
    found = queries.op10_quality_classifier(spark, sf)
    assert found.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    assert auc([r.score for r in rows], [r.quality for r in rows]) > 0.95
    # calibrated: the mean score is about the share of good documents
    assert abs(np.mean([r.score for r in rows]) - np.mean([r.quality for r in rows])) < 0.06


def test_random_indexing_puts_words_of_like_contexts_together():
    r = random.Random(3)
    texts = []
    for _ in range(400):
        kind = r.choice(["ab", "xy"])
        texts.append([w.encode() for _ in range(10) for w in (f"{kind}before", r.choice([f"{kind}one", f"{kind}two"]), f"{kind}after")])
    v = Q.WordVectors(texts)
    at = lambda w: v.table[v.number[b"l:" + w]]
    assert at(b"abone") @ at(b"abtwo") > 0.95 > at(b"abone") @ at(b"xyone") + 0.3
    p, q = v.pool([texts[0], []])
    assert np.isfinite(p).all() and not q[: 2 * Q.DIMENSIONS].any()


def test_pooling_blocks_do_not_matter(monkeypatch):
    r = random.Random(4)
    texts = [[f"w{r.randrange(30)}".encode() for _ in range(r.randrange(40))] for _ in range(60)]
    v = Q.WordVectors(texts)
    whole = v.pool(texts)
    monkeypatch.setattr(Q, "_BLOCK", 10)
    monkeypatch.setattr(Q, "_REMEMBERED", 5)
    assert np.allclose(whole, v.pool(texts), atol=1e-5)


def test_quality_defined_results(spark):
    r = random.Random(5)
    rows = [(i, " ".join(f"w{r.randrange(90)}" + ("##$" if i % 3 == 0 else "") for _ in range(25)), int(i % 3 != 0)) for i in range(300)]
    docs, labels = labelled(spark, rows, "quality")
    labels = labels.union(labels.limit(5)).union(spark.createDataFrame([(None, 1), (3, None)], labels.schema))
    model = Q.train(docs.union(docs.limit(3)), labels)
    good, bad, null, none, long = model.scores([b"w1 w2 w3 w4", b"w1##$ w2##$ w3##$", None, b"", b"w1 w2 w3 " * 200_000])
    assert good > 0.7 > bad and null == none and 0 <= long <= 1
    found = awkward(spark).select("doc_id", Q.quality(F.col("text"), spark.sparkContext.broadcast(model)).alias("s"))
    assert found.count() == awkward(spark).count() and all(0 <= x.s <= 1 for x in found.collect())
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.train(docs, nothing).scores([b"a"]).tolist() == [0.5]
    assert Q.train(docs, labels.where("quality = 1")).scores([None])[0] > 0.9


def test_quality_learns_from_whole_texts_and_all_documents(spark):
    r = random.Random(8)
    rows = [(" ".join(f"w{r.randrange(40)}" for _ in range(1200)), i % 2) for i in range(12)]
    # words in the middle of one long labelled text, repeated in documents without labels
    texts = [t if i else t.replace(" ", " rareword ", 600).replace(" rareword ", " ", 599) for i, (t, _) in enumerate(rows)]
    texts += ["w1 w2 rareword w3 w4"] * 5 + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, quality int")
    v = Q.train(docs, labels).vectors
    assert b"l:rareword" in v.number
    names = sorted(v.number)
    alone = Q.Contexts(names)
    alone.add_all([(t or "").encode().split() for t in texts])
    assert np.allclose(v.table, Q.WordVectors([], names, alone.sums.astype(np.float32)).table)
    # the sums against every pair of words
    want, index = np.zeros(Q.DIMENSIONS), dict(zip(names, Q.index_vectors(names)))
    for t in texts:
        w = (t or "").encode().split()
        for i in (i for i, x in enumerate(w) if x == b"rareword"):
            for j in range(max(i - Q.REACH, 0), min(i + Q.REACH + 1, len(w))):
                if j != i:
                    want += sum(index.get(p, 0) for p in Q.parts(w[j]))
    assert np.allclose(alone.sums[alone.number[b"l:rareword"]], want)
