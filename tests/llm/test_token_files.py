from __future__ import annotations

import functools
import random
import uuid

import numpy as np
import pytest
from helpers import awkward, empty

from commitlake.llm import token_files as T
from commitlake.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
FILE = public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


def plain(text, end=2):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [end]


def fresh(spark):
    return scratch_path(spark, f"test-tokens-{uuid.uuid4().hex}")


def ids(raw):
    return np.frombuffer(bytes(raw), "<u4").tolist()


def ids32(raw):
    return np.frombuffer(raw, np.uint16).tolist()


ODD = [
    "", " ", "  ", "a  b", "a \n b", "\n\nx", " lead", "trail ", "don't we'll", "a,b, c.", "x  <|endoftext|> y", "<|endoftext|>", "nul\0nul b",
    "Été 日本語 \U0001f600 ß.", "tab\there", "a b  c", "123 45,6", "...!! ?", "\r\n \r\n", "A" * 3000, "word.\nNext line",
]


def test_encoder_equals_a_plain_encode():
    r = random.Random(3)
    alphabet = list("ab \n.,'1é日 ") + ["  ", "the ", " ing"]
    texts = ODD + ["".join(r.choice(alphabet) for _ in range(40)) for _ in range(300)]
    e = T.Encoder(FILE, 2)
    for _ in range(2):  # the second time from memory
        got = [np.frombuffer(x, np.uint16).tolist() for x in e.encode([*texts, None])]
        assert got == [plain(t) for t in [*texts, None]]


def test_encoder_merges_new_tokens_together():
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghij") for _ in range(9)) for _ in range(640)]
    texts, calls = [" ".join(r.sample(words, 300)) + "." for _ in range(40)], []
    e = T.Encoder(FILE, 2)
    merge = e.merge
    e.merge = lambda x: calls.append(x) or merge(x)
    assert [ids32(x) for x in e.encode(texts)] == [plain(t) for t in texts]
    assert 0 < len(calls) <= 24 and max(map(len, calls)) < 1000  # was a call for every word
    e.encode(texts)
    assert len(calls) <= 24


@pytest.mark.parametrize(("known", "nul"), [(0, True), (7, True), (100_000, False)])
def test_encoder_splits_like_the_tokenizer(known, nul):
    r = random.Random(8)
    signs = ["'", "'s", "'ll", "\u2019", "×", "÷", "é", "ß", "Ã", "ÿ", "ª", "²", "٣", "日本", "\U0001f600", "e\u0301", "\x1c", "\x85", "\xa0", "\u3000"]
    signs += ["\n", "\n\n", "\t", "\v", "\r\n", " ", "  ", "a", "Word", "12", "_", "-", ",", "...", "<|endoftext|>", "\0", "\x7f", "\ufeff"]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(12))) for _ in range(3000)] + [a + b for a in signs for b in signs]
    e = T.Encoder(FILE, 2, known)
    if not nul:
        e.nul = None  # as for a tokenizer without a character that stays alone
    got = [x for at in range(0, len(texts), 500) for x in e.encode(texts[at : at + 500])]
    wrong = [t for t, x in zip(texts, got, strict=True) if ids32(x) != plain(t)]
    assert wrong == [] and len(e.known) <= known


def test_other_tokenizers_are_encoded_whole():
    from tokenizers import Tokenizer

    file = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(file).encode("Some words, here", add_special_tokens=False).ids
    assert np.frombuffer(T.Encoder(file, 7).encode(["Some words, here"])[0], np.uint16).tolist() == [*whole, 7]
    assert T.id_type(70_000, 2) == "I" and T.id_type(65_536, 2) == "H" and T.id_type(10, 70_000) == "I"


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 5000])
def test_perfect_hash_is_a_bijection(n):
    r = np.random.default_rng(n)
    h1, h2 = r.integers(0, 2**64, (2, n), dtype=np.uint64)
    moves, seed = T.perfect_hash(h1, h2)
    assert sorted(T.slots(h1, h2, moves, n, seed).tolist()) == list(range(n))


def test_round_trip_lookup_and_absent_keys(spark):
    r = random.Random(1)
    texts = {i * 7: " ".join(f"word{r.randrange(99)}" for _ in range(r.randrange(80))) for i in range(700)}
    texts[3] = None
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    path = fresh(spark)
    T.write(docs, path, FILE, 2, shard_bytes=40_000, bucket=64)
    files = T.TokenFiles(spark, path)
    got = {x.key: x for x in files.read_all().collect()}
    start = 0
    for key in sorted(texts):
        want = plain(texts[key])
        assert (got[key].start, got[key].n, ids(got[key].ids)) == (start, len(want), want)
        start += len(want)
    assert files.table("shards").count() >= 4
    asked = spark.createDataFrame([(3,), (14,), (15,), (14,), (-1,)], "key long")
    assert {x.key: ids(x.ids) for x in files.read(files.lookup(asked)).collect()} == {3: plain(None), 14: plain(texts[14])}
    # the files hold the ids and nothing else
    raw = b"".join(bytes(x.content) for x in spark.read.format("binaryFile").load(f"{path}/ids").orderBy("path").collect())
    assert np.frombuffer(raw, "<u2").tolist() == [t for k in sorted(texts) for t in plain(texts[k])]


def test_rows_with_one_key_over_many_shards(spark):
    rows = [(5, f"text number {i % 40} of five") for i in range(400)] + [(4, "four"), (6, "six"), (None, "none"), (None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    files = T.write(docs, fresh(spark), FILE, 2, shard_bytes=1500, bucket=32)
    got = files.read_all().collect()
    assert len(got) == 404 and files.table("shards").count() > 3
    assert sorted(x.copy for x in got if x.key == 5) == list(range(400))
    assert sorted(map(tuple, (ids(x.ids) for x in got))) == sorted(tuple(plain(t)) for _, t in rows)
    starts = sorted((x.start, x.n) for x in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0
    assert [x.key for x in sorted(got, key=lambda x: x.start)][:3] == [None, None, 4]


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    got = T.write(docs, fresh(spark), FILE, 2).read_all().collect()
    assert sorted(tuple(ids(x.ids)) for x in got) == sorted(tuple(plain(r.text)) for r in docs.collect())
    assert T.write(empty(spark), fresh(spark), FILE, 2).read_all().count() == 0
