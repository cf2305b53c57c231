"""Shared fixtures: a table of awkward documents, and readers."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
EXTRA = ("hits", "size", "KEY", "text_hash", "source_size", "n", "node", "label", "found_language", "document", "t", "x")


def random_text(r: random.Random, n: int, words: int = 60) -> str:
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


def awkward(spark, extra: bool = True):
    """Null ids, texts and sources, empty and long texts, repeated rows."""
    r = random.Random(4)
    long = random_text(r, 30_000, 5000)
    texts = [None, "", "   \n\t ", "one", "two words", "??? !!!", long, long, "A\nb\nA\nb", "\u00c9t\u00e9 \u65e5\u672c \U0001f600"]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, None) for i, t in enumerate(texts)]
    rows += [(None, "no id here", "en", "s1", 1), (None, None, None, None, None), (None, "no id here", "en", "s1", 1)]
    rows += [(50, "the same row again and again", "fr", "s2", 5)] * 4
    rows += [(50, "another text of the same id", "fr", "s2", 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        for name in EXTRA:
            df = df.withColumn(name, F.lit(f"own {name}"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
