"""Training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``; all but the last return
the columns of ``documents``:

1. language ID: documents without a language, or with an uncertain one, go;
2. n-gram Jaccard join: one document of each group of near copies stays: documents
   whose sets of five-word shingles are alike to 80 % or more are linked;
3. benchmark decontamination: documents with a benchmark window go;
4. mixing: documents as often as the mix takes them;
5. token ids: files of the mix; a row for each of its documents, read back.

Defined results, stage by stage: (1) a null text, or one without letters, has no
language and goes; a null lang teaches nothing; without any lang all documents stay;
(2) documents without words are in no group and stay, rows that repeat are one
group, of which one row stays; (3) a text shorter than a window has no hit and
stays; an empty benchmark hits nothing; (4) a null source is a source of its own,
documents without words are not taken; (5) null ids come first, rows with one id are
told apart. Columns beside those of documents pass through stages 1 to 4, whatever
their names; an empty table stays empty. Very long texts are read as a whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from commitlake.llm import decontaminate, jaccard_join, language_id, mixing
from commitlake.llm.common import prepare, table
from commitlake.llm.queries import token_report
from commitlake.session import scratch_path


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language_id.accepted(docs, language_id.train(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_join.one_of_each(docs, n=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), mode="drop")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    # its workers run other stages as well: remember less, and nothing between tasks
    return token_report(docs, known=50_000, keep=False)


STAGES = [
    ("language ID", detect_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("mixing sources", mix_sources),
    ("token ids", write_tokens),
]

#: The language network, the sampling hash and the tokenizer are not in SQL; the
#: tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
