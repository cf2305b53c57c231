"""Bounded labelled samples for the classifiers that are trained on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """doc_id, y, text of at most ``per_class`` labelled documents of each class.

    Chosen by a hash of the id among all labels; an id labelled more than once
    counts by its smallest label, and of rows with one id the smallest text is
    taken. The ids are few by construction, so they are broadcast and the texts
    are found without a shuffle of the documents.
    """
    rated = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    rated = rated.groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = rated.where("y = 0").orderBy(*order).limit(per_class)
    picked = picked.unionByName(rated.where("y = 1").orderBy(*order).limit(per_class))
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return found.select("doc_id", "y", "text")


def class_counts(labels: DataFrame, label: str) -> tuple[int, int]:
    """Labelled rows of class 0 and of class 1."""
    row = labels.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")).first()
    return row.n0, row.n1
