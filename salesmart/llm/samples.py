"""Bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """text and ``label`` (0 or 1) of at most ``rows`` documents, those of the smallest
    hashes of doc_id, so that every run takes the same.

    Labels other than 0 and 1, null labels and null ids are left out; of repeated
    labels of a document the larger counts, of its repeated rows each one.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias(label))
    # The ids are bounded by ``rows``, so the documents need not be shuffled.
    chosen = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return docs.select("doc_id", "text").join(chosen, "doc_id").select("text", F.col(label).cast("int").alias(label))
