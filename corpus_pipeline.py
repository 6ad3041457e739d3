"""Documents made ready for training, in stages that each keep their result.

Every stage takes the documents its predecessor kept and returns the columns of
``documents``; the last one returns where each row goes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import decontaminate, langid, mixing, resharding, simhash
from salesmart.llm.queries import held_out
from salesmart.sources.shared import store

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document is rejected if no language has so much of its letters.
LEAST_SHARE = 0.4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which two fifths of the letters are in one known language.
    Without a labelled document no language is known and none is left."""
    docs = docs.select(*COLUMNS)
    model = langid.train(docs.where(~held_out()))
    found = langid.identify(docs, model, spans=False)
    kept = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SHARE)
    return found.where(kept).select(*COLUMNS)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    docs = docs.select(*COLUMNS)
    return simhash.keep_one(docs, simhash.near_duplicates(docs)).select(*COLUMNS)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth repeats the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(docs.select(*COLUMNS), benchmark)
    return found.where(~F.col("contaminated")).select(*COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    docs = docs.select(*COLUMNS)
    return mixing.emit(mixing.mix(docs, mixing.source_targets(docs))).select(*COLUMNS)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each row, from the files that were written anew."""
    placed = resharding.reshard_files(docs.select(*COLUMNS)).withColumn("old_shard", resharding.hashed_shard())
    return placed.select("doc_id", "source", "size", "text_crc32", "old_shard", "shard", "slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_duplicates", distinct_texts),
    ("decontamination", clean_of_benchmark),
    ("mixing", mixed_sources),
    ("sharding", sharded),
]

#: SQL can express neither the language model nor the flow.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
