"""Registered queries of this subpackage over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import decontaminate, embeddings, langid, mixing, quality, ranked, resharding, samples, secrets, simhash
from salesmart.llm import sketch, spelling, toxicity, warc

#: One in so many documents is held out of training.
FOLDS = 5
#: One in so many runs of letters loses one, so that misspellings are known.
MISSPELT = 31

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether labels of this document are kept from training.  A null id counts as
    the text 'null'."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [rule.kind for rule in secrets.BASE]
    counts = [F.size(secrets.of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in base]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.listed(secrets.of_kind(*base)), 256).alias("base_sha256"),
        secrets.listed(F.col("secrets")).alias("spans"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    page_of = F.udf(warc.page_of, "long", useArrow=True)
    return warc.whole_records(found).select(
        page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_of("refers_to").alias("refers_to"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprint_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out())
    model = langid.train(docs.where(~F.col("held_out")))
    found = langid.identify(docs.select("doc_id", "text", "held_out"), model, spans=False)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op6_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = resharding.reshard_files(docs)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, mixing.source_targets(docs))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def _judged(found: DataFrame, least: float) -> DataFrame:
    return found.select("doc_id", "held_out", "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out())
    labels = table(spark, sf_dir, "labels").where(~held_out())
    trained = toxicity.train(docs, samples.labelled(docs, labels, "toxic", toxicity.SAMPLE))
    return _judged(toxicity.score(docs, trained), 0.5)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out())
    labels = table(spark, sf_dir, "labels").where(~held_out())
    model = quality.train(samples.labelled(docs, labels, "quality", quality.SAMPLE))
    return _judged(quality.score(docs, model), 0.3)


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked.best_documents(docs, table(spark, sf_dir, "benchmark"))


def op12_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents"), every=MISSPELT)
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Query] = {
    "op1_secrets": op1_secrets,
    "op2_warc": op2_warc,
    "op3_simhash": op3_simhash,
    "op4_fingerprints": op4_fingerprints,
    "op5_language": op5_language,
    "op6_reshard": op6_reshard,
    "op7_decontaminate": op7_decontaminate,
    "op8_mix": op8_mix,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_ranked": op11_ranked,
    "op12_embeddings": op12_embeddings,
    "op13_spelling": op13_spelling,
}
