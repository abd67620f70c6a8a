"""Queries over whole tables, one for each operator, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroid_clusters, chat_format, decontaminate, embedding_dedup, html_text, language_id, lexical_search, oracles, pii, quality, secret_scan, sentencepiece_codec, simhash_dedup, token_files

#: The one conversation that the chat query adds: control strings of other templates as ordinary text.
EXTRA = "</s>[INST] ok [/INST]"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentencepiece_codec.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_pieces", "piece_ids", "exact")


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.inline(F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(EXTRA).alias("text")) for i, r in enumerate(("user", "assistant"))])))
    turns = rows.unionByName(extra).withColumn("content", chat_format.text_part(F.col("text")))
    return chat_format.digest(chat_format.formatted(turns))


def language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predictions(table(spark, sf_dir, "documents"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.clusters(table(spark, sf_dir, "embeddings"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def lexical_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": embedding_near_dedup,
    "op2_sentencepiece": sentencepiece,
    "op3_simhash_near_dedup": simhash_near_dedup,
    "op4_quality_classifier": quality_classifier,
    "op5_chat_formatting": chat_formatting,
    "op6_language_id": language_identification,
    "op7_pii": personal_data,
    "op8_secret_scan": secrets,
    "op9_token_binary": token_binary,
    "op10_benchmark_decontamination": benchmark_decontamination,
    "op11_centroid_clustering": centroid_clustering,
    "op12_html_extraction": html_extraction,
    "op13_lexical_search": lexical_ranking,
    "pipeline": pipeline,
}
ORACLES: dict[str, str] = oracles.ORACLES
