"""Corpus preparation: quality, near-duplicates, benchmark leaks, personal data, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns
of documents; the last adds ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlens.llm import decontaminate, pii, quality, sentencepiece_codec, simhash_dedup
from roadlens.llm.common import drop_path, new_path
from roadlens.llm.queries import table, tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled rows among them, does not reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash_dedup.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the names of its kinds."""
    return pii.masked(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with piece_ids, n_pieces and whether they decode to the text."""
    return sentencepiece_codec.encoded(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("PII", mask_personal_data),
    ("SentencePiece", encode_pieces),
]
#: The classifier and the encoder cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage wrote is deleted when the next has written; the last of them stays, as the result reads it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs.write.parquet(path := new_path(spark, "stage"))
            if before:
                drop_path(spark, before)
            docs, before = spark.read.parquet(path), path
    return docs
