"""From raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. ``run`` writes what a stage returns to the shared
folder and reads it again, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm import decontaminate, linededup, packing, quality, simhash
from patronlens.shared import delete, deleted_afterwards, new_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    accepted = quality.score(docs.select(F.struct("*").alias("document"), "doc_id", "text"), model).where("predicted = 1")
    return accepted.select("document.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of repeated windows; n_chars follows the text."""
    clean = linededup.dedup_lines(docs.select(F.struct("*").alias("document"), "doc_id", "text"))
    now = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return clean.select(*(now.get(c, F.col(f"document.`{c}`")).alias(c) for c in docs.columns))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies."""
    return simhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of token sequences, with their ids."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", token_packing),
]

# The classifier, the fingerprints and the tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, name)
        with deleted_afterwards(spark):  # what the stage wrote on its way
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
