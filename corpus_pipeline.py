"""From raw documents to a training mix: each stage works on all that the one before kept.

All stages but the last return the columns of documents. Each is the operator's own filter with its own edge cases;
``n_chars`` follows the text where lines were dropped.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import blocks, chosen_path, decontaminate, fair_mix, line_templates, quality


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones outside the held-out fold, accepts."""
    model, _ = quality.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(model.column(F.col("text")) >= quality.ACCEPT)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of recurring templates."""
    kept = line_templates.drop_recurring(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, a similarity of 0.8 or more."""
    return chosen_path.one_of_each(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What each document gives to the mix."""
    return fair_mix.mix(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing),
]
ORACLE_SQL = None  # a fitted classifier has no SQL; the tests follow the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; what a stage returns is written to the shared folder and read again."""
    scratch = blocks.Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{k + 1}")
    return docs
