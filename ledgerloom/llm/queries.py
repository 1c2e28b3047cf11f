"""One registered query for each operator, on its whole table, and SQL where SQL can say it.

A query hands the table to its operator and keeps the columns that the result
is compared by; it filters nothing.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import chosen_path, decontaminate, fair_mix, filter_audit, fuse_dedup, line_templates, lpf_dedup, ngram_lm, pivot_search, quality, token_alignment, token_counts, window_dedup

QUERIES: dict = {}
ORACLES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_substring_dedup(spark, sf_dir):
    """Words outside repeated windows of 35 words."""
    return window_dedup.repeated_windows(table(spark, sf_dir, "documents"), length=35)


@query
def op10_fair_mix(spark, sf_dir):
    """Words that each document gives to a mix by weighted fair queueing."""
    return fair_mix.mix(table(spark, sf_dir, "documents"))


ORACLES["op10_fair_mix"] = fair_mix.SQL


@query
def op2_line_templates(spark, sf_dir):
    """What documents keep when lines of recurring templates are dropped."""
    return line_templates.report(table(spark, sf_dir, "documents"))


ORACLES["op2_line_templates"] = line_templates.SQL


@query
def op3_exact_dedup(spark, sf_dir):
    """Which document stays for each text."""
    return fuse_dedup.exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op3_exact_dedup"] = fuse_dedup.SQL


@query
def op8_decontaminate(spark, sf_dir):
    """Words and items of the benchmark in each document."""
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


@query
def op9_suffix_dedup(spark, sf_dir):
    """Bytes outside strings of 50 bytes that an earlier document has."""
    return lpf_dedup.earlier_copies_removed(table(spark, sf_dir, "documents"), length=50)


@query
def op5_near_duplicates(spark, sf_dir):
    """Components of documents whose shingle sets are alike to 85 %."""
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query
def op6_quality(spark, sf_dir):
    """Calibrated quality of each document."""
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_ngram_scores(spark, sf_dir):
    """Language-model scores of all documents."""
    return ngram_lm.scored(table(spark, sf_dir, "documents"))


@query
def op1_token_counts(spark, sf_dir):
    """Tokens of each document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op13_filter_audit(spark, sf_dir):
    """Survivors, losses and shares of five filters in every order."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = filter_audit.SQL


@query
def op12_top_k(spark, sf_dir):
    """The five rows of highest inner product for each query."""
    return pivot_search.top_k(table(spark, sf_dir, "embeddings"))


ORACLES["op12_top_k"] = pivot_search.SQL


@query
def op11_token_alignment(spark, sf_dir):
    """Links between the tokens of two tokenizers, and how usual they are."""
    return token_alignment.alignment(table(spark, sf_dir, "documents"))
