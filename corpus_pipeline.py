"""A training corpus from raw documents: filter, deduplicate, mix and pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Stages
keep rows as they are but for what they decide: line dedup rewrites text and n_chars of documents that lose lines and
drops documents that lose all; the mix repeats a row as often as it takes it.

Null, empty and wordless texts fail the base rules and go at the first stage; null sources are a source of their own. Rows
without an id stay, as the near-duplicate stage can't name them, and of rows of one id and text one stays. Very long texts
are taken whole. An empty table of documents gives an empty result; without labels the base rules alone reject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from tidemark.llm.queries import TOKENIZERS
from tidemark.llm.tables import read_texts, saved


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned ones reject."""
    return quality_rules.keep_good(docs, read_texts(spark, f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated line runs."""
    cleaned = line_dedup.dedup_lines(docs).where("n_deleted = 0 or text <> ''")
    n_chars = F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", n_chars).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    taken = mixing.mix(docs).where("copies > 0")
    return taken.withColumn("_copy", F.explode(F.expr("sequence(1, copies)"))).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    return packing.pack(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_copies),
    ("source_mixing", mix),
    ("best_fit_packing", pack),
]

#: SQL can't express the learned rules, the sampling or the packing; tests hold the first three stages against brute force and
#: the mix against its targets, and the packing in tests of its operator.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table documents, each result saved in the shared folder."""
    docs = read_texts(spark, f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
