"""Corpus pipeline: quality rules, line dedup, n-gram Jaccard join, mixing to target weights, BPE encoding.

Documents are told by doc_id where copies go: rows of one doc_id stay or go together, so repeated rows of a document that stays all
stay. Rows without a doc_id are never dropped as copies, as no id says which of them is meant. Empty tables give an empty
result; without labels of both kinds the base rules alone decide.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sharewright.llm import bpe_trie, jaccard_pivots, line_windows, mixing, quality_rules
from sharewright.llm.queries import table, tokenizer_path
from sharewright.session import Stages

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list rejects."""
    kept = quality_rules.judge(docs, table(spark, sf_dir, "labels"), *[c for c in COLUMNS if c not in ("doc_id", "text")],
                               F.col("text").alias("whole_text"))
    return kept.filter("kept").select("doc_id", F.col("whole_text").alias("text"), "lang", "source", "n_chars")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated line windows; documents of which nothing is left go."""
    got = line_windows.drop_repeated_windows(docs.select(*COLUMNS))
    return got.filter("n_removed = 0 or n_removed < n_lines").select(
        "doc_id", "text", "lang", "source",
        F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents."""
    found = Stages(spark, "near")(jaccard_pivots.near_duplicates(docs.select("doc_id", "text")), "groups")
    drop = found.filter("n_shingles > 0 and doc_id <> component_id").select("doc_id").distinct()
    # texts are moved by the same kind of join at every size
    return docs.select(*COLUMNS).join(drop.hint("merge"), "doc_id", "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the calibrated probabilities."""
    return mixing.mix(docs.select(*COLUMNS)).filter("mix_kept").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe_trie.encode_digests(docs, tokenizer_path())


STAGES = [("quality_rules", quality), ("line_dedup", line_dedup), ("jaccard_join", near_duplicates),
          ("source_mixing", mix), ("bpe_encoding", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stages = Stages(spark, "corpus")
    for name, stage in STAGES:
        docs = stages(stage(spark, docs, sf_dir), name)
    return docs


#: The learned rules, the raking and the encoding cannot be said in SQL; a test compares every stage with brute force.
ORACLE_SQL = None
