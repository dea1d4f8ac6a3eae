"""Corpus pipeline: raw documents to sampled training pieces.

Each stage takes the documents that the stage before has kept and returns
them with the columns of documents; the last adds the piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockroom.llm import mixing, ngram_join, piece_sampling, quality_rules, resampling
from stockroom.llm.queries import good_label, table
from stockroom.session import cut_lineage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their boilerplate lines."""
    return quality_rules.cleaned_documents(docs)


def keep_likely(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling takes."""
    return resampling.resampled_documents(docs, table(spark, sf_dir, "labels"), good_label())


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_of_each(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document taken several times is repeated."""
    return mixing.mixed_documents(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their sampled piece ids."""
    return piece_sampling.encode_documents(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("quality classifier", keep_likely),
    ("n-gram jaccard join", keep_one_copy),
    ("mixing sources", mix_to_weights),
    ("sentencepiece", to_pieces),
]

# Learned weights, component search and sampled pieces: not for SQL. The
# tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
