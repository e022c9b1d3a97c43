"""From raw documents to packed training windows: toxic documents go, exact and near copies go, what is left is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from touchline.llm import exact_dedup, jaccard_join, packing, toxicity
from touchline.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic at the threshold of the operator go; the model is fitted on labels of documents that are there."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts the document with the smallest id stays."""
    return jaccard_join.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in windows of 1024 tokens."""
    return packing.pack_documents(docs, 1024, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("packing", pack),
]

# Scores and tokens cannot be had in SQL; tests compare the kept rows of every stage, and run()'s pieces, with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
