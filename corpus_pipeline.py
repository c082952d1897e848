"""A corpus from raw documents to packed training sequences, in five stages.

Each stage works on what its predecessor kept, written as Parquet and read again. Up to
the mix, stages return the columns of ``documents``; the last returns packed pieces.

Defined cases: documents with null or blank text count as clean, pass the line and Jaccard
stages, and are never taken by the mix; without labels of both kinds nothing is toxic; of
rows that repeat a doc_id and text one stays; rows without doc_id are never taken for
copies; a null source is a source of its own; empty documents give no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import jaccard, lines, mixing, packing, toxicity
from tidemark.session import fresh_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the rejecting one."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without fuzzy repeats of lines; documents that had nothing else go."""
    return lines.without_repeats(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles have a similarity of 0.8 or more."""
    return jaccard.without_copies(docs, n=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, documents repeated whole and in part."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences that fill windows of 2048."""
    return packing.packed(docs, packing.tokenizer_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_documents),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: MinHash, learned models and packing have no SQL form; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
