"""Training-corpus pipeline over ``documents``: each stage reads what the one
before wrote as Parquet.  All stages but the last keep the columns of
``documents``; the last returns the packed pieces.

Edge cases are those of the operators; an empty table goes through all stages
as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notelab.llm import decontaminate, jaccard_join, line_dedup, packing, quality_rules
from notelab.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the base check or a learned rule rejects."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated long lines out of all documents but one."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: shingles of five words,
    similarity 0.8 or more (op2 has values of its own)."""
    return jaccard_join.keep_one(docs, k=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents with a passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the documents into token pieces and place them in sequences."""
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack(packing.token_pieces(docs, *paths))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("best-fit packing", pack),
]

#: Learned rules, hashing and tokenisation are beyond SQL; tests/llm compares
#: the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{i + 1}")
    return docs
