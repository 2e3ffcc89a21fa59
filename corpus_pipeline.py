"""The corpus pipeline: raw documents to packed training sequences.

Each stage is one operator of ``vodlens.llm`` applied to all that the stage before
kept; all but the last return the columns of documents.

1. quality rules: documents that the rules or the likelihood ratio reject go;
2. n-gram Jaccard join: one document of each group of near copies stays;
3. PII: spans are redacted in the text;
4. mixing: documents are repeated or sampled to the sources' target weights;
5. packing: the mixture becomes pieces of sequences of 2,048 tokens.

Sampling and trained trees cannot be written in SQL, so ORACLE_SQL is None and
the stages are tested against brute force in tests/llm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vodlens.llm import jaccard, mixing, packing, pii, quality
from vodlens.llm.common import read_table, tokenizer_path
from vodlens.session import scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trusted = read_table(spark, sf_dir, "labels").where("quality = 1")
    return quality.quality_filter(docs, quality.fit_ratios(docs, trusted))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path(), tokenizer_path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality rules", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", redact),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written as Parquet and read again."""
    df = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{i}")
        stage(spark, df, sf_dir).write.parquet(path)
        df = spark.read.parquet(path)
    return df
