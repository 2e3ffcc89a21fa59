"""Helpers shared by the operators: words, bounded broadcasts, lineage cuts."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vodlens.session import ensure_checkpoint_dir

# Words are maximal runs of characters other than ASCII white space.
WHITE = " \t\n\x0b\x0c\r"
SPACE_RE = r"[\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20  # text split into words at once
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text; an empty array for null, empty or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RE))


def word_slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, as lists of the words of about ``SLICE_BYTES`` each."""
    at = 0
    while at < len(text):
        gap = _BLANK.search(text, at + SLICE_BYTES)
        end = gap.start() if gap else len(text)
        yield text[at:end].split()
        at = end


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder: shorter lineage, survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def small(df: DataFrame, bound: int) -> DataFrame:
    """``df`` (already cut) with a broadcast hint if it has at most ``bound``
    rows; beyond that unchanged, and Spark joins it by shuffle."""
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def text_bytes(docs: DataFrame, col: str = "text") -> int:
    """UTF-8 bytes of all texts: one aggregation, used to size partitions."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(col)), F.lit(0))).first()[0]


def parts_for(n_bytes: int, per_part: int, least: int = 8) -> int:
    """Partitions so that each holds about ``per_part`` bytes, at any input size."""
    return max(least, -(-int(n_bytes) // per_part))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file; installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def shield(docs: DataFrame) -> DataFrame:
    """Every column renamed, so that no operator's own names can clash."""
    return docs.select(*[F.col(f"`{c}`").alias(f"_in_{c}") for c in docs.columns])


def unshield(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`_in_{c}`").alias(c) for c in columns])
