"""Quality rules with a hashed n-gram log-likelihood ratio (native).

Two multinomials over ``buckets`` hashed 1- and 2-grams are estimated: one from
trusted documents (target), one from the whole raw corpus.  A document's score is
the mean over its grams of log(p_target / p_raw); every document is kept or
rejected by comparing that score with one fixed threshold.

Defined results: a null, empty or blank text has 0 words, fails the base rules
and scores 0.0; repeated rows are scored alike; null ids are kept as they are;
an empty table gives an empty result; other columns of the input, whatever their
names, are returned unchanged by ``quality_filter``.  Without trusted rows every
score is 0.0, so the base rules alone decide.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shield, unshield, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
# Mean log-ratio per gram below which a document is rejected (trusted documents
# lie above -0.04, symbol-, capital- and table-ridden ones below -0.1).
THRESHOLD = -0.06


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    return F.size(lines) - F.size(F.array_distinct(lines))


def _adjacent(array: str, step: int, n: Column) -> Column:
    """Hash of each element with the one ``step`` places on (n: elements).

    The lambda sees its two arguments only: an array named inside a lambda would
    be computed again for each element wherever Spark moves a filter below it."""
    left = F.slice(F.col(array), F.lit(1), F.greatest(n - step, F.lit(0)))
    right = F.slice(F.col(array), F.lit(1 + step), F.greatest(n - step, F.lit(0)))
    return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))


def _grams(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``_q_n`` (words), ``_q_h`` (hash of each word) and ``_q_h2`` (of each
    pair of neighbours); together they are the 1- and 2-grams."""
    d = docs.withColumn("_q_w", words(F.col(text)))
    d = d.withColumn("_q_n", F.size("_q_w")).withColumn("_q_h", F.transform("_q_w", lambda w: F.xxhash64(w)))
    return d.withColumn("_q_h2", _adjacent("_q_h", 1, F.col("_q_n")))


def _repeat_words(d: DataFrame) -> DataFrame:
    """Words lying in an 8-word window that occurs twice or more in the text.

    The hash of 8 words is built from hashes of 2 and 4.  Window hashes are
    sorted with their positions inside the row (n log n), and only in texts
    where some hash occurs twice."""
    n = F.col("_q_n")
    d = d.withColumn("_q_h4", _adjacent("_q_h2", 2, n - 1)).withColumn("_q_h8", _adjacent("_q_h4", 4, n - 3))
    repeated = F.size("_q_h8") > F.size(F.array_distinct("_q_h8"))
    ordered = F.array_sort(F.transform("_q_h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_q_s", F.when(repeated, ordered))
    m = F.size("_q_s") - 1
    d = d.withColumn(
        "_q_eq",
        F.zip_with(F.slice("_q_s", F.lit(1), F.greatest(m, F.lit(0))), F.slice("_q_s", F.lit(2), F.greatest(m, F.lit(0))),
                   lambda a, b: a["h"] == b["h"]),
    )
    none = F.array(F.lit(False))
    at = F.zip_with(
        F.zip_with(F.concat(none, "_q_eq"), F.concat("_q_eq", none), lambda a, b: a | b), "_q_s",
        lambda hit, e: F.when(hit, e["i"]),
    )
    d = d.withColumn("_q_at", F.array_sort(F.filter(at, lambda i: i.isNotNull())))
    covered = F.aggregate(
        "_q_at",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    return d.withColumn("_q_rep", F.coalesce(covered, F.lit(0)))


def fit_ratios(
    docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text: str = "text",
    buckets: int = 4096, trusted_rows: int = 20_000, alpha: float = 1.0,
) -> list[float]:
    """log(p_target / p_raw) per bucket; raw counts cover every gram of every text.

    ``trusted`` (one id column) is cut to its first ``trusted_rows`` ids in hash
    order, so what is broadcast is bounded; the model is ``buckets`` numbers."""
    ids = (
        trusted.select(F.col(id_col).alias("_q_id")).where("_q_id is not null").distinct()
        .orderBy(F.xxhash64("_q_id"), "_q_id").limit(trusted_rows).withColumn("_q_t", F.lit(1))
    )
    d = _grams(docs.select(F.col(id_col).alias("_q_id"), F.col(text).alias("_q_x")), "_q_x")
    d = d.select("_q_id", F.concat("_q_h", "_q_h2").alias("_q_g")).join(F.broadcast(ids), "_q_id", "left")
    counts = (  # explode_outer: Spark moves no filter on the array's size below the hashing
        d.select(F.coalesce("_q_t", F.lit(0)).alias("t"), F.explode_outer("_q_g").alias("g")).where("g is not null")
        .groupBy(F.pmod("g", F.lit(buckets)).alias("b")).agg(F.count("*").alias("raw"), F.sum("t").alias("target"))
        .collect()
    )
    raw, target = [0] * buckets, [0] * buckets
    for r in counts:
        raw[r["b"]], target[r["b"]] = r["raw"], r["target"]
    if not sum(target):
        return [0.0] * buckets
    n_raw, n_target = sum(raw) + alpha * buckets, sum(target) + alpha * buckets
    return [math.log((t + alpha) / n_target) - math.log((r + alpha) / n_raw) for r, t in zip(raw, target, strict=True)]


def quality_scores(docs: DataFrame, ratios: list[float], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, llr and kept, as one struct column ``quality``."""
    own = docs.withColumn("_q_x", F.coalesce(F.col(text), F.lit("")))
    d = _repeat_words(_grams(own, "_q_x"))
    model = F.from_json(F.lit("[" + ",".join(repr(x) for x in ratios) + "]"), "array<double>")
    total = F.aggregate(
        F.concat("_q_h", "_q_h2"), F.lit(0.0), lambda a, g: a + F.get(model, F.pmod(g, F.lit(len(ratios))).cast("int"))
    )
    x = F.col("_q_x")
    chars = F.length(F.translate(x, " \t\n\x0b\x0c\r", ""))
    d = d.withColumn("_q_llr", F.when(F.col("_q_n") > 0, total / (F.size("_q_h") + F.size("_q_h2"))).otherwise(F.lit(0.0)))
    failed = (F.col("_q_n") < 20) | (F.lit(100) * F.col("_q_rep") > F.lit(30) * F.col("_q_n"))
    quality = F.struct(
        F.col("_q_n").cast("long").alias("n_words"),
        chars.cast("long").alias("word_chars"),
        (F.length(x) - F.length(F.translate(x, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _duplicate_lines(x).cast("long").alias("n_dup_lines"),
        F.col("_q_rep").cast("long").alias("n_repeat_words"),
        failed.alias("base_failed"),
        F.col("_q_llr").alias("llr"),
        (~failed & (F.col("_q_llr") >= threshold)).alias("kept"),
    )
    return d.select(*[F.col(f"`{c}`") for c in docs.columns if c != "quality"], quality.alias("quality"))


def quality_filter(docs: DataFrame, ratios: list[float], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The kept rows of ``docs``, all columns unchanged."""
    scored = quality_scores(shield(docs), ratios, f"_in_{text}", threshold).withColumn("_q_part", F.spark_partition_id())
    # A filter that names a non-deterministic column stays above the scoring;
    # moved below it, the whole score would be computed a second time.
    return unshield(scored.where("quality.kept and _q_part >= 0"), docs.columns)
