"""Each operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html, jaccard, licences, mixing, neighbours, packing, periods, pii, quality, ranked, substring, suffix, toxicity
from .common import cut, read_table, tokenizer_path, words


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.scores(docs, model)
    return scored.withColumn("held_out", toxicity.held_out())


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    trusted = read_table(spark, sf_dir, "labels").where("quality = 1")
    ratios = quality.fit_ratios(docs, trusted)
    scored = quality.quality_scores(docs.select("doc_id", "text"), ratios)
    return scored.select("doc_id", "quality.*")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(read_table(spark, sf_dir, "documents"))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = licences.document_paths(read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))
    found = licences.licences(files, licences.short(F.col("text")))
    ids = files.select("doc_id", "path").withColumnRenamed("path", "_path")
    return ids.join(found, F.col("_path") == F.col("path")).drop("_path")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("byte_bpe_50k.tiktoken"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = cut(mixing.weighed(read_table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "quality_weight"))
    mixed = mixing.mix(docs, mixing.mixture_plan(docs))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "epochs", "quality_weight")


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.without_repeats(read_table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    cands = pii.candidates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = pii.spans(cands, pii.fit_trees(cands))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [count(k) for k in pii.BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.span_list(base), 256).alias("base_sha256"), pii.span_list(F.col("spans")).alias("spans")
    )


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return html.extract(pages, html.fit(pages))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=50)


def _looped(docs: DataFrame) -> DataFrame:
    """Every tenth id (by crc32, null: none) has its text end in repeats of a block:
    with g = floor(crc32 / 10), from word g % n on it goes round in 1 + floor((n -
    g % n) / (3 + g % 8)) words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words(F.col("text"))))
    n, g = F.size("w").cast("long"), F.floor(F.col("h") / 10)
    d = d.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, g % F.col("n"))).withColumn(
        "p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)))
    block = F.slice("w", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int"))), F.lit(1), (F.col("n") - F.col("a")).cast("int"))
    turned = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), tail), " ")
    return d.select("doc_id", F.when(F.col("a").isNotNull(), turned).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(_looped(read_table(spark, sf_dir, "documents")))
    found = found.withColumn("best", periods.longest_exponent(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(periods.run_list(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
