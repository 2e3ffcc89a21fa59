"""Mixing sources to target weights by Efraimidis-Spirakis sampling (native).

A source's target may exceed its size: complete epochs (every document once)
come first, and the rest of the target is filled by weighted sampling without
replacement.  Each document gets the exponential key -ln(u) / quality weight,
with u a hash of its id, so reruns agree; keys are sorted within the source and
sizes prefix-summed up to the token budget.

The prefix sum never gathers a source: its range of keys is cut into
``KEY_BUCKETS`` equal intervals, their sizes are prefix-summed, and the interval
in which the budget ends is cut again, until it holds at most ``SORTED_ROWS``
rows or one key only; equal keys are added up and the few left are sorted.  Each
round reads the rows of one interval a source.  What remains is one cut key per
source, which the documents are compared with.

Defined results: null, empty and blank texts have size 0 and take 0 words; null
sources form one source, ordered last; null ids get keys like any other; rows
with equal source, id and text size stand or fall together; an empty table
gives an empty result; further columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, n_words, shield, small, unshield

KEY_BUCKETS = 4096
SORTED_ROWS = 100_000
MAX_EPOCHS = 3
SOURCE_WEIGHTS = (1, 2, 3)  # by code point of the source, null last, repeating
BROADCAST_SOURCES = 50_000


def weighed(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``size`` (words) and ``quality_weight`` (0.05 to 1: the less of a
    text is digits and symbols, the likelier its fractional selection)."""
    x = F.coalesce(F.col(text), F.lit(""))
    odd = F.length(x) - F.length(F.translate(x, "#*$%&|<>0123456789", ""))
    weight = F.greatest(F.lit(0.05), F.lit(1.0) - F.lit(5.0) * odd / F.greatest(F.length(x), F.lit(1)))
    return docs.withColumns({"size": n_words(x), "quality_weight": weight})


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    key = F.struct((-F.log(u) / F.col("quality_weight")).alias("k"), F.col("doc_id").alias("id"), F.col("size").alias("n"))
    return docs.withColumn("_m_key", key)


def targets(sources: DataFrame, weights=SOURCE_WEIGHTS, most: float = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to (source, source_size): shares of the total by weight,
    stopped at ``most`` times the source, the excess reshared (water filling).

    In the order of cap / weight the stopped sources come first; the level that
    the others share is the largest one found among those above it."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("_m_no") - 1) % len(weights) + 1).cast("int"))
    every = Window.partitionBy(F.lit(0))  # one row per source
    s = sources.withColumn("_m_no", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())))
    s = s.withColumns({"_m_w": w, "_m_cap": F.lit(float(most)) * F.col("source_size")})
    by_ratio = every.orderBy(F.col("_m_cap") / F.col("_m_w"), "_m_no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum(F.col("source_size").cast("double")).over(every) - F.coalesce(F.sum("_m_cap").over(before), F.lit(0.0))
    s = s.withColumn("_m_level", left / F.sum("_m_w").over(after))
    level = F.max(F.when(F.col("_m_cap") > F.col("_m_level") * F.col("_m_w"), F.col("_m_level"))).over(every)
    s = s.withColumn("_m_top", level)
    target = F.least("_m_cap", F.coalesce(F.col("_m_top") * F.col("_m_w"), F.col("_m_cap")))
    return s.select("source", "source_size", target.alias("target"))


def _interval_of_end(keyed: DataFrame, ends: DataFrame) -> DataFrame:
    """``ends`` (_m_src, _m_rest, _m_lo, _m_hi, _m_before, _m_rows) narrowed to the
    part of the interval [_m_lo, _m_hi] in which the budget ends; an interval of few
    rows stays.  ``_m_before`` is the size of what lies below the interval."""
    k, width = F.col("_m_key.k"), (F.col("_m_hi") - F.col("_m_lo")) / KEY_BUCKETS
    wide = small(ends.where((F.col("_m_rows") > SORTED_ROWS) & (F.col("_m_lo") < F.col("_m_hi"))), BROADCAST_SOURCES)
    inside = keyed.join(wide, F.col("source").eqNullSafe(F.col("_m_src")) & k.between(F.col("_m_lo"), F.col("_m_hi")))
    sums = (
        inside.withColumn("_m_b", F.when(width > 0, F.floor((k - F.col("_m_lo")) / width)).otherwise(F.lit(0)))
        .groupBy("_m_src", "_m_b")
        .agg(F.sum("size").alias("n"), F.count("*").alias("rows"), F.min(k).alias("lo"), F.max(k).alias("hi"),
             *[F.first(c).alias(c) for c in ("_m_rest", "_m_before")])
    )
    upto = Window.partitionBy("_m_src").orderBy("_m_b").rowsBetween(Window.unboundedPreceding, 0)
    found = sums.withColumn("_m_upto", F.col("_m_before") + F.sum("n").over(upto)).where("_m_upto >= _m_rest and _m_upto - n < _m_rest")
    found = found.select(
        "_m_src", "_m_rest", F.col("lo").alias("_m_lo"), F.col("hi").alias("_m_hi"),
        (F.col("_m_upto") - F.col("n")).alias("_m_before"), F.col("rows").alias("_m_rows"))
    return found.unionByName(ends.where((F.col("_m_rows") <= SORTED_ROWS) | (F.col("_m_lo") >= F.col("_m_hi"))))


def mixture_plan(docs: DataFrame, seed: int = 7) -> DataFrame:
    """(source, source_size, target, epochs, cut_key, cut_from): one row per source.

    Rows with a key below ``cut_from`` are selected, and those up to ``cut_key``.
    ``docs`` has doc_id, source, size and quality_weight and is read several
    times, so it should be cut."""
    keyed = _keyed(docs.select("doc_id", "source", "size", "quality_weight"), seed).select("source", "size", "_m_key")
    k = F.col("_m_key.k")
    counted = cut(keyed.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("_m_rows"), F.min(k).alias("_m_lo"), F.max(k).alias("_m_hi")))
    sources = targets(counted.select("source", "source_size"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    epochs = F.least(F.floor(ratio + 1e-9), F.lit(MAX_EPOCHS)).cast("int")
    sources = sources.withColumn("epochs", epochs)
    rest = F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0))
    sources = cut(sources.withColumn("_m_rest", rest))

    # The interval of keys in which a source's budget ends, and what lies below it.
    own = counted.select(F.col("source").alias("_m_src"), "_m_rows", "_m_lo", "_m_hi")
    ends = cut(
        sources.where("_m_rest > 0").join(own, F.col("source").eqNullSafe(F.col("_m_src")))
        .select("_m_src", "_m_rest", "_m_lo", "_m_hi", F.lit(0).cast("long").alias("_m_before"), "_m_rows"))
    while ends.where((F.col("_m_rows") > SORTED_ROWS) & (F.col("_m_lo") < F.col("_m_hi"))).limit(1).count():
        ends = cut(_interval_of_end(keyed, ends))
    ends = small(ends, BROADCAST_SOURCES)
    last = keyed.join(ends, F.col("source").eqNullSafe(F.col("_m_src")) & k.between(F.col("_m_lo"), F.col("_m_hi")))
    # Rows of one key stand or fall together: the copies of a row are one step.
    steps = last.groupBy("_m_src", "_m_key").agg(F.sum("size").alias("n"), *[F.first(c).alias(c) for c in ("_m_rest", "_m_before", "_m_lo")])
    run = Window.partitionBy("_m_src").orderBy("_m_key").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("_m_before") + F.sum("n").over(run) - F.col("n") / 2.0  # nearest whole document
    cuts = (
        steps.withColumn("_m_mid", middle)
        .groupBy("_m_src").agg(
            F.max(F.when(F.col("_m_mid") <= F.col("_m_rest"), F.col("_m_key"))).alias("cut_key"),
            F.first("_m_lo").alias("cut_from"),
        )
    )
    return cut(
        sources.join(cuts, F.col("source").eqNullSafe(F.col("_m_src")), "left")
        .select("source", "source_size", "target", "epochs", "cut_key", "cut_from")
    )


def mix(docs: DataFrame, plan: DataFrame, seed: int = 7) -> DataFrame:
    """``docs`` (with size and quality_weight) plus source_size, target, epochs,
    copies and taken words.  One comparison per row: no sort, no shuffle of texts."""
    p = plan.select(F.col("source").alias("_m_src"), "source_size", "target", "epochs",
                    F.col("cut_key").alias("_m_cut"), F.col("cut_from").alias("_m_from"))
    own = docs.drop("source_size", "target", "epochs", "copies", "taken")
    j = _keyed(own, seed).join(small(p, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("_m_src")), "left")
    chosen = F.coalesce(F.col("_m_key.k") < F.col("_m_from"), F.lit(False)) | F.coalesce(F.col("_m_key") <= F.col("_m_cut"), F.lit(False))
    copies = F.col("epochs") + chosen.cast("int")
    j = j.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    return j.drop("_m_key", "_m_src", "_m_cut", "_m_from")


def mixed_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The mixture itself: each row of ``docs`` as often as the mix takes it, with
    the columns of ``docs``.  Documents without words are never taken."""
    named = shield(docs).withColumns({"doc_id": F.col("_in_doc_id"), "source": F.col("_in_source")})
    w = weighed(named, f"_in_{text}")
    plan = mixture_plan(cut(w.select("doc_id", "source", "size", "quality_weight")))
    taken = mix(w, plan).withColumn("_m_copy", F.explode(F.array_repeat(F.lit(1), F.when(F.col("size") > 0, F.col("copies")).otherwise(0))))
    return unshield(taken, docs.columns)
