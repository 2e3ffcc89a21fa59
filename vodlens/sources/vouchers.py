"""Promotion feed (SRC11) and its XML rows for the loading procedure (SNK4).

The feed service answers with ``{"data": [promotion, ...]}``; responses are
landed as JSON lines (one page per line) and read as variants, so many pages load
in parallel, no page passes through the driver and no member's type is forced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import VOUCHER_FEED, VOUCHER_MEMBERS  # noqa: F401  the written feed's schema
from ..session import ensure_checkpoint_dir


def pack_pages(items: DataFrame, page_size: int = 1000) -> DataFrame:
    """Group flat promotions into feed pages ``{"data": [...]}`` of at most
    ``page_size`` items: each task cuts its own rows by position, so a page
    stays bounded however many copies one id has (items sorted within a page)."""
    cols = [c for c in items.columns]
    rid = F.monotonically_increasing_id()  # partition id in the high bits
    page = F.struct(F.shiftright(rid, 33).alias("part"), F.floor(rid.bitwiseAND(F.lit(LOCAL_MASK)) / page_size).alias("n"))
    return (
        items.withColumn("_page", page)
        .groupBy("_page")
        .agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("data"))
        .select("data")
    )


def write_feed(pages: DataFrame, path: str) -> None:
    pages.write.mode("overwrite").json(path)


def read_feed(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """One row per promotion, every member as text.

    Documents are read as variants, so a member keeps what the feed says whatever its
    JSON type: an id may be a number or text, a discount a number or a quoted one.
    Promotions that are no objects, and documents without a ``data`` list or that do
    not parse, give no rows.  ``multiline``: a file is one document over many lines."""
    docs = spark.read.option("singleVariantColumn", "doc").option("multiLine", multiline).json(path)
    items = docs.select(F.explode(F.try_variant_get("doc", "$.data", "array<variant>")).alias("p"))
    members = [F.try_variant_get("p", f"$.{m}", "string").alias(m) for m in VOUCHER_MEMBERS]
    return items.where(F.schema_of_variant("p").startswith("OBJECT")).select(*members)


def xml_escape(c: Column) -> Column:
    """Escape the five XML special characters of an attribute value."""
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    for ch, ent in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        out = F.replace(out, F.lit(ch), F.lit(ent))
    return out


# Attribute names of one ``<T .../>`` element, in order, paired
# with the feed member that fills it (None: always empty).
VOUCHER_ATTRS = [
    ("ID", "id"),
    ("Name", "name"),
    ("eventCode", "eventCode"),
    ("description", None),
    ("discount", "discount"),
    ("fromDate", "fromDate"),
    ("toDate", "toDate"),
    ("Status", "status"),
    ("quotaGeneralCode", "quotaGeneralCode"),
    ("quotaPrivateCode", "quotaPrivateCode"),
    ("images", "images"),
    ("vourcherType", "voucherType"),
    ("serviceName", None),
    ("serviceType", "serviceType"),
]


def voucher_rows(promotions: DataFrame) -> DataFrame:
    """Typed promotion rows and their XML element: discount as an integer
    (truncated), dates cut to ``yyyy-MM-dd``, blank description and service
    name, values escaped; a NULL member gives an empty attribute."""
    typed = promotions.select(
        "id",
        F.col("name"),
        F.col("eventCode"),
        F.col("discount").try_cast("double").cast("bigint").alias("discount"),
        F.substring("fromDate", 1, 10).alias("fromDate"),
        F.substring("toDate", 1, 10).alias("toDate"),
        F.col("status"),
        F.col("quotaGeneralCode"),
        F.col("quotaPrivateCode"),
        F.col("images"),
        F.col("voucherType"),
        F.col("serviceType"),
    )
    parts: list[Column] = [F.lit("<T")]
    for attr, member in VOUCHER_ATTRS:
        val = F.lit("") if member is None else F.coalesce(F.col(member).cast("string"), F.lit(""))
        parts += [F.lit(f' {attr}="'), xml_escape(val), F.lit('"')]
    parts.append(F.lit("/>"))
    return typed.withColumn("xml", F.concat(*parts))


def xml_payloads(rows: DataFrame, chunk_rows: int = 1000, order_col: str | None = "id") -> DataFrame:
    """SNK4/SNK5: concatenate XML elements into payloads of at most
    ``chunk_rows`` elements (one procedure call each), so no single string has
    to hold the whole feed.

    With ``order_col`` the elements are cut by their exact position in
    ``order_col`` order (copies of one id in arrival order) — payload ``k``
    holds positions ``k*chunk_rows`` to ``(k+1)*chunk_rows - 1`` however many
    copies an id has.  Without one (``None``, e.g. pivoted customer rows) each
    task cuts its own rows into chunks by their position in the partition — no
    ordering pass.  An empty input gives no payload, hence no call.
    """
    if order_col is not None:
        ranked = global_positions(rows.select(order_col, "xml"), [order_col])
        key = F.col("_pos")
        chunk = F.floor(key / chunk_rows)
    else:
        ranked = rows
        rid = F.monotonically_increasing_id()  # partition id in the high bits
        key = rid
        chunk = F.struct(
            F.shiftright(rid, 33).alias("part"),
            F.floor(rid.bitwiseAND(F.lit(LOCAL_MASK)) / chunk_rows).alias("n"),
        )
    return (
        ranked.select(chunk.alias("chunk"), key.alias("_k"), "xml")
        .groupBy("chunk")
        .agg(
            F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("_k", "xml"))), lambda s: s["xml"]),
                "",
            ).alias("payload"),
            F.count(F.lit(1)).alias("n"),
        )
    )


# Low bits of ``monotonically_increasing_id``: the row's position in its partition.
LOCAL_MASK = (1 << 33) - 1


def global_positions(df: DataFrame, order: list[str], num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``_pos``: the row's 0-based position in ``order`` (ties in
    arrival order), computed without a single-task sort.

    Rows are range-partitioned on ``order`` plus a unique arrival id, so even
    one key holding a third of all rows is split over many tasks.  Each range
    is sorted locally; a row's position is the number of rows in earlier ranges
    (a prefix sum over one count per range — as many rows as partitions, hence
    a bounded broadcast) plus its position in its own range.

    The counts and the rows must see the very same ranges, but a recomputed
    range shuffle may draw other boundaries (skewed input is re-sampled) and
    other arrival ids (after an upstream shuffle).  So the ranged rows are
    written once to the shared checkpoint folder and both sides read them;
    this also keeps positions stable when executors are lost.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, "_arrival"]
    ensure_checkpoint_dir(spark)
    ranged = (
        df.withColumn("_arrival", F.monotonically_increasing_id())
        .repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_rid"))
        .checkpoint(eager=True)
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    pos = F.col("_start") + F.col("_rid").bitwiseAND(F.lit(LOCAL_MASK))
    return (
        ranged.join(F.broadcast(starts), "_range")
        .withColumn("_pos", pos)
        .drop("_arrival", "_range", "_rid", "_start")
    )
