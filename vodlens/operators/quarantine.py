"""Cleaning with a reason for every rejected record (CLN1, CLN2).

``checked`` tags each raw record with the first check that it fails, in the order of
``REASONS``; records without a failed check are the ones that the cleaning rules
accept.  ``landing_rows`` brings accepted and rejected records into one frame, so that
one pass over the raw logs writes both and no record can be lost between them:
accepted rows carry the flat log columns, rejected ones the record as JSON text.

A record whose JSON does not parse has no fields (reason ``record``); one whose time
does not parse has no time (reason ``time``), also where the cleaning rule alone would
keep it with a NULL ``Date``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import archive_checks, flat_values, kafka_checks

ACCEPTED = "accepted"
REASONS = ["record", "time", "identity", "application", "kind", "view"]
CORRUPT = "_corrupt_record"


def reason(kind: str) -> Column:
    """The first failed check of a raw record of ``kind`` (kafka or archive)."""
    time = F.col("received_at") if kind == "kafka" else F.col("received_at").try_cast("timestamp")
    checks = {"record": F.col("fields").isNotNull(), "time": time.isNotNull(), **(kafka_checks() if kind == "kafka" else archive_checks())}
    out = F.lit(ACCEPTED)
    for name in reversed(REASONS):
        out = F.when(F.coalesce(checks[name], F.lit(False)), out).otherwise(F.lit(name))
    return out


def checked(raw: DataFrame, kind: str) -> DataFrame:
    return raw.withColumn("reason", reason(kind))


def landing_rows(raw: DataFrame, kind: str) -> DataFrame:
    """reason, the flat log columns (accepted) and ``raw`` (rejected: the record as it
    was read, or its JSON)."""
    text = F.to_json(F.struct("received_at", "fields"))
    if CORRUPT in raw.columns:
        text = F.coalesce(F.col(CORRUPT), text)
    keep = F.col("reason") == ACCEPTED
    flat = [F.when(keep, v).alias(n) for n, v in flat_values(kind).items()]
    return checked(raw, kind).select("reason", *flat, F.when(~keep, text).alias("raw"))
