"""The mixture against a row-by-row model: keys sorted, sizes added up to the budget."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vodlens.llm import mixing


def _rows():
    rows = [(i, "plain words only " * (1 + i % 7), "a") for i in range(600)]
    rows += [(1_000 + i, "12 34 #$ 56 78 9 " * (1 + i % 5), "b") for i in range(900)]  # weight 0.05
    rows += [(3_000, "one and the same row", "c")] * 700  # a single key
    rows += [(4_000 + i, f"w {i} x", None) for i in range(300)] + [(5_000, None, "a"), (5_001, "", "d"), (None, "no id", "b")]
    return rows


def _model(docs):
    """taken per row, from the rows of ``_keyed`` and the targets."""
    by = defaultdict(list)
    for r in docs:
        by[r.source].append(r)
    taken = []
    for rows in by.values():
        own, target = sum(r["size"] for r in rows), rows[0].target
        epochs = min(int(target / own + 1e-9), mixing.MAX_EPOCHS) if own else 0
        rest, upto, last = max(target - epochs * own, 0.0), 0, None
        steps = defaultdict(int)
        for r in rows:
            steps[tuple(r["_m_key"])] += r["size"]
        for key in sorted(steps, key=lambda x: (x[0], x[1] is not None, x[1], x[2])):
            if rest > 0 and upto + steps[key] / 2 <= rest:
                last = key
            upto += steps[key]
        order = lambda x: (x[0], x[1] is not None, x[1] or 0, x[2])
        taken += [(r.doc_id, r["size"], r["size"] * (epochs + (last is not None and order(tuple(r["_m_key"])) <= order(last)))) for r in rows]
    return taken


@pytest.mark.parametrize(("rows", "cuts"), [(100_000, 4096), (40, 4096), (3, 2), (1, 16)])
def test_mixture_equals_the_row_by_row_model(spark, monkeypatch, rows, cuts):
    monkeypatch.setattr(mixing, "SORTED_ROWS", rows)
    monkeypatch.setattr(mixing, "KEY_BUCKETS", cuts)
    d = mixing.weighed(spark.createDataFrame(_rows(), "doc_id long, text string, source string"))
    mixed = mixing.mix(d, mixing.mixture_plan(d))
    got = mixed.select("doc_id", "size", "taken", "source", "target", "quality_weight")
    want = _model(mixing._keyed(got, 7).collect())
    null_first = lambda x: (x[0] is not None, x)
    assert sorted(((r.doc_id, r["size"], r.taken) for r in got.collect()), key=null_first) == sorted(want, key=null_first)


def test_light_rows_share_no_interval(spark):
    """All rows at the least weight: the sorted interval stays small."""
    light = spark.range(300_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "big").otherwise("small").alias("source"),
        F.lit(3).cast("long").alias("size"), F.lit(0.05).alias("quality_weight"))
    plan = mixing.mixture_plan(light)
    mixed = mixing.mix(light, plan)
    got = mixed.groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("target")).collect()
    assert all(abs(r.n - r.target) <= 3 for r in got)
    ends = plan.where("cut_key is not null").select(F.col("source").alias("s"), "cut_from", "cut_key.k")
    between = mixing._keyed(light, 7).join(ends, (F.col("source") == F.col("s")) & F.col("_m_key.k").between(F.col("cut_from"), F.col("k")))
    assert between.count() <= 2 * mixing.SORTED_ROWS
