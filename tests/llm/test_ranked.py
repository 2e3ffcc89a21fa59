"""Ranked search against brute force."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from vodlens.llm import queries as Q
from vodlens.llm import ranked
from vodlens.llm.common import read_table

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute(docs, items, k):
    """docs: rows (id, text); items: id -> text."""
    counts = [(i, terms(t)) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, size = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = {}
    for item, text in items.items():
        scored = []
        for i, c in counts:
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // size
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out[item] = [(r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return out


def listed(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.item_id].append((r["rank"], r.doc_id, r.score))
    return {i: sorted(v) for i, v in out.items()}


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    items = {r.item_id: r.text for r in read_table(spark, SF, "benchmark").collect()}
    assert listed(Q.op12_ranked_search(spark, SF)) == brute(docs, items, 50)


def _corpus(n, seed=5):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(3000)]
    p = 1 / np.arange(1, 3001)
    return [(i, " ".join(rng.choice(words, int(rng.integers(1, 120)), p=p / p.sum()))) for i in range(n)], words


def test_bounds_hold_and_prune():
    docs, words = _corpus(1500)
    rows = [(i, ranked.term_counts(t.encode())) for i, t in docs]
    names, term, tf, sizes = {}, [], [], []
    for _, c in rows:
        term += [names.setdefault(w, len(names)) for w in c]
        tf += c.values()
        sizes.append(len(c))
    log, sketch = ranked._sketches(ranked._hashes(list(names)), np.array(sizes), np.array(term), np.array(tf))
    n = np.array([sum(c.values()) for _, c in rows])
    df = Counter(t for _, c in rows for t in c)
    items = [(j, ranked.term_counts(docs[j * 7][1].encode())) for j in range(40)]
    asked = ranked._Asked(items, dict(df), len(docs), int(n.sum()))
    m = 50 + 50 * n * len(docs) // int(n.sum())
    bound = asked.bounds(m, log, sketch)
    want = brute(docs, {j: docs[j * 7][1] for j in range(40)}, len(docs))
    loose = 0
    for q, j in enumerate(asked.ids):
        exact = {i: s for _, i, s in want[j]}
        assert all(bound[i, q] >= exact.get(i, 0) for i in range(len(docs)))
        loose += sum(bound[i, q] >= want[j][min(49, len(want[j]) - 1)][2] for i in range(len(docs)))
    assert loose < 0.3 * len(docs) * 40  # most documents are never scored


@pytest.mark.parametrize("n_parts", [1, 7])
def test_chunks_blocks_and_ties(spark, monkeypatch, n_parts):
    monkeypatch.setattr(ranked, "CHUNK_BYTES", 9_000)
    monkeypatch.setattr(ranked, "BLOCK_BYTES", 4_000)
    docs, _ = _corpus(900)
    docs = [(i, docs[i % 300][1] if i % 3 else t) for i, t in docs]  # groups of copies: ties
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(n_parts)
    items = spark.createDataFrame([(f"i{j}", docs[j * 11][1]) for j in range(60)], "item_id string, text string")
    assert listed(ranked.search(df, items, k=20)) == brute(docs, {f"i{j}": docs[j * 11][1] for j in range(60)}, 20)


def test_edge_rows(spark):
    schema = "doc_id long, text string, score string, n string, item_id long"
    rows = [(1, None), (2, ""), (3, " .,! "), (4, "Ünï x"), (5, "a b c " * 400), (5, "a b c " * 400), (None, "a z"), (None, "a z"), (6, "big\x00A"), (7, "b " * 300)]
    docs = spark.createDataFrame([(i, t, "s", "n", 1) for i, t in rows], schema)
    asked = [(1, "A ünï"), (1, "b"), (2, None), (3, ""), (4, "nowhere"), (None, "z z Z")]
    items = spark.createDataFrame([(i, t, 9) for i, t in asked], "item_id long, text string, doc_id long")
    got = listed(ranked.search(docs, items))
    want = brute(rows, {1: "A ünï b", None: "z"}, 50)
    assert got == {1: want[1], None: want[None]} and {x[1] for x in got[1]} == {5, 7, None, 6}  # only A-Z are lower-cased
    assert ranked.search(docs.limit(0), items).count() == ranked.search(docs, items.limit(0)).count() == 0
    names = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("q", "q")], "doc_id string, text string")
    got = listed(ranked.search(names, spark.createDataFrame([(1, "x")], "item_id int, text string")))
    assert [i for _, i, _ in got[1]] == ["a", "b", None]
