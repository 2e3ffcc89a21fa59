"""Periodic runs against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vodlens.llm import periods
from vodlens.llm import queries as Q
from vodlens.llm.common import read_table

SF = "/root/testdata/sf0.001"


def brute(x):
    """All runs, by comparing words one period apart for every period."""
    runs = {}
    for p in range(1, len(x) // 3 + 1):
        same, k = [x[i] == x[i + p] for i in range(len(x) - p)], 0
        while k < len(same):
            j = k
            while j < len(same) and same[j]:
                j += 1
            if j > k and j + p - k >= max(24, 3 * p):
                runs.setdefault((k, j + p), p)
            k = j + 1
    return sorted(((s, e - s, p) for (s, e), p in runs.items()), key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = set()
    for s, n, p in runs:
        gone.update(range(s + p, s + n))
    return [w for i, w in enumerate(words) if i not in gone]


blocks = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12), st.lists(st.integers(4, 40), max_size=6)), min_size=1, max_size=6)


@settings(max_examples=150, deadline=None)
@given(st.lists(blocks, min_size=1, max_size=4))
def test_runs_equal_brute_force(texts):
    ids = [np.array([w for block, times, rest in t for w in block * times + rest], dtype=np.int32) for t in texts]
    ids = sorted((x for x in ids if len(x) >= periods.MIN_LENGTH), key=lambda x: -len(x))
    if not ids:
        return
    hit = periods.with_candidates(ids, 41)
    for k, (x, got) in enumerate(zip(ids, periods.runs_of(ids, 41), strict=True)):
        want = brute(x.tolist())
        assert [tuple(r) for r in got.tolist()] == want
        assert k in hit or not want


def test_grammar_extensions_equal_comparison():
    rng = np.random.default_rng(1)
    texts = sorted([np.tile(rng.integers(0, 3, 40), 5), np.zeros(300, int), rng.integers(0, 2, 500), np.arange(60) % 7], key=lambda x: -len(x))
    symbols, begin = periods._joined(texts, 10)
    g = periods.Grammar(symbols, 10, len(texts) + 1)
    a, b = rng.integers(1, len(symbols) - 1, (2, 3000))
    a, b = a[a != b], b[a != b]
    for step in 1, -1:
        got = g.extend(a, b, step)
        for x, y, n in zip(a.tolist(), b.tolist(), got.tolist(), strict=True):
            m = 0
            while symbols[x + step * m] == symbols[y + step * m]:
                m += 1
            assert m == n


def test_long_texts_of_one_word_and_of_one_block():
    block = np.random.default_rng(2).integers(0, 5000, 100_000)
    assert [r.tolist() for r in periods.runs_of([np.tile(block, 4), np.zeros(300_000, int)], 5000)] == [
        [[0, 400_000, 100_000]], [[0, 300_000, 1]]]


def _turned(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def _row(words):
    runs = brute(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(kept(words, runs))))


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect() if len(r.text or "") < 12_000}
    got = {r.doc_id: tuple(r)[1:] for r in Q.op13_periodic_runs(spark, SF).collect()}
    assert len(got) == read_table(spark, SF, "documents").count()
    for i, t in texts.items():
        assert got[i] == _row(_turned(i, t))
    assert sum(r[0] > 0 for r in got.values()) > 10


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(200_000)) + " la" * 30
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a " * 24), (4, "a " * 24), (None, "x y\tz " * 8), (5, "a " * 23), (6, long)]
    docs = spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, runs string")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periods.periodic_runs(docs).collect()]
    assert sorted(got[:6], key=str) == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 24, [(0, 24, 1)], "a"), (4, 24, [(0, 24, 1)], "a"),
        (None, 16, [], " ".join(["x y z"] * 8))], key=str)
    assert got[6][1:3] == (23, []) and got[7][1:3] == (200_030, [(200_000, 30, 1)]) and got[7][3].endswith("w199999 la")
    assert periods.periodic_runs(docs.limit(0)).count() == 0
    assert Q._looped(docs.select("doc_id", "text")).where(F.col("text").isNull()).count() == 1


@pytest.mark.parametrize("runs, best", [([], None), ([(0, 24, 8), (3, 30, 10), (5, 31, 10)], (5, 31, 10)), ([(0, 30, 10), (1, 30, 10)], (0, 30, 10))])
def test_longest_exponent(spark, runs, best):
    d = spark.createDataFrame([(runs,)], "runs " + periods.RUNS)
    got = d.select(periods.longest_exponent(F.col("runs")).alias("b")).first().b
    assert (got and tuple(got)) == best
