"""The training-data operators against brute force, on sf0.001 and on edge rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vodlens.llm import jaccard, licences, mixing, neighbours, packing, pii, quality, segments, substring, suffix, toxicity
from vodlens.llm import queries as Q
from vodlens.llm.common import read_table, tokenizer_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, quality string"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in read_table(spark, SF, "documents").collect()}


@pytest.fixture(scope="module")
def edges(spark):
    long = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    twin = " ".join(f"t{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, twin), (6, twin), (7, long), (None, twin), (7, long), (8, "a@b.co " * 3)]
    return spark.createDataFrame([(i, t, None if i == 4 else "en", None if i == 5 else "s", None, "x", "y") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _windows_removed(texts, size, tokens):
    seen, out = set(), {}
    for i in sorted(texts):
        w = tokens(texts[i])
        gone = bytearray(len(w))
        for k in range(len(w) - size + 1):
            x = bytes(w[k:k + size]) if isinstance(w, bytes) else tuple(w[k:k + size])
            if x in seen:
                gone[k:k + size] = b"\1" * size
            seen.add(x)
        out[i] = (w, gone)
    return out


def test_suffix_dedup_equals_brute_force(spark, docs):
    want = _windows_removed(docs, 100, str.encode)
    for r in Q.op3_suffix_dedup(spark, SF).collect():
        w, gone = want[r.doc_id]
        kept = bytes(b for b, g in zip(w, gone) if not g)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(w), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("k, window", [(16, 100), (4, 20)])
def test_minimisers_beyond_2_to_24_places(k, window):
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 62, size=(1 << 24) + 5_000).astype(np.uint64)
    h[-3_000:] = h[1_000:4_000]
    for at in (1 << 24) - 1_500, (1 << 24) - 60:  # copies around the place where a key is full
        h[at:at + 700] = h[2_000:2_700]
    s, e, a = segments.super_windows(h, np.full(len(h), len(h) + k - 1), k, window)
    assert (a >= s).all() and (a <= e + window - k).all() and (a - e >= 0).all()
    assert s[0] == 0 and (s[1:] == e[:-1] + 1).all() and e[-1] == len(h) + k - 1 - window  # each window once
    anchor = np.repeat(a, e - s + 1) - np.arange(e[-1] + 1)
    n = 700 + k - window - k + 1
    for at in (1 << 24) - 1_500, (1 << 24) - 60, len(h) - 2_000:
        assert (anchor[at:at + n] == anchor[2_000:2_000 + n]).all()


def test_suffix_dedup_of_a_text_over_16_mib(spark):
    rng = np.random.default_rng(4)
    text = bytes(rng.integers(97, 123, size=(1 << 24) + 4_000).astype(np.uint8))
    text = text[:-3_000] + text[500:2_500] + text[-1_000:]
    d = spark.createDataFrame([(1, text.decode()), (2, text[-800:-500].decode())], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.without_repeats(d).collect()}
    kept = text[:-3_000] + text[-1_000:]
    assert got == {1: (2_000, 1, hashlib.sha256(kept).hexdigest()), 2: (300, 1, hashlib.sha256(b"").hexdigest())}


def test_substring_dedup_equals_brute_force(spark, docs):
    want = _windows_removed(docs, 20, lambda t: t.encode().split())
    for r in Q.op9_substring(spark, SF).collect():
        w, gone = want[r.doc_id]
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), sum(gone), hashlib.sha256(kept).hexdigest())


def test_loser_tree_orders_and_counts_shared_bytes():
    rng = np.random.default_rng(1)
    runs = []
    for n in (5, 0, 17, 1, 9):
        s = sorted(bytes(rng.integers(97, 99, size=6).astype(np.uint8)) for _ in range(n))
        shared = [0] + [next((k for k in range(6) if a[k] != b[k]), 6) for a, b in zip(s, s[1:])]
        runs.append((s, shared[:n]))
    out = list(suffix.merge_runs(runs))
    got = [runs[r][0][i] for r, i, _ in out]
    assert got == sorted(x for s, _ in runs for x in s)
    for (x, y, (_, _, lcp)) in zip(got, got[1:], out[1:]):
        assert lcp == next((k for k in range(6) if x[k] != y[k]), 6)


def test_jaccard_equals_brute_force(spark, docs):
    sets, owners = {}, defaultdict(list)
    for i, t in docs.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        for s in sets[i]:
            owners[s].append(i)
    comp = {i: i for i in docs}
    changed = True
    while changed:
        changed = False
        for i in docs:
            for j in {j for s in sets[i] for j in owners[s]}:
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and comp[i] != comp[j]:
                    comp[i] = comp[j] = min(comp[i], comp[j])
                    changed = True
    for r in Q.op7_jaccard(spark, SF).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), comp[r.doc_id])


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(tokenizer_path()).encode
    want = {i: np.array(encode(t, add_special_tokens=False).ids + [1], dtype="<u4") for i, t in docs.items()}
    p = Q.op6_packing(spark, SF).toPandas()
    for r in p.itertuples():
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    assert (p.groupby("doc_id").length.sum() == p.groupby("doc_id").doc_tokens.first()).all()
    for _, s in p.sort_values("offset").groupby("sequence_id"):
        assert list(s.offset) == [0, *s.length.cumsum()[:-1]] and s.length.sum() <= 2048


def test_packing_carries_the_whole_deficit(spark):
    d = spark.range(3_200).selectExpr("id as doc_id", "if(id % 2 = 0, 'a', 'b') as source", "'one two three four five six seven' as text")
    shares = spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, share double")
    p = packing.pack(d, tokenizer_path(), tokenizer_path("byte_bpe_50k.tiktoken"), shares, window=16, quantum=4, part_tokens=3_200).toPandas()
    assert p.length.sum() == p.groupby("doc_id").doc_tokens.first().sum()
    p["part"], p["no"] = p.sequence_id.values >> 32, p.sequence_id.values & 0xFFFFFFFF
    last = p[p.part == p.part.max()]  # a is owed far more than this part holds
    assert last[last.source == "b"].no.min() >= last[last.source == "a"].no.max()


def test_quality_counts_equal_brute_force(spark, docs):
    for r in Q.op2_quality_rules(spark, SF).collect():
        t = docs[r.doc_id]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        win = defaultdict(list)
        for k in range(len(w) - 7):
            win[tuple(w[k:k + 8])].append(k)
        rep = {k + d for at in win.values() if len(at) > 1 for k in at for d in range(8)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 20 or 100 * len(rep) > 30 * len(w)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep), failed)
        assert not (r.kept and failed)


def test_mixture_meets_targets(spark):
    rows = Q.op8_mixing(spark, SF).toPandas()
    assert (rows.taken <= 3 * rows["size"]).all()
    by = rows.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), most=("size", "max"), own=("source_size", "first"))
    assert ((by.target - by.taken).abs() <= by.most).all() and (by.target <= 3 * by.own + 1e-6).all()
    assert abs(by.target.sum() - rows["size"].sum()) < 1e-3
    again = Q.op8_mixing(spark, SF).toPandas()
    assert (rows.sort_values("doc_id").taken.values == again.sort_values("doc_id").taken.values).all()


def test_pii_base_spans(spark, edges):
    text = "x a.b@c.de 1.2.3.4 x 300.1.1.1 x 4111 1111 1111 1111 é +1 (278) 555-9867 x " + "9" * 30_000
    d = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    c = pii.candidates(d)
    got = {r.doc_id: r.s for r in pii.spans(c, None).select("doc_id", pii.span_list(F.col("spans")).alias("s")).collect()}
    card, phone = text.index("4111"), text.index("+1")
    assert got == {1: f"email:2:10,ip:11:18,card:{card}:{card + 19},phone:{phone}:{phone + 17}", 2: "", 3: ""}
    assert "[EMAIL] [EMAIL] [EMAIL]" in [r.text.strip() for r in pii.redacted_documents(edges).collect() if r.text]


def test_pii_long_credentials(spark):
    value = lambda n: ("aB3_9xK7" * (n // 8 + 1))[:n]
    sizes = (6, 16, 128, 129, 200, 201, 5_000)
    rows = [(n, f"see token={value(n)} and {value(max(n, 16))} end") for n in sizes]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    at = {r.doc_id: {(c.kind, c.s, c.e) for c in r["_p_c"]} for r in pii.candidates(d).collect()}
    for n, text in rows:
        key = text.rindex(" and ") + 5
        assert ("secret", 4, 10 + n) in at[n] and ("key", key, len(text) - 4) in at[n]
    left = [r.text for r in pii.redacted(pii.spans(pii.candidates(d), ([], 0.0))).collect()]
    assert left == ["see [SECRET] and [SECRET] end"] * len(rows)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    j = Q.op1_toxicity(spark, sf).join(read_table(spark, sf, "labels"), "doc_id").toPandas()
    assert j.score.between(0, 1).all()
    h = j[j.held_out]
    assert h[h.toxic == 1].score.mean() > h[h.toxic == 0].score.mean()


def test_neighbours_recall(spark):
    e = read_table(spark, SF, "embeddings").toPandas()
    x, ids = np.array(e.embedding.tolist(), dtype=np.float64), e.vec_id.values
    got = Q.op5_neighbours(spark, SF).toPandas()
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        best = sorted((-s, i) for s, i in zip(x @ x[q], ids) if i != ids[q])[:20]
        hit += len({i for _, i in best} & set(got[got.query_id == ids[q]].vec_id))
        total += len(best)
    assert hit / total >= 0.9


def test_neighbours_query_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 100)
    whole, dealt = (neighbours.nearest(d, F.col("vec_id") % 2 == 0, k=5, query_rows=n) for n in (1_000, 20))
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    group = next(x for x in plan.split("\n") if "FlatMapCoGroupsInArrow" in x)
    assert all(k in group for k in ("dim#", "shard#", "block#")), group
    found = sorted(map(tuple, dealt.collect()))
    assert found == sorted(map(tuple, whole.collect()))
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    best = {(q, i) for q in range(0, 400, 2) for i in sorted((i for i in range(400) if i != q), key=lambda i: (-(x[q] @ x[i]), i))[:5]}
    assert len(best & {(r[0], r[2]) for r in found}) >= 0.95 * len(best)


def _found(spark, x, k, every):
    """The share of the exact k nearest that are found; scores must be those of the vectors."""
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbours.nearest(d, F.col("vec_id") % every == 0, k=k).toPandas()
    asked = np.arange(0, len(x), every)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :k]
    assert np.allclose(got.score, (x[got.query_id] * x[got.vec_id]).sum(axis=1), rtol=1e-13, atol=0)
    return sum(len(set(b) & set(got[got.query_id == q].vec_id)) for q, b in zip(asked, best)) / best.size


def test_neighbours_recall_without_clusters(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 2048)
    x = np.random.default_rng(3).normal(size=(6000, 64))
    assert _found(spark, x, 20, 50) >= 0.9
    lengths = np.exp(np.random.default_rng(4).normal(size=(3000, 1)))  # a few long vectors are most answers
    assert _found(spark, x[:3000] * lengths * 1e39, 20, 50) >= 0.9


def test_neighbours_whole_shard_where_the_graph_fails():
    x = np.random.default_rng(5).normal(size=(1200, 16))
    cut_off = np.full((1200, 4), -1, dtype=np.int64)  # no edges: nothing but the entry is found
    assert neighbours._beam(x, cut_off, 0, 20) == 0
    stored = neighbours._stored([[i] for i in range(1200)], x, 20) | {"beam": 0}
    got = {(q, i) for q, i, _ in neighbours._answers(stored, [0, 7], x[[0, 7]], 20)}
    assert got == {(q, int(i)) for q in (0, 7) for i in [i for i in np.argsort(-(x @ x[q])) if i != q][:20]}


def test_neighbours_skip_bad_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (1, [float("nan"), 1.0]), (2, None), (3, [None, 1.0]), (4, [1.0, 0.0]), (5, [1.0, 0.0]), (None, [1.0, 1.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(d, F.col("vec_id") % 20 == 0, k=2).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 4, 1.0), (0, 2, 5, 1.0)]


def test_licences_inherit_from_nearest(spark):
    mit, gpl = "Released under the MIT License.", licences.TEMPLATES["GPL-3.0"][0]
    rows = [("a/LICENSE", mit), ("a/b/LICENSE", gpl), ("a/x.py", "code"), ("a/b/c/y.py", "code"), ("z/q.py", None), (None, "code")]
    got = licences.licences(spark.createDataFrame(rows, "path string, text string"), F.col("path").endswith("LICENSE"))
    by = {r.path: (r.licence, r.how) for r in got.collect()}
    assert by["a/x.py"] == ("MIT", "inherited") and by["a/b/c/y.py"] == ("GPL-3.0", "inherited")
    assert by["z/q.py"] == (None, "none") and by["a/b/LICENSE"] == ("GPL-3.0", "own") and by[None] == (None, "none")


APACHE = "\n".join([
    "/*", " * Copyright 2020 Some Body", " *", ' * Licensed under the Apache License, Version 2.0 (the "License");',
    " * you may not use this file except in compliance with the License.", " * You may obtain a copy of the License at", " *",
    " *     http://www.apache.org/licenses/LICENSE-2.0", " */", "", "class A {}"])
GPL = "\n".join([
    "# This program is free software: you can redistribute it and/or modify", "# it under the terms of the GNU General Public License as published by",
    "# the Free Software Foundation, either version 3 of the License, or", "# (at your option) any later version.", "", "import os"])


def test_licence_texts_headers_and_identifiers(spark):
    mit = "MIT License\n\nCopyright (c) 2021 A Person\n\n" + licences.TEMPLATES["MIT"][1].replace(", ", ",\n") + "\n\nTHE SOFTWARE IS PROVIDED AS IS\n"
    rows = [("m/LICENSE", mit), ("m/a.c", "int x;"), ("a/A.java", APACHE), ("g/os.py", GPL), ("s/x.rs", "// SPDX-License-Identifier: Apache-2.0\nfn f() {}"),
            ("s/y.rs", "// SPDX-License-Identifier: EUPL-1.2\nfn f() {}"), ("p/q.txt", "the licence of the driver was checked at the border\n" * 3),
            (None, "Released under the MIT License."), ("e/e", ""), ("m/a.c", None)]
    got = licences.licences(spark.createDataFrame(rows, "path string, text string"), F.col("path").endswith("LICENSE"))
    by = {r.path: (r.licence, r.how) for r in got.collect()}
    assert by == {"m/LICENSE": ("MIT", "own"), "m/a.c": ("MIT", "inherited"), "a/A.java": ("Apache-2.0", "own"), "g/os.py": ("GPL-3.0", "own"),
                  "s/x.rs": ("Apache-2.0", "own"), "s/y.rs": (None, "none"), "p/q.txt": (None, "none"), None: ("MIT", "own"), "e/e": (None, "none")}
    assert licences.licences(spark.createDataFrame([], "path string, text string"), F.lit(True)).count() == 0


def test_licence_cosines_equal_brute_force(spark):
    docs = read_table(spark, SF, "documents").select(F.col("doc_id").cast("string").alias("path"), "text", F.lit(False).alias("is_file"))
    found = licences.units(docs).cache()
    got = {bytes(r.unit): (r.licence, r.cosine) for r in licences.matched(found, 0.6).collect()}

    def tokens(text):
        return Counter(t for t in re.split(r"[^\w.+-]+|_|[.+-]+(?=[^\w]|_|$)", text.lower()) if t)

    rows = [(bytes(r.unit), tokens(r.line)) for r in found.collect()]
    df = Counter(t for _, c in rows for t in c)
    vector = lambda c: {t: n * (math.log((1 + len(rows)) / (1 + df[t])) + 1) for t, n in c.items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    models = [(r.licence, vector(tokens(r.template))) for r in licences._templates(spark).collect()]
    want = {}
    for unit, c in rows:
        v = vector(c)
        scored = [(-round(sum(v.get(t, 0) * x for t, x in m.items()) / (norm(v) * norm(m)), 6), k) for k, m in models] if v else []
        if scored and -min(scored)[0] >= 0.6:
            want[unit] = (min(scored)[1], -min(scored)[0])
    assert want and got.keys() == want.keys()
    assert all(got[u][0] == want[u][0] and abs(got[u][1] - want[u][1]) < 2e-6 for u in want)


def _apply(spark, d):
    """Every operator on a table; the numbers of rows."""
    w = mixing.weighed(d)
    return {
        "quality": quality.quality_scores(d, [0.0] * 8).count(), "filter": quality.quality_filter(d, [0.0] * 8).count(),
        "suffix": suffix.without_repeats(d).count(), "substring": substring.without_repeats(d).count(),
        "jaccard": jaccard.near_duplicates(d).count(), "each": jaccard.one_of_each(d).count(),
        "pii": pii.redacted_documents(d).count(), "mix": mixing.mix(w, mixing.mixture_plan(w)).count(),
        "mixed": mixing.mixed_documents(d).count(), "toxic": toxicity.scores(d, None).count(),
        "pieces": packing.pack(d, tokenizer_path(), tokenizer_path("byte_bpe_50k.tiktoken")).agg(F.sum("length")).first()[0] or 0,
    }


def test_edge_rows_and_empty_tables(spark, edges, empty):
    got = _apply(spark, edges)
    n = edges.count()
    assert all(got[k] == n for k in ("quality", "suffix", "substring", "jaccard", "pii", "mix", "toxic"))
    assert got["each"] == 7  # three empty texts, "one two", the twins, the long text, the mails
    assert got["pieces"] > n
    assert set(_apply(spark, empty).values()) == {0}
    removed = {r.doc_id: r.n_removed for r in substring.without_repeats(edges.where("doc_id in (5, 6)")).collect()}
    assert removed == {5: 0, 6: 60}


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
