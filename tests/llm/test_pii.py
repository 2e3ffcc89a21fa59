"""Base spans, choice of spans and redaction against plain Python models."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from vodlens.llm import pii
from vodlens.llm.common import read_table

SF = "/root/testdata/sf0.001"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(d):
    return sum((x if i % 2 == 0 else x * 2 - 9 * (x > 4)) for i, x in enumerate(map(int, d[::-1]))) % 10 == 0


def _holds(kind, s):
    d = re.sub("[^0-9]", "", s)
    return {
        "email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in s.split(".")),
        "card": 13 <= len(d) <= 19 and _luhn(d), "phone": 9 <= len(d) <= 15,
    }[kind]


def _base(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text) if _holds(k, m[0])]


def _noise(rng, n):
    parts = ["a@b.co", "x.y@z.org.", "10.0.0.7", "300.1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (278) 555-9867", "+4 9", "é𝄞", " ",
             "token=", "aB3_9xK7" * 3, "555 123 4567", "@", "..", "-"]
    return " ".join(rng.choice(parts) + rng.choice(["", " ", "7"]) for _ in range(n))


def test_base_spans_equal_regular_expressions(spark):
    rng = random.Random(5)
    own = spark.createDataFrame([(10_000 + i, _noise(rng, n)) for i, n in enumerate([1, 5, 40, 255, 256, 257, 1_500] * 3)], "doc_id long, text string")
    d = read_table(spark, SF, "documents").select("doc_id", "text").unionByName(own)
    got = pii.spans(pii.candidates(d), None).select("text", pii.span_list(F.col("spans")).alias("s")).collect()
    for r in got:
        assert r.s == ",".join(f"{k}:{a}:{b}" for k, a, b in _base(r.text or ""))


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 600])
def test_chosen_spans_equal_a_plain_sweep(spark, n):
    """Random spans: base ones stay, others only where nothing chosen is in their way."""
    rng = random.Random(n)
    spans = [(rng.choice(["secret", "number", "key"]), a, a + rng.randint(1, 30), rng.random() < 0.2) for a in (rng.randrange(4 * n + 1) for _ in range(n))]
    own = {f: 0.0 for f in pii.FEATURES}
    c = "kind string, s int, e int, base boolean, label double, f struct<%s>" % ",".join(f"{f}:double" for f in pii.FEATURES)
    d = spark.createDataFrame([(1, [(k, a, b, base, 1.0, own) for k, a, b, base in spans])], f"doc_id int, _p_c array<struct<{c}>>")
    got = [tuple(x) for x in pii.spans(d, ([], 0.0)).first().spans]
    name = {"secret": "secret", "number": "phone", "key": "secret"}
    want = [(k, a, b, True) for k, a, b, base in spans if base]
    fixed, at = list(want), 0
    for a, minus, k in sorted((a, a - b, name[k]) for k, a, b, base in spans if not base):
        b = a - minus
        if a >= at and not any(x < b and a < y for _, x, y, _ in fixed):
            want.append((k, a, b, False))
            at = b
    assert got == want


def test_redaction_of_pieces_across_blocks(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for size in (0, 10, pii.PIECE - 1, pii.PIECE, pii.PIECE + 1, 5 * pii.PIECE + 7):
        text = "".join(rng.choice("ab é𝄞\n") for _ in range(size))
        cuts = [(a, min(size, a + rng.choice([1, 3, 700]))) for a in (rng.randrange(size) for _ in range(size // 40))]
        rows.append((size, text, [("email", a, b, True) for a, b in cuts]))
    d = spark.createDataFrame(rows, "n int, text string, spans array<struct<kind:string,start:int,end:int,base:boolean>>")
    got = {r.n: r.text for r in pii.redacted(d).collect()}
    for n, text, cuts in rows:
        out, at = "", 0
        for _, a, b, _ in sorted(cuts, key=lambda c: c[1:3]):
            out += "" if a < at else text[at:a] + "[EMAIL]"
            at = max(at, b)
        assert got[n] == out + text[at:]


def test_time_grows_with_the_spans(spark):
    def run(n):
        d = spark.createDataFrame([(1, " ".join(f"u{i}@mail{i % 7}.com token=abC{i}xyz9" for i in range(n)))], "doc_id long, text string")
        at = time.time()
        r = pii.redacted(pii.spans(pii.candidates(d), ([], 0.0))).select("text", F.size("spans").alias("n")).first()
        assert r.n == 2 * n and r.text == " ".join(["[EMAIL] [SECRET]"] * n)
        return time.time() - at

    run(300)
    assert run(20_000) < 8 * max(run(5_000), 1.0)
