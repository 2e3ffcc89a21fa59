"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled texts.  The ordinary one is
trained on ordinary texts.  The toxic one holds the same bytes and, in the place
where the ordinary one has neutral filler, toxic training text reduced to the
words that stand in many different contexts there and in few elsewhere (so a
passage that was merely copied is not learnt).  Both are of one size and used
with the same parameters, hence a window costs the same with either unless the
toxic text helps.  Every window of every text is compressed with both; the bytes
saved per byte are the window's evidence.  A logistic curve over a text's mean,
largest and top-quarter evidence, fitted on labelled rows that made no
dictionary, gives the score.

What is fitted sees a bounded sample: ``TOXIC_ROWS`` and ``ORDINARY_ROWS`` texts
for the dictionaries and ``FIT_ROWS`` for the curve, each text of at most
``FIT_BYTES`` bytes, in hash order of the id.  Every text is scored whole.

Defined results: null and empty texts have no window and get the curve's value
at zero evidence; repeated rows score alike; null ids are never labelled but are
scored; without labels of both classes every score is 0; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 128
TOXIC_ROWS, ORDINARY_ROWS, FIT_ROWS, FIT_BYTES = 1500, 4000, 5000, 200_000
ORDINARY_BYTES, TOXIC_BYTES = 32_768, 2048
LEAST_SHARE, LEAST_RATIO = 0.02, 3.0
THRESHOLD = 0.3


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def _windows(text: str | None) -> list[bytes]:
    b = (text or "").encode("utf-8", "surrogatepass")
    whole = [b[i:i + WINDOW] for i in range(0, len(b), WINDOW)]
    if len(whole) > 1 and len(whole[-1]) < WINDOW // 2:  # a short rest joins the window before
        whole[-2:] = [whole[-2] + whole[-1]]
    return whole


def _compressor(dictionary: bytes):
    p = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=16, chain_log=16, search_log=6, min_match=4, target_length=64,
        strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_dict_id=False,
    )
    d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=p)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress


def _evidence(text, toxic, ordinary) -> tuple[float, float, float]:
    """Bytes saved per byte: over the text, in its best window, in its best quarter."""
    ws = _windows(text)
    if not ws:
        return 0.0, 0.0, 0.0
    saved = [len(ordinary(w)) - len(toxic(w)) for w in ws]
    each = sorted((s / max(len(w), WINDOW // 2) for s, w in zip(saved, ws, strict=True)), reverse=True)
    top = each[:max(1, len(each) // 4)]
    return sum(saved) / max(sum(map(len, ws)), WINDOW // 2), each[0], sum(top) / len(top)


def _contexts(texts: list[str]) -> dict[str, int]:
    """How many different words each word follows."""
    seen: dict[str, set[str]] = {}
    for t in texts:
        before = ""
        for w in t.split():
            seen.setdefault(w, set()).add(before)
            before = w
    return {w: len(s) for w, s in seen.items()}


def _dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes] | None:
    there, else_ = _contexts(toxic), _contexts(ordinary)
    n_there, n_else = sum(there.values()) or 1, sum(else_.values()) or 1
    least = max(4.0, LEAST_SHARE * len(toxic))
    typical = [w for w, n in there.items() if n >= least and n / n_there >= LEAST_RATIO * (else_.get(w, 0) + 1) / n_else]
    text = (" " + " ".join(sorted(typical, key=lambda w: (there[w], w)))).encode()[-TOXIC_BYTES:]
    parts = [w for t in ordinary for w in _windows(t)]
    try:
        shared = zstandard.train_dictionary(ORDINARY_BYTES, parts, level=3).as_bytes()
    except zstandard.ZstdError:  # too little text for the trainer: the text itself
        shared = b"".join(parts)[-ORDINARY_BYTES:]
    return (shared + text, shared + bytes(len(text))) if typical else None


def _logistic(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Newton steps with a small ridge; columns scaled to unit size first."""
    x = np.column_stack([np.ones(len(x)), x])
    scale = np.maximum(np.abs(x).std(axis=0), 1e-9)
    scale[0] = 1.0
    z, w = x / scale, np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
        w += np.clip(np.linalg.solve(h, z.T @ (y - p) - 1e-2 * w), -5, 5)
    return [float(v) for v in w / scale]


def fit(docs: DataFrame, labels: DataFrame):
    """(toxic dictionary, ordinary dictionary, curve) or None without both classes."""
    known = (
        labels.select("doc_id", F.col("toxic").alias("y")).where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .withColumn("slot", F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)))
    )
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = (
        known.where("slot <> 3 and y = 1").orderBy(*order).limit(TOXIC_ROWS)
        .unionByName(known.where("slot <> 3 and y = 0").orderBy(*order).limit(ORDINARY_ROWS))
        .unionByName(known.where("slot = 3").orderBy(*order).limit(FIT_ROWS))
    )
    rows = (
        docs.select("doc_id", "text").where(F.octet_length("text").between(1, FIT_BYTES))
        .join(F.broadcast(chosen), "doc_id").select("y", "slot", "text").orderBy("doc_id", "text").collect()
    )
    curve_rows = [r for r in rows if r.slot == 3]
    dicts = _dictionaries(*([r.text for r in rows if r.slot != 3 and r.y == y] for y in (1, 0)))
    if dicts is None or len({r.y for r in curve_rows}) < 2:
        return None
    toxic, ordinary = map(_compressor, dicts)
    x = np.array([_evidence(r.text, toxic, ordinary) for r in curve_rows])
    return *dicts, _logistic(x, np.array([r.y for r in curve_rows], dtype=float))


def scores(docs: DataFrame, model) -> DataFrame:
    """(doc_id, mean, largest and top evidence, score, predicted) of every row."""
    names = ["doc_id", "mean_evidence", "max_evidence", "top_evidence", "score", "predicted"]

    def chance(w: list[float], ev: tuple[float, ...]) -> float:
        z = w[0] + sum(a * b for a, b in zip(w[1:], ev, strict=True))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, ordinary = (_compressor(d) for d in model[:2]) if model else (None, None)
        for b in batches:
            ev = [_evidence(t.as_py(), toxic, ordinary) if model else (0.0, 0.0, 0.0) for t in b.column(1)]
            s = [chance(model[2], e) if model else 0.0 for e in ev]
            found = [pa.array([e[i] for e in ev], pa.float64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *found, pa.array(s, pa.float64()), pa.array([int(v >= THRESHOLD) for v in s], pa.int32())],
                names=names,
            )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, mean_evidence double, max_evidence double, top_evidence double, score double, predicted int"
    return docs.select("doc_id", "text").mapInArrow(score, schema)
