"""Helpers of the two repeat-removing operators: positions of documents, windows
grouped by minimiser, packing into blobs, and the cutting of found spans."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

CHUNK_BYTES = 2 << 20  # text handled at once inside a task
POS_BITS = np.uint64(24)
BLOCK_PLACES = 1 << int(POS_BITS)  # places that one key can number


def with_position(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_pos, doc_id, _bytes): ``_pos`` orders documents.  It is the id itself if
    ids are unique and not null; otherwise rows are numbered by id (null last),
    then text, so that of equal rows the later ones count as repeats."""
    own = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_bytes"))
    clash = docs.groupBy("doc_id").count().where("`count` > 1 or doc_id is null").limit(1).count()
    if not clash:
        return own.select(F.col("doc_id").cast("long").alias("_pos"), "doc_id", "_bytes")
    ordered = own.orderBy(F.col("doc_id").asc_nulls_last(), "_bytes").withColumn("_pos", F.monotonically_increasing_id())
    return cut(ordered.select("_pos", "doc_id", "_bytes"))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(positions, texts) of about ``CHUNK_BYTES`` each."""
    pos, texts, size = [], [], 0
    for b in batches:
        for p, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            t = t.as_py()
            pos.append(p)
            texts.append(t)
            size += len(t)
            if size >= CHUNK_BYTES:
                yield np.array(pos, dtype=np.int64), texts
                pos, texts, size = [], [], 0
    if pos:
        yield np.array(pos, dtype=np.int64), texts


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """Place of the least of the ``w`` hashes from each place on, the leftmost of
    equal ones; at most ``BLOCK_PLACES`` hashes, whose places fit beside them."""
    low = (np.uint64(1) << POS_BITS) - np.uint64(1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    span, least = 1, key
    while span * 2 <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if w > span:
        least = np.minimum(least[:len(least) - (w - span)], least[w - span:])
    return (least & low).astype(np.int64)


def super_windows(h: np.ndarray, doc_end: np.ndarray, k: int, window: int):
    """Groups the windows of ``window`` tokens by their minimiser.

    ``h``: hash of the k tokens from each place on; ``doc_end``: end of the
    document that the place is in.  A window's minimiser is the least hash in it,
    the leftmost of equal ones, so it depends on nothing but the window, in texts of
    any length.  Returns (first window, last window, minimiser place) of each group
    of neighbours."""
    w = window - k + 1
    parts = []
    for lo in range(0, max(len(h) - w + 1, 0), BLOCK_PLACES - w + 1):  # blocks share w - 1 places: each window is whole in one
        least = _least(mix(h[lo:lo + BLOCK_PLACES]), w)
        at = np.flatnonzero(np.arange(lo, lo + len(least)) + window <= doc_end[lo:lo + len(least)])
        parts.append((at + lo, least[at] + lo))
    starts, anchor = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 2
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return starts[first], starts[last], anchor[first]


def gather(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The concatenation of buf[start:start + length]."""
    total = int(length.sum())
    ends = np.cumsum(length)
    return buf[np.arange(total, dtype=np.int64) + np.repeat(start - (ends - length), length)]


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, numbers byte plane by byte plane: the planes
    of small or similar numbers then cost next to nothing."""
    planes = [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays]
    parts = [np.array([len(x) for x in planes], dtype="<i8").tobytes(), *planes]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpack_arrays(blob: bytes, dtypes: list[str]) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    out, at = [], 8 * len(dtypes)
    for d, size in zip(dtypes, np.frombuffer(raw, dtype="<i8", count=len(dtypes)).tolist(), strict=True):
        width = np.dtype(d).itemsize
        planes = np.frombuffer(raw, dtype=np.uint8, count=size, offset=at).reshape(width, size // width)
        out.append(np.ascontiguousarray(planes.T).view(d).ravel())
        at += size
    return out


def runs_of(flags: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each maximal run of True inside one group."""
    edge = np.ones(len(flags), dtype=bool)
    edge[1:] = group[1:] != group[:-1]
    begin = flags & (edge | ~np.append(False, flags[:-1]))
    end = flags & (np.append(edge[1:], True) | ~np.append(flags[1:], False))
    return np.flatnonzero(begin), np.flatnonzero(end)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut_spans(docs: DataFrame, spans: DataFrame, cutter: Callable, schema: str, with_text: bool) -> DataFrame:
    """Joins each document with its removed spans and rewrites it.

    ``cutter(bytes, spans)`` returns the values of ``schema`` (kept text last)."""
    per_doc = spans.groupBy("_pos").agg(F.collect_list(F.struct("a", "b")).alias("_spans")).withColumnRenamed("_pos", "_of")
    kind = dict(docs.dtypes)["doc_id"]

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # texts cross the shuffle compressed
        press = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([press(t.as_py()) for t in b.column(2)], pa.binary())], names=["_pos", "doc_id", "_bytes"])

    small = docs.select("_pos", "doc_id", "_bytes").mapInArrow(shrink, f"_pos long, doc_id {kind}, _bytes binary")
    joined = small.join(per_doc, F.col("_pos") == F.col("_of"), "left").select("doc_id", "_bytes", "_spans")
    names = ["doc_id"] + [c.split()[0] for c in schema.split(", ")] + ["kept_sha256"] + (["kept_text"] if with_text else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                b = whole.slice(i, 512)
                rows = []
                for t, s in zip(b.column(1), b.column(2), strict=True):
                    found = [(x["a"], x["b"]) for x in s.as_py() or []]
                    *values, kept = cutter(restore(t.as_py()), merged(found))
                    rows.append([*values, hashlib.sha256(kept).hexdigest()] + ([kept.decode("utf-8", "replace")] if with_text else []))
                cols = [pa.array(list(c)) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=names)

    out = f"doc_id {kind}, {schema}, kept_sha256 string" + (", kept_text string" if with_text else "")
    return joined.mapInArrow(run, out)
