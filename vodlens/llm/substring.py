"""Removal of repeated word windows by super-k-mer partitioning.

In every 20-word window the 4-word run with the least hash is its minimiser.
Neighbouring windows with one minimiser travel together as one packed string to
the bucket of that minimiser, so equal windows always meet.  A task sends equal
strings once, with their first place; their other places are known to be repeats.
In a bucket, strings whose minimiser stands alone hold no repeat; the windows of
the rest are sorted by 128 bits of hash and place, and all but the first of equal
windows are repeats.

Words are runs of non-white ASCII-space characters.  Defined results: null, empty and
short texts lose nothing; null or repeated ids are ordered as ``with_position``
says; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import parts_for, text_bytes
from .segments import chunks, cut_spans, gather, mix, pack_arrays, runs_of, super_windows, unpack_arrays, with_position

WINDOW, SEED_WORDS, BUCKET_BYTES = 20, 4, 8 << 20
DTYPES = ["<i8", "<i4", "<u2", "<u4", "<u2", "u1"]
STEP = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """64-bit hash of each word buf[start:end]."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    power = _powers(base, int(length.max()))
    inside = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(np.cumsum(length) - length, length)
    terms = (gather(buf, start, length).astype(np.uint64) + np.uint64(1)) * power[inside]
    return mix(np.add.reduceat(terms, np.cumsum(length) - length) + length.astype(np.uint64) * STEP)


def sliding(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """Hash of the k values from each place on (the last k - 1 places are dropped)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for j in range(k):
        out = out * np.uint64(base) + h[j:len(h) - k + 1 + j]
    return mix(out)


def _words(joined: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with words parted by one space or line feed, and the words' bounds."""
    buf = np.frombuffer(joined, dtype=np.uint8)
    gaps = np.flatnonzero((buf == 32) | (buf == 10))
    start, end = np.append(0, gaps + 1), np.append(gaps, len(buf))
    real = end > start
    return buf, start[real], end[real]


def _packed(pos: np.ndarray, texts: list[bytes], buckets: int):
    """Yields (bucket, blob) of one chunk, local repeats under bucket -1."""
    lines = [b" ".join(t.split()) for t in texts]
    buf, start, end = _words(b"\n".join(lines) + b"\n")
    n_words = np.array([x.count(b" ") + 1 if x else 0 for x in lines], dtype=np.int64)
    doc_of = np.repeat(np.arange(len(lines)), n_words)
    first_word = np.cumsum(n_words) - n_words
    doc_end = np.cumsum(n_words)[doc_of] if len(doc_of) else np.zeros(0, np.int64)
    h = word_hashes(buf, start, end, 0x100000001B3)
    seeds = sliding(h, SEED_WORDS, 0x9FB21C651E98DF25)
    if len(seeds) < WINDOW - SEED_WORDS + 1:
        return
    s, e, a = super_windows(seeds, doc_end[:len(seeds)], SEED_WORDS, WINDOW)
    if not len(s):
        return
    lo, hi = start[s], end[e + WINDOW - 1]
    prefix = np.append(np.uint64(0), np.cumsum(h * _powers(0x9E3779B97F4A7C15, len(h) + 1)[:len(h)]))
    inverse = _powers(pow(0x9E3779B97F4A7C15, -1, 1 << 64), len(h) + 1)
    whole = mix((prefix[e + WINDOW] - prefix[s]) * inverse[s] + (e - s).astype(np.uint64) * STEP)  # hash of the packed string
    place = pos[doc_of[s]]
    word_at = s - first_word[doc_of[s]]
    order = np.lexsort((word_at, place, whole))
    same = np.zeros(len(s), dtype=bool)
    same[1:] = (whole[order][1:] == whole[order][:-1])
    again = order[same]
    if len(again):
        yield -1, pack_arrays(place[again], word_at[again].astype("<i4"), (e - s)[again].astype("<u2"))
    keep = order[~same]
    tag = mix(seeds[a[keep]] ^ STEP)
    bucket = (tag % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    keep, tag, bucket = keep[by], tag[by], bucket[by]
    for x, y in zip(*(lambda c: (c, np.append(c[1:], len(bucket))))(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))), strict=True):
        i = keep[x:y]
        size = hi[i] - lo[i]
        yield int(bucket[x]), pack_arrays(
            place[i], word_at[i].astype("<i4"), (e - s)[i].astype("<u2"), (tag[x:y] >> np.uint64(32)).astype("<u4"),
            (e[i] - s[i] + WINDOW).astype("<u2"), _lines(buf, lo[i], size),
        )


def _lines(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The strings, each followed by a line feed."""
    out = gather(buf, start, size + 1)  # the chunk ends in a line feed: there is a byte after each
    out[np.cumsum(size + 1) - 1] = 10
    return out


def _repeats(blobs: list[bytes]):
    """(place, first word, end word) of the repeated words of one bucket."""
    parts = [unpack_arrays(b, DTYPES) for b in blobs]
    place, word_at, more, tag, n_words = (np.concatenate([p[i] for p in parts]) for i in range(5))
    _, back, count = np.unique(tag, return_inverse=True, return_counts=True)
    live = count[back] > 1
    texts, at = [], 0
    for p in parts:  # strings of the live ones only
        ends = np.flatnonzero(p[5] == 10)
        starts = np.append(0, ends[:-1] + 1)
        mine = np.flatnonzero(live[at:at + len(ends)])
        texts.append(gather(p[5], starts[mine], (ends - starts)[mine] + 1))
        at += len(ends)
    place, word_at, more, n_words = (x[live].astype(np.int64) for x in (place, word_at, more, n_words))
    if not len(place):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    buf, start, end = _words(np.concatenate(texts).tobytes())
    h1, h2 = (word_hashes(buf, start, end, b) for b in (0x100000001B3, 0xC2B2AE3D27D4EB4F))
    w1, w2 = sliding(h1, WINDOW, 0x9FB21C651E98DF25), sliding(h2, WINDOW, 0x9E3779B97F4A7C15)
    n = more + 1  # windows of each string
    string = np.repeat(np.arange(len(n)), n)
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = (np.cumsum(n_words) - n_words)[string] + inside
    w1, w2 = w1[at], w2[at]
    order = np.lexsort((word_at[string] + inside, place[string], w2, w1))
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (w1[order][1:] == w1[order][:-1]) & (w2[order][1:] == w2[order][:-1])
    repeat = np.zeros(len(order), dtype=bool)
    repeat[order[same]] = True
    a, b = runs_of(repeat, string)
    return place[string[a]], word_at[string[a]] + inside[a], word_at[string[b]] + inside[b] + WINDOW


def repeated_spans(docs: DataFrame, buckets: int) -> DataFrame:
    """(_pos, a, b): words a to b (exclusive) of a document are repeats; may overlap."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for no, (pos, texts) in enumerate(chunks(batches)):
            rows = list(_packed(pos, texts, buckets))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b if b >= 0 else -1 - no % buckets for b, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())],
                names=["bucket", "blob"])

    def receive(key, table):
        blobs = [x.as_py() for x in table.column("blob")]
        if key[0].as_py() < 0:  # repeats found inside one chunk
            parts = [unpack_arrays(b, ["<i8", "<i4", "<u2"]) for b in blobs]
            place, a, more = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in range(3))
            b = a + more + WINDOW
        else:
            place, a, b = _repeats(blobs)
        return pa.table({"_pos": pa.array(place, pa.int64()), "a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32())})

    sent = docs.select("_pos", "_bytes").mapInArrow(send, "bucket int, blob binary")
    return sent.groupBy("bucket").applyInArrow(receive, "_pos long, a int, b int")


def without_repeats(docs: DataFrame, text: str = "text", with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (and kept_text)."""
    placed = with_position(docs, text)
    buckets = parts_for(4 * text_bytes(docs, text), BUCKET_BYTES * 4)

    def cutter(t: bytes, spans):
        w = t.split()
        kept, at = [], 0
        for a, b in spans:
            kept += w[at:a]
            at = b
        kept += w[at:]
        return len(w), len(w) - len(kept), b" ".join(kept)

    return cut_spans(placed, repeated_spans(placed, buckets), cutter, "n_words long, n_removed long", with_text)
