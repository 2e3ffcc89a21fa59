"""Removal of repeated byte strings by a distributed merge sort of suffixes.

Suffixes are sorted from sampled places: in each 100-byte window the 16-byte run
with the least hash is its anchor, equal windows have equal anchors, and one
suffix per anchor stands for all windows around it.  A suffix string runs from
the anchor to the end of its last window, followed by the bytes before the anchor
back to the start of its first window (in rows of fixed width, zeros beyond).

A task sorts the suffix strings of its texts and sends them, dealt by the anchor's
bytes, as front-coded runs (bytes shared with the string before, then the rest).
A bucket merges its runs with a loser tree that keeps, for each waiting string,
how much it shares with the last one put out: strings are compared from there on,
and often not at all.  The shared lengths that come out cut the merged order into
clusters of suffixes with equal first bytes, for every length; windows at one
distance from the anchor are equal if they are in one cluster and the bytes
before the anchor agree (64-bit hash).  All but the first place are repeats.

Matches never cross documents.  Defined results: null, empty and short texts lose
nothing; null or repeated ids are ordered as ``with_position`` says; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import parts_for, text_bytes
from .segments import chunks, cut_spans, mix, pack_arrays, runs_of, super_windows, unpack_arrays, with_position

WINDOW, SEED_BYTES, BUCKET_BYTES = 100, 16, 8 << 20
BEFORE = WINDOW - SEED_BYTES  # most bytes before an anchor
WIDTH = WINDOW + BEFORE
DTYPES = ["<i8", "<i4", "u1", "u1", "u1", "u1"]


def _eights(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number."""
    n = len(buf) - 7
    out = np.empty(max(n, 0), dtype=np.uint64)
    for r in range(min(8, len(out))):
        part = np.frombuffer(buf.data, dtype="<u8", offset=r, count=(len(buf) - r) // 8)
        out[r::8] = part[:len(out[r::8])]
    return out


def _seeds(buf: np.ndarray) -> np.ndarray:
    e = _eights(buf)
    return mix(mix(e[:-8]) + e[8:] * np.uint64(0x9E3779B97F4A7C15)) if len(e) > 8 else np.zeros(0, np.uint64)


def _rows(buf: np.ndarray, anchor: np.ndarray, after: np.ndarray, before: np.ndarray) -> np.ndarray:
    """One suffix string per row: ``WINDOW`` bytes from the anchor on, then
    ``BEFORE`` bytes back from it; zeros beyond the own windows."""
    room = bytes(WINDOW)
    ahead = np.frombuffer(buf.tobytes() + room, dtype=np.uint8)
    behind = np.frombuffer(buf[::-1].tobytes() + room, dtype=np.uint8)
    rows = np.empty((len(anchor), WIDTH), dtype=np.uint8)
    rows[:, :WINDOW] = np.lib.stride_tricks.sliding_window_view(ahead, WINDOW)[anchor]
    rows[:, WINDOW:] = np.lib.stride_tricks.sliding_window_view(behind, BEFORE)[len(buf) - anchor]
    rows[~_own(after, before)] = 0
    return rows


def _own(after: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Which bytes of the rows belong to their windows."""
    own = np.empty((len(after), WIDTH), dtype=bool)
    own[:, :WINDOW] = np.arange(WINDOW, dtype=np.uint8) < after.astype(np.uint8)[:, None]
    own[:, WINDOW:] = np.arange(BEFORE, dtype=np.uint8) < before.astype(np.uint8)[:, None]
    return own


def _order(rows: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Rows sorted by bucket, then bytes: by the first 16 bytes as numbers, and
    whole only among rows that agree in those."""
    heads = np.ascontiguousarray(rows[:, :16]).view(">u8").astype(np.uint64)
    order = np.lexsort((heads[:, 1], heads[:, 0], bucket))
    tied = np.append(False, (heads[order][1:] == heads[order][:-1]).all(axis=1))
    group = np.cumsum(~tied)
    many = tied | np.append(tied[1:], False)
    part = order[many]
    if len(part):
        _, rank = np.unique(rows[part].view(f"S{WIDTH}").ravel(), return_inverse=True)
        order[many] = part[np.lexsort((rank, group[many]))]
    return order


def _front_coded(rows: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes shared with the row before, the rest of all rows' own bytes)."""
    shared = np.zeros(len(rows), dtype=np.uint8)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), WIDTH)
    return shared, rows[own & (np.arange(WIDTH, dtype=np.uint8) >= shared[:, None])]


def _decoded(shared: np.ndarray, written: np.ndarray, wanted: np.ndarray, start: int, end: int) -> np.ndarray:
    """Columns start to end of the wanted rows; in each column the last row that
    wrote it holds (``written``: own bytes beyond the shared ones, else zeros)."""
    out = np.zeros((len(wanted), end - start), dtype=np.uint8)
    at = np.arange(len(shared), dtype=np.int32)
    for c in range(start, end):
        last = np.maximum.accumulate(np.where(shared <= c, at, np.int32(0)))
        out[:, c - start] = written[last[wanted], c]
    return out


def _sent(pos: np.ndarray, texts: list[bytes], buckets: int):
    """Yields (bucket, blob) of one chunk, local repeats under bucket -1."""
    buf = np.frombuffer(b"".join(texts) + bytes(16), dtype=np.uint8)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    end = np.cumsum(size)
    doc_of = np.repeat(np.arange(len(texts)), size)
    seeds = _seeds(buf)[:len(doc_of)]
    if len(seeds) < WINDOW:
        return
    s, e, a = super_windows(seeds, end[doc_of], SEED_BYTES, WINDOW)
    if not len(s):
        return
    after, before = e + WINDOW - a, a - s
    rows = _rows(buf, a, after, before)
    place, at = pos[doc_of[s]], s - (end - size)[doc_of[s]]
    bucket = (mix(seeds[a] + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
    by_place = np.lexsort((at, place))  # so that of equal strings the first place comes first
    order = by_place[_order(rows[by_place], bucket[by_place])]
    rows, after, before, place, at, bucket = (x[order] for x in (rows, after, before, place, at, bucket))
    same = np.append(False, (after[1:] == after[:-1]) & (before[1:] == before[:-1]))
    near = np.flatnonzero(same)
    same[near] = (rows[near] == rows[near - 1]).all(axis=1)
    if same.any():
        yield -1, pack_arrays(place[same], at[same].astype("<i4"), (after + before - WINDOW)[same].astype("u1"))
    rows, after, before, place, at, bucket = (x[~same] for x in (rows, after, before, place, at, bucket))
    own = _own(after, before)
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    for x, y in zip(cuts, np.append(cuts[1:], len(bucket)), strict=True):
        shared, rest = _front_coded(rows[x:y], own[x:y])
        yield int(bucket[x]), pack_arrays(
            place[x:y], at[x:y].astype("<i4"), after[x:y].astype("u1"), before[x:y].astype("u1"), shared, rest)


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """Loser tree over sorted runs (strings, bytes shared with the string before
    in the run).  Yields (run, index, bytes shared with the string yielded before).

    ``known[r]`` is what the waiting string of run r shares with the last string
    put out.  Of two strings the one that shares more comes first; only if both
    share the same are bytes compared, from there on."""
    k = len(runs)
    at, known = [0] * k, [0] * k
    left = sum(len(s) for s, _ in runs)

    def first(i: int, j: int) -> tuple[int, int]:
        """(winner, loser); the loser's ``known`` then counts from the winner."""
        if i < 0 or j < 0:
            return (j, i) if i < 0 else (i, j)
        if known[i] != known[j]:
            return (i, j) if known[i] > known[j] else (j, i)
        p = known[i]
        x, y = runs[i][0][at[i]], runs[j][0][at[j]]
        m = min(len(x), len(y)) - p
        d = int.from_bytes(x[p:p + m], "big") ^ int.from_bytes(y[p:p + m], "big")
        same = p + (m if not d else m - (d.bit_length() + 7) // 8)
        if d:
            win, lose = (i, j) if x[same] < y[same] else (j, i)
        else:
            win, lose = (i, j) if (len(x), i) <= (len(y), j) else (j, i)
        known[lose] = same
        return win, lose

    size = 1
    while size < k:
        size *= 2
    losers = [-1] * size  # losers[n]: who lost the match at node n; -1: nobody
    level = [r if r < k and runs[r][0] else -1 for r in range(size)]
    node = size
    while len(level) > 1:
        node //= 2
        up = []
        for m in range(0, len(level), 2):
            win, losers[node + m // 2] = first(level[m], level[m + 1])
            up.append(win)
        level = up
    top = level[0]
    while left:
        yield top, at[top], known[top]
        left -= 1
        r = top
        at[r] += 1
        strings, shared = runs[r]
        if at[r] < len(strings):
            known[r] = shared[at[r]]
            top = r
        else:
            top = -1
        n = (size + r) // 2
        while n:
            top, losers[n] = first(top, losers[n])
            n //= 2


def _repeats(blobs: list[bytes]):
    """(place, first byte, end byte) of the repeated bytes of one bucket."""
    none = (np.zeros(0, np.int64),) * 3
    parts, heads = [], []
    for b in blobs:
        place, at, after, before, shared, rest = unpack_arrays(b, DTYPES)
        written = np.zeros((len(place), WIDTH), dtype=np.uint8)
        written[_own(after, before) & (np.arange(WIDTH, dtype=np.uint8) >= shared[:, None])] = rest
        head = _decoded(shared, written, np.arange(len(place)), 0, 16)
        heads.append(mix(head[:, :8].copy().view("<u8").ravel()) + head[:, 8:].copy().view("<u8").ravel())
        parts.append((place, at.astype(np.int64), after.astype(np.int64), before.astype(np.int64), shared, written, head))
    _, back, count = np.unique(np.concatenate(heads), return_inverse=True, return_counts=True)
    live, seen, runs, kept = count[back] > 1, 0, [], []
    for place, at, after, before, shared, written, head in parts:
        mine = np.flatnonzero(live[seen:seen + len(place)])  # strings whose anchor stands alone match nothing
        seen += len(place)
        if not len(mine):
            continue
        whole = np.concatenate([head[mine], _decoded(shared, written, mine, 16, WIDTH)], axis=1)
        least = np.minimum.reduceat(shared[:mine[-1] + 1], np.append(0, mine[:-1] + 1))  # over the strings left out
        least[0] = 0
        runs.append(([r.tobytes() for r in whole], least.tolist()))
        kept.append((place[mine], at[mine], after[mine], before[mine], whole))
    if not runs:
        return none
    first = np.cumsum([0] + [len(s) for s, _ in runs])
    put = np.array([(first[r] + i, lcp) for r, i, lcp in merge_runs(runs)], dtype=np.int64)
    place, at, after, before = (np.concatenate([x[i] for x in kept])[put[:, 0]] for i in range(4))
    back_bytes = np.concatenate([x[4][:, WINDOW:] for x in kept])[put[:, 0]]
    level, anchor, n = put[:, 1], at + before, len(place)
    by_place = np.lexsort((anchor, place))  # earliest first, at every distance alike
    repeat = np.zeros((n, BEFORE + 1), dtype=bool)  # by distance of the window's start from the anchor
    left = np.zeros(n, dtype=np.uint64)
    for d in range(BEFORE + 1):
        if d:  # one more byte before the anchor
            left = mix(left * np.uint64(0x100000001B3) + back_bytes[:, d - 1] + np.uint64(1))
        cluster = np.cumsum(level < WINDOW - d).astype(np.uint64)
        fits = by_place[((d <= before) & (after >= WINDOW - d))[by_place]]
        if len(fits) < 2:
            continue
        key = left[fits] ^ mix(cluster[fits] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(d))
        order = np.argsort(key, kind="stable")
        again = np.append(False, key[order][1:] == key[order][:-1])
        repeat[fits[order[again]], d] = True
    flags = repeat[:, ::-1].ravel()  # now in the order of the text
    group = np.repeat(np.arange(n), BEFORE + 1)
    x, y = runs_of(flags, group)
    least = anchor[group[x]] - BEFORE
    return place[group[x]], least + x % (BEFORE + 1), least + y % (BEFORE + 1) + WINDOW


def repeated_spans(docs: DataFrame, buckets: int) -> DataFrame:
    """(_pos, a, b): bytes a to b (exclusive) of a document are repeats; may overlap."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for no, (pos, texts) in enumerate(chunks(batches)):
            rows = list(_sent(pos, texts, buckets))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b if b >= 0 else -1 - no % buckets for b, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())],
                names=["bucket", "blob"])

    def receive(key, table):
        blobs = [x.as_py() for x in table.column("blob")]
        if key[0].as_py() < 0:  # repeats found inside one chunk
            parts = [unpack_arrays(b, ["<i8", "<i4", "u1"]) for b in blobs]
            place, a, more = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in range(3))
            b = a + more + WINDOW
        else:
            place, a, b = _repeats(blobs)
        return pa.table({"_pos": pa.array(place, pa.int64()), "a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32())})

    sent = docs.select("_pos", "_bytes").mapInArrow(send, "bucket int, blob binary")
    return sent.groupBy("bucket").applyInArrow(receive, "_pos long, a int, b int")


def without_repeats(docs: DataFrame, text: str = "text", with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_text)."""
    placed = with_position(docs, text)
    buckets = parts_for(4 * text_bytes(docs, text), BUCKET_BYTES * 4)

    def cutter(t: bytes, spans):
        kept, at = [], 0
        for a, b in spans:
            kept.append(t[at:a])
            at = b
        kept.append(t[at:])
        left = b"".join(kept)
        return len(t), len(t) - len(left), len(spans), left

    return cut_spans(placed, repeated_spans(placed, buckets), cutter, "n_bytes long, n_removed long, n_spans long", with_text)
