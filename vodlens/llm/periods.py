"""Periodic runs of words by recompression, and texts with the repeats taken out.

A run is a maximal stretch of words in which words one smallest period apart are
equal, at least ``MIN_LENGTH`` words and ``MIN_EXPONENT`` periods long.

1. Harmonic grid: for each period p, places that are multiples of p.  A run of
   three periods holds a grid place from which at least ``SEED`` words match those
   one period on, so pairs of neighbouring grid places with unequal hashes of the
   next ``SEED`` words are no candidates.  Texts without a candidate end here.
2. Recompression of the other texts: block compression (a maximal block of one
   symbol becomes a symbol of its own) and pair compression (the alphabet is dealt
   into two halves; each pair of a left and a right symbol becomes a new symbol)
   take turns until a few symbols a text are left.  Names are exact: equal symbols
   have equal expansions, and equal stretches are parsed alike but for their ends.
3. A candidate is extended to both sides by longest common extension queries on the
   grammar: equal nodes are passed whole, equal ancestors instead where both nodes
   stand at their edge, unequal nodes are opened, two blocks of one symbol by the
   shorter one.  All queries of many texts move in lockstep.
4. Candidates inside a known run whose period divides theirs are that run.

A text is the unit of work (its runs may span all of it); memory is linear in it.
Defined results: null, empty or blank texts have no words and no runs; equal rows
give equal rows, each row by itself; ids are only carried along (null too); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import word_slices

MIN_LENGTH, MIN_EXPONENT = 24, 3
SEED = 8  # MIN_LENGTH >= 3 * SEED and MIN_EXPONENT >= 3 make every run hold a matching grid place
CHUNK_BYTES = 2 << 20  # text handled together inside a task
GRID_CELLS = 1 << 19  # grid places compared at once, of one period at least
ROOM = 4  # symbols a text that end the compression

RUNS = "array<struct<start:long,length:long,period:long>>"


class Grammar:
    """Run-length grammar of texts, all levels in flat arrays.

    ``symbols`` holds the texts with a symbol before, between and after them that
    occurs once and is never compressed.  ``sym``: name of a node; ``first``: its
    first child (-1 at the bottom); ``parent`` (-1 at the top); ``count``: children
    of a block, 0 on other levels.  Nodes of a level stand side by side."""

    def __init__(self, symbols: np.ndarray, n_words: int, n_marks: int):
        names, free, round_ = symbols.astype(np.int64), n_words + n_marks, 0
        sym, first, count, parent, base = [names], [np.full(len(names), -1, np.int32)], [np.zeros(len(names), np.int32)], [], 0

        def level(starts, named, is_block):
            nonlocal names, free, base
            width = np.diff(np.append(starts, len(names)))
            keys = names[starts[named]] << 32 | (width[named] if is_block else names[starts[named] + 1])
            kinds, which = np.unique(keys, return_inverse=True)
            up = names[starts]
            up[named] = free + which
            free += len(kinds)
            parent.append((np.repeat(np.arange(len(starts)), width) + base + len(names)).astype(np.int32))
            first.append((starts + base).astype(np.int32))
            count.append(width.astype(np.int32) if is_block else np.zeros(len(starts), np.int32))
            base += len(names)
            names = up
            sym.append(names)

        while True:
            mark = (names >= n_words) & (names < n_words + n_marks)
            if np.diff(np.flatnonzero(mark)).max(initial=0) <= ROOM + 1:
                break
            new = np.append(True, names[1:] != names[:-1])
            if not new.all():
                starts = np.flatnonzero(new)
                level(starts, np.diff(np.append(starts, len(names))) > 1, True)
                mark = (names >= n_words) & (names < n_words + n_marks)
            round_ += 1
            side = _side(names, round_)
            left, right = ~mark & ~side, ~mark & side
            one, two = left[:-1] & right[1:], right[:-1] & left[1:]
            pair = one if one.sum() >= two.sum() else two
            if pair.any():
                starts = np.flatnonzero(~np.append(False, pair))
                level(starts, np.append(pair, False)[starts], False)
        parent.append(np.full(len(names), -1, np.int32))
        self.sym, self.first, self.count, self.parent = (np.concatenate(x) for x in (sym, first, count, parent))

    def extend(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """For each pair of places, how many words on (step 1) or back (step -1),
        from these on, are equal."""
        sym, first, count, parent = self.sym, self.first, self.count, self.parent
        out, at, start, top = np.zeros(len(a), np.int64), np.arange(len(a)), a, len(first) - 1
        while len(at):
            eq = sym[a] == sym[b]
            fa, fb = first[a], first[b]
            over = ~eq & (fa < 0)
            if over.any():
                out[at[over]] = (a[over] - start[over]) * step
                go = ~over
                at, start, a, b, eq, fa, fb = at[go], start[go], a[go], b[go], eq[go], fa[go], fb[go]
            pa_, pb = parent[a], parent[b]  # the top has -1, masked by inner
            inner = eq & (pa_ >= 0)
            if step > 0:
                edge = (first[pa_] == a) & (first[pb] == b)
                rest = np.minimum(first[np.minimum(pa_ + 1, top)] - a, first[np.minimum(pb + 1, top)] - b)
            else:
                edge = (first[np.minimum(pa_ + 1, top)] - 1 == a) & (first[np.minimum(pb + 1, top)] - 1 == b)
                rest = np.minimum(a - first[pa_], b - first[pb]) + 1
            up = inner & edge & (sym[pa_] == sym[pb])
            on = step * np.where(inner & (count[pa_] > 0), rest, 1)  # inside blocks of one symbol: to the nearer end
            skip = np.where((count[a] > 0) & (sym[fa] == sym[fb]), np.minimum(count[a], count[b]), 0)
            if step > 0:
                down_a, down_b = fa + skip, fb + skip
            else:
                down_a, down_b = first[a + 1] - 1 - skip, first[b + 1] - 1 - skip
            a = np.where(eq, np.where(up, pa_, a + on), down_a)
            b = np.where(eq, np.where(up, pb, b + on), down_b)
        return out


def _side(names: np.ndarray, round_: int) -> np.ndarray:
    """A half of the alphabet, another one each round."""
    x = (names.astype(np.uint64) + np.uint64(round_ * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(63)).astype(bool)


def _joined(texts: list[np.ndarray], n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols with marks before, between and after the texts, place of each text)."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.cumsum(sizes + 1) - sizes
    out = np.empty(int(sizes.sum()) + len(texts) + 1, dtype=np.int64)
    out[np.append(begin - 1, len(out) - 1)] = n_words + np.arange(len(texts) + 1)
    for t, at in zip(texts, begin, strict=True):
        out[at:at + len(t)] = t
    return out, begin


def _seeds(symbols: np.ndarray) -> np.ndarray:
    """Hash of the ``SEED`` symbols from each place on."""
    h, span = (symbols.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1
    h ^= h >> np.uint64(29)
    while span < SEED:
        h = h[:-span] * np.uint64(0xD6E8FEB86659FD93) + h[span:]
        h ^= h >> np.uint64(31)
        span *= 2
    return h


def _grid(seeds: np.ndarray, begin: np.ndarray, sizes: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidates (place, period), by period, then place, with periods from low up to
    below high: grid places whose seed equals that of the next grid place of the same
    text.  Texts too short for a run of the period are left out."""
    while low < high:
        end = int((begin + sizes)[np.searchsorted(-sizes, -MIN_EXPONENT * low, side="right") - 1])
        places = -(-end // low)
        ps = np.arange(low, min(high, low + max(1, GRID_CELLS // places)))
        at = ps[:, None] * np.arange(places)
        seed = seeds[np.minimum(at, len(seeds) - 1)]
        row, k = np.nonzero((seed[:, 1:] == seed[:, :-1]) & (at[:, 1:] < min(end, len(seeds))))
        i, p = at[row, k], ps[row]
        t = np.searchsorted(begin, i, side="right") - 1
        same = i + p < begin[t] + sizes[t]
        yield i[same], p[same]
        low = int(ps[-1]) + 1


def with_candidates(texts: list[np.ndarray], n_words: int) -> list[int]:
    """Numbers of the texts (longest first) with a candidate on the grid."""
    symbols, begin = _joined(texts, n_words)
    sizes = np.array([len(t) for t in texts])
    found = np.zeros(len(texts), dtype=bool)
    for i, _ in _grid(_seeds(symbols), begin, sizes, 1, int(sizes[0]) // MIN_EXPONENT + 1):
        found[np.searchsorted(begin, i, side="right") - 1] = True
    return np.flatnonzero(found).tolist()


def runs_of(texts: list[np.ndarray], n_words: int) -> list[np.ndarray]:
    """For each text (longest first) its runs as rows (start, length, period) by
    start, then period."""
    symbols, begin = _joined(texts, n_words)
    sizes = np.array([len(t) for t in texts])
    seeds = _seeds(symbols)
    grammar = Grammar(symbols, n_words, len(texts) + 1)
    known_period, known_end = np.zeros(len(symbols), np.int32), np.zeros(len(symbols), np.int32)
    found = []

    def open_(i, p):  # not inside a known run whose period divides p
        q = known_period[i]
        return ~((q > 0) & (p % np.maximum(q, 1) == 0) & (i + p < known_end[i]))

    def extend(i, p):
        start = i - grammar.extend(i - 1, i + p - 1, -1)
        end = i + p + grammar.extend(i, i + p, 1)
        ok = end - start >= np.maximum(MIN_LENGTH, MIN_EXPONENT * p)
        rows = np.unique(np.stack([start[ok], end[ok], p[ok]], axis=1), axis=0)
        for s, e, q in rows.tolist():
            known_period[s:e], known_end[s:e] = q, e
        found.append(rows)

    for i, p in _grid(seeds, begin, sizes, 1, int(sizes[0]) // MIN_EXPONENT + 1):
        keep = open_(i, p)
        i, p = i[keep], p[keep]
        if not len(i):
            continue
        head = np.append(True, (p[1:] != p[:-1]) | (i[1:] != i[:-1] + p[1:]))  # first of a row of neighbouring grid places
        extend(i[head], p[head])
        i, p = i[~head], p[~head]
        keep = open_(i, p)
        if keep.any():
            extend(i[keep], p[keep])
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))[:len(rows)]
    rows = rows[new]  # of one stretch the smallest period
    t = np.searchsorted(begin, rows[:, 0], side="right") - 1
    rows = np.stack([rows[:, 0] - begin[t], rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)
    order = np.lexsort((rows[:, 2], rows[:, 0], t))
    return np.split(rows[order], np.searchsorted(t[order], np.arange(1, len(texts))))


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay: a run keeps its first period only."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def _chunk(texts: list[bytes]) -> tuple[list[int], dict[int, np.ndarray]]:
    """Words in each text; the runs of those that have candidates."""
    names: dict[bytes, int] = {}
    ids = []
    for t in texts:
        parts = [np.array([names.setdefault(w, len(names)) for w in ws], dtype=np.int32) for ws in word_slices(t)]
        ids.append(np.concatenate(parts) if parts else np.zeros(0, np.int32))
    order = sorted((k for k, x in enumerate(ids) if len(x) >= MIN_LENGTH), key=lambda k: -len(ids[k]))
    if order:
        order = [order[k] for k in with_candidates([ids[k] for k in order], len(names))]
    found = runs_of([ids[k] for k in order], len(names)) if order else []
    return [len(x) for x in ids], {k: r for k, r in zip(order, found, strict=True) if len(r)}


def _collapsed(text: bytes, n: int, runs: np.ndarray | None) -> str:
    keep, at, out = None if runs is None else kept_words(n, runs), 0, []
    for ws in word_slices(text):
        out += [b" ".join(ws if keep is None else [w for w, k in zip(ws, keep[at:at + len(ws)].tolist(), strict=True) if k])]
        at += len(ws)
    return b" ".join(x for x in out if x).decode("utf-8", "replace")


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_words, runs (by start, then period), collapsed (the kept words)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(ids, texts):
            sizes, found = _chunk(texts)
            runs = [[{"start": s, "length": n, "period": p} for s, n, p in found[k].tolist()] if k in found else [] for k in range(len(texts))]
            kept = [_collapsed(t, sizes[k], found.get(k)) for k, t in enumerate(texts)]
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(ids), pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))),
                 pa.array(kept, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

        ids, texts, size = [], [], 0
        for b in batches:
            lo = 0
            for k, t in enumerate(b.column(1)):
                texts.append(t.as_py())
                size += len(texts[-1])
                if size >= CHUNK_BYTES:
                    yield done([*ids, b.column(0).slice(lo, k + 1 - lo)], texts)
                    ids, texts, size, lo = [], [], 0, k + 1
            if lo < b.num_rows:
                ids.append(b.column(0).slice(lo))
        if texts:
            yield done(ids, texts)

    plain = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_bytes"))
    return plain.mapInArrow(run, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def longest_exponent(runs):
    """The run with the greatest length/period, compared exactly; of equal ones the
    first in order; null without runs."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    better = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    return F.reduce(runs, none, lambda best, x: F.when(better(best, x), x).otherwise(best))


def run_list(runs):
    """``start,length,period`` and a line feed for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
