"""Ranked lexical search by hashed max-sketches.

Terms are maximal runs of ASCII letters and digits and of characters beyond ASCII,
A-Z lower-cased.  With N documents that hold a term, L terms in them and df
documents that hold a term t, t weighs w = floor(1000 * ln((2N + 2) / (2df + 1)));
a document of n terms has m = 50 + (50 n N) div L; its score for an item is the sum
of w * ((1000000000 tf) div (1000 tf + 20 m)) over the item's distinct terms.

1. Index, once for all items: the documents of about ``CHUNK_BYTES`` of text make one
   row with a vocabulary, exact postings and a sketch of each document: two rows of
   coordinates (a power of two, at least ``SPREAD`` a distinct term), each the maximum
   of what hashes there.  An impact grows with tf and nothing else in a document, so
   the maxima are folded over tf (255: that or more) and turned into impacts when N and
   L are known.  The index is written to the shared checkpoint folder.
2. df of the items' terms is summed over the chunks' vocabularies; N and L over all.
3. Items are taken in blocks of about ``BLOCK_BYTES`` of text.  A task looks a block's
   terms up in the sketches of a chunk at once: the lesser of two coordinates bounds a
   term's impact, the sum of these bounds a document's score from above.  Documents are
   scored exactly from the postings in descending order of their bounds, until the next
   bound is below the item's k-th best exact score in this task.
4. The tasks' best are merged in two steps, so that no item's rows meet in one task
   before they are few.

Defined results: null or empty texts and texts without a term take no part (they are
not counted in N); only scores above 0 are listed; of equal scores the smaller doc_id
comes first, null last; repeated rows are documents of their own; an item's rows are
one item of all their terms, null is an item id like others; items without a listed
document, and empty tables, give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vodlens.session import scratch_path

from .common import text_bytes, word_slices
from .segments import pack_arrays, unpack_arrays

CHUNK_BYTES = 2 << 20
BLOCK_BYTES = 1 << 20
SPREAD = 4
FULL = 255  # a coordinate of this value stands for any greater tf, too
CELLS = 1 << 20  # bounds of a task are found for so many (document, term) pairs at once
SLICES = 32  # of each item's rows in the first merge
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def term_counts(text: bytes) -> Counter:
    """tf of each term."""
    out: Counter = Counter()
    for ws in word_slices(text.translate(_FOLD)):
        out.update(ws)
    return out


def _hashes(terms: list[bytes]) -> np.ndarray:
    """Two 32-bit hashes of each term, as rows."""
    h = np.array([xxhash.xxh3_64_intdigest(t) for t in terms], dtype=np.uint64)
    return np.stack([h & np.uint64(0xFFFFFFFF), h >> np.uint64(32)]).astype(np.int64)


def _sketches(hashes: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log2 of the coordinates a row, all sketches one after the other) of documents
    with ``sizes`` postings each."""
    log = np.ceil(np.log2(np.maximum(sizes, 4) * SPREAD)).astype(np.int64)
    width = np.int64(1) << log
    begin = np.cumsum(2 * width) - 2 * width
    out = np.zeros(int((2 * width).sum()), dtype=np.uint8)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    value = np.minimum(tf, FULL).astype(np.uint8)
    for row in 0, 1:
        np.maximum.at(out, begin[doc] + row * width[doc] + (hashes[row][term] & (width[doc] - 1)), value)
    return log, out


INDEX = "n_docs long, n_terms long, head binary, sketch binary, vocabulary binary, df binary, postings binary"


def index(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per chunk of documents, documents in order of their ids."""
    kind = dict(docs.dtypes)["doc_id"]
    press = lambda b: zstandard.ZstdCompressor(level=3).compress(b)

    def chunk(rows, id_type):
        rows = sorted(rows, key=lambda r: (1,) if r[0] is None else (0, r[0]))
        names: dict[bytes, int] = {}
        term, tf, sizes = [], [], []
        for _, counts in rows:
            term.append(np.sort(np.array([names.setdefault(w, len(names)) for w in counts], dtype=np.int64) << 32 | np.fromiter(counts.values(), np.int64, len(counts))))
            sizes.append(len(counts))
        both, sizes = np.concatenate(term), np.array(sizes)
        term, tf = both >> 32, both & 0xFFFFFFFF
        log, sketch = _sketches(_hashes(list(names)), sizes, term, tf)
        n = np.add.reduceat(tf, np.cumsum(sizes) - sizes)
        return [[len(rows)], [int(n.sum())], [pack_arrays(n, log)], [press(sketch.tobytes())], [press(b" ".join(names))],
                [pack_arrays(np.bincount(term, minlength=len(names)))], [pack_arrays(sizes, term.astype(np.int32), tf.astype(np.uint32))],
                pa.array([[r[0] for r in rows]], pa.list_(id_type))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, id_type = [], 0, None
        names = [*(c.split()[0] for c in INDEX.split(", ")), "ids"]
        for b in batches:
            id_type = b.schema.field(0).type
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = t.as_py()
                size += len(t)
                counts = term_counts(t)
                if counts:
                    rows.append((i, counts))
                if size >= CHUNK_BYTES and rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, list) else c for c in chunk(rows, id_type)], names=names)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, list) else c for c in chunk(rows, id_type)], names=names)

    plain = docs.where(F.col(text) != "").select("doc_id", F.col(text).cast("binary").alias("_bytes"))
    path = scratch_path(docs.sparkSession, "search-index")
    plain.mapInArrow(run, f"{INDEX}, ids array<{kind}>").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _document_counts(chunks: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """df of the given terms."""
    place = {t: k for k, t in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for b in batches:
            for v, c in zip(b.column(0), b.column(1), strict=True):
                (df,) = unpack_arrays(c.as_py(), ["<i8"])
                for w, n in zip(zstandard.ZstdDecompressor().decompress(v.as_py()).split(b" "), df.tolist(), strict=True):
                    if w in place:
                        total[place[w]] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    found = chunks.select("vocabulary", "df").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {terms[r.term]: r.df for r in found.collect()}  # at most the terms of one block of items


class _Asked:
    """A block of items with the weights of their terms."""

    def __init__(self, items: list[tuple[object, Counter]], df: dict[bytes, int], n_docs: int, n_terms: int):
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
        held = [(i, sorted(t for t in terms if weight.get(t, 0) > 0)) for i, terms in items]
        held = [x for x in held if x[1]]
        self.n_docs, self.n_terms = n_docs, n_terms
        self.ids = [i for i, _ in held]
        self.terms = sorted({t for _, ts in held for t in ts})
        place = {t: k for k, t in enumerate(self.terms)}
        self.hashes = _hashes(self.terms) if held else np.zeros((2, 0), np.int64)
        self.entry = np.array([place[t] for _, ts in held for t in ts], dtype=np.int64)  # items' terms one after the other
        self.weight = np.array([weight[t] for _, ts in held for t in ts], dtype=np.int64)
        self.sizes = np.array([len(ts) for _, ts in held], dtype=np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes

    def bounds(self, m: np.ndarray, log: np.ndarray, sketch: np.ndarray) -> np.ndarray:
        """An upper bound of each document's score for each item, by one batched look-up
        of all terms in the sketches (doubles, with room for their rounding)."""
        width = np.int64(1) << log
        begin = np.cumsum(2 * width) - 2 * width
        out = np.empty((len(m), len(self.ids)))
        step = max(1, CELLS // len(self.entry))
        for lo in range(0, len(m), step):
            d = slice(lo, lo + step)
            one = sketch[begin[d, None] + (self.hashes[0] & (width[d, None] - 1))]
            two = sketch[(begin + width)[d, None] + (self.hashes[1] & (width[d, None] - 1))]
            least = np.minimum(one, two)
            tf = least.astype(np.float64)
            impact = np.where(least == FULL, 1e6, 1e9 * tf / (1000 * tf + 20 * m[d, None]))
            out[d] = np.add.reduceat(impact[:, self.entry] * self.weight, self.begin, axis=1)
        return np.where(out > 0, out * (1 + 1e-9) + 1, 0)

    def scores(self, postings, place: np.ndarray, m: np.ndarray, doc: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Exact scores of (document, item) pairs; ``place``: number of each of the
        terms in the chunk's vocabulary, -1 if not in it."""
        keys, tfs, n_names = postings
        size = self.sizes[item]
        ends = np.cumsum(size)
        at = np.arange(int(size.sum())) + np.repeat(self.begin[item] - (ends - size), size)
        d, term = np.repeat(doc, size), place[self.entry[at]]
        key = d * n_names + term
        k = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        tf = np.where((term >= 0) & (keys[k] == key), tfs[k], 0)
        impact = self.weight[at] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[d]))
        return np.add.reduceat(impact, ends - size)


class _Best:
    """The k best documents of each item so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.rows = k, [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)  # scores below these are not wanted

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, ids: list):
        ok = score >= self.least[item]
        item, score, doc = item[ok], score[ok], doc[ok]
        order = np.lexsort((doc, -score, item))  # documents of a chunk are in order of their ids
        item, score, doc = item[order], score[order], doc[order]
        first = np.searchsorted(item, item)
        few = np.arange(len(item)) - first < self.k
        for q, s, d in zip(item[few].tolist(), score[few].tolist(), doc[few].tolist(), strict=True):
            self.rows[q].append((-s, ids[d] is None, ids[d]))
        for q in np.unique(item).tolist():
            self.rows[q] = sorted(self.rows[q], key=lambda r: r[:2] if r[1] else r)[:self.k]
            if len(self.rows[q]) == self.k:
                self.least[q] = -self.rows[q][-1][0]


def _search_chunk(asked: _Asked, best: _Best, row: dict) -> int:
    """Takes one index row into ``best``; returns how many pairs were scored."""
    raw = zstandard.ZstdDecompressor().decompress
    n, log = unpack_arrays(row["head"], ["<i8", "<i8"])
    m = 100 - 50 + (50 * n * asked.n_docs) // asked.n_terms
    bounds = asked.bounds(m, log, np.frombuffer(raw(row["sketch"]), dtype=np.uint8))
    if not (bounds >= best.least).any():
        return 0
    place_of = {w: k for k, w in enumerate(raw(row["vocabulary"]).split(b" "))}
    place = np.array([place_of.get(t, -1) for t in asked.terms], dtype=np.int64)
    sizes, term, tf = unpack_arrays(row["postings"], ["<i8", "<i4", "<u4"])
    keys = np.repeat(np.arange(len(sizes)), sizes) * len(place_of) + term
    postings = keys, tf.astype(np.int64), len(place_of)
    order = np.argsort(-bounds, axis=0, kind="stable")
    sorted_ = np.take_along_axis(bounds, order, axis=0)
    scored = 0
    for lo in range(0, len(m), best.k):  # descending bounds, until none reaches the threshold
        doc, item = np.nonzero(sorted_[lo:lo + best.k] >= best.least)
        if not len(item):
            break
        doc = order[lo + doc, item]
        best.add(item, asked.scores(postings, place, m, doc, item), doc, row["ids"])
        scored += len(item)
    return scored


def search(docs: DataFrame, items: DataFrame, k: int = 50, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's k best documents."""
    spark = docs.sparkSession
    chunks = index(docs, text)
    total = chunks.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    kinds = dict(items.dtypes)[item_id], dict(docs.dtypes)["doc_id"]
    asked = items.where(F.col(text).isNotNull()).select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    n_blocks = max(1, -(-text_bytes(asked) // BLOCK_BYTES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)))
    schema = f"item_id {kinds[0]}, doc_id {kinds[1]}, score long, slice int"
    path = scratch_path(spark, "search-best")
    spark.createDataFrame([], schema).write.parquet(path)
    for block in range(n_blocks if total.n else 0):
        terms: dict[object, Counter] = {}
        rows = asked.where(F.col("block") == block).select("item_id", "text").toArrow()  # about BLOCK_BYTES of text
        for i, t in zip(rows["item_id"].to_pylist(), rows["text"].to_pylist(), strict=True):
            terms.setdefault(i, Counter()).update(term_counts(t.encode()))
        df = _document_counts(chunks, sorted({t for c in terms.values() for t in c}))
        ready = _Asked(list(terms.items()), df, total.n, total.l)
        if ready.ids:
            chunks.mapInArrow(_searcher(ready, k, rows.schema.field("item_id").type), schema).write.mode("append").parquet(path)
    found = spark.read.parquet(path)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    few = found.withColumn("no", F.row_number().over(Window.partitionBy("item_id", "slice").orderBy(*order))).where(F.col("no") <= k)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return few.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _searcher(asked: _Asked, k: int, item_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, part = _Best(len(asked.ids), k), 0
        for b in batches:
            for j in range(b.num_rows):
                row = {c: b.column(c)[j].as_py() for c in ("head", "sketch", "vocabulary", "postings", "ids")}
                part = part or xxhash.xxh32_intdigest(row["head"]) % SLICES + 1
                _search_chunk(asked, best, row)
            id_type = b.schema.field("ids").type.value_type
        rows = [(asked.ids[q], i, -s) for q, found in enumerate(best.rows) for s, _, i in found]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], item_type), pa.array([r[1] for r in rows], id_type),
                 pa.array([r[2] for r in rows], pa.int64()), pa.array([part] * len(rows), pa.int32())], names=["item_id", "doc_id", "score", "slice"])

    return run
