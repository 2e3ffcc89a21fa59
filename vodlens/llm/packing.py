"""Mixture-controlled packing by deficit round-robin.

Documents are tokenised once (ids kept in the shared checkpoint folder), dealt to
parts of about ``PART_TOKENS`` tokens by a hash, and packed part by part.  In a
part each source has a queue.  Before each window a source's deficit grows by its
target share of the window; the ring of sources is walked, and a source with a
deficit of at least ``QUANTUM`` gives tokens until deficit, queue or window ends.
What a window could not balance stays in the deficits for the next window; what
the parts before left unbalanced, computed by prefix sums over parts, enters a part
whole: up to ``OPENING`` windows a source as its first deficits, the rest in equal
steps of at least a quantum over the part's windows.  A part's last tokens fill windows of powers of two, so
nothing is padded.

Defined results: a null or empty text is its closing id alone; null sources form
one queue; repeated rows are packed each for itself; null ids pass through; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, parts_for

SEQUENCE, QUANTUM, PART_TOKENS, END_ID = 2048, 512, 3_000_000, 1
OPENING = 4


class _Encoder:
    """Ids of a text.  The ranks file holds the same vocabulary as the json file
    and encodes several times faster; texts that spell out a special token, which
    only the json file knows, take the json file."""

    def __init__(self, json_path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken

        self.json_path, self.whole = json_path, None
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        assert max(ranks.values()) < 1 << 16, "ids are kept in two bytes"

    def __call__(self, text: str | None) -> np.ndarray:
        text = text or ""
        if "<|" not in text:
            return self.fast.encode_to_numpy(text)
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.json_path)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def tokenised(docs: DataFrame, path: str, ranks_path: str) -> DataFrame:
    """(doc_id, source, n, ids): ids little-endian uint16 with the closing id."""
    end = np.array([END_ID], dtype="<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _Encoder(path, ranks_path)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                c = b.slice(i, 256)
                ids = [encode(t.as_py()).astype("<u2").tobytes() + end for t in c.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [c.column(0), c.column(1), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "source", "n", "ids"],
                )

    kinds = dict(docs.dtypes)
    own = docs.select("doc_id", F.col("source").cast("string"), "text")
    return own.mapInArrow(run, f"doc_id {kinds['doc_id']}, source string, n long, ids binary")


def _fill(queues: dict, shares: dict, deficit: dict, window: int, quantum: int, later: dict):
    """Yields (sequence, offset, row, start, length) until all queues are empty.

    queues: source to deque of [row, tokens]; consumed.  later: deficits that
    enter in steps, all of them by the last whole window; consumed."""
    left = sum(n for q in queues.values() for _, n in q)
    step = {s: max(quantum, abs(d) / max(1, left // window)) for s, d in later.items()}
    ring = deque(s for s, q in queues.items() if q)
    begun: dict = {}
    sequence = 0
    while left:
        size = window if left >= window else 1 << (left.bit_length() - 1)
        whole = sum(shares[s] for s in ring) or 1.0
        for s in ring:
            more = max(-step[s], min(step[s], later[s]))
            later[s] -= more
            deficit[s] += size * shares[s] / whole + more
        at = idle = 0
        while at < size:
            s = ring[0]
            due = int(deficit[s])
            if due < min(quantum, size) and idle < len(ring):  # not yet worth a piece
                ring.rotate(-1)
                idle += 1
                continue
            if idle >= len(ring):  # nobody is owed a quantum: the most owed one gives
                s = max(ring, key=deficit.__getitem__)
                due = min(quantum, size)
            give = min(due, size - at)
            q = queues[s]
            while give and q:
                row, n = q[0]
                start = begun.get(row, 0)
                k = min(give, n - start)
                yield sequence, at, row, start, k
                at, give, left = at + k, give - k, left - k
                deficit[s] -= k
                if start + k == n:
                    q.popleft()
                    begun.pop(row, None)
                else:
                    begun[row] = start + k
            if not q:
                ring.remove(s)
            elif ring[0] == s:
                ring.rotate(-1)
            idle = 0
        sequence += 1


def pack(docs: DataFrame, path: str, ranks_path: str, shares: DataFrame | None = None, window: int = SEQUENCE,
         quantum: int = QUANTUM, part_tokens: int = PART_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, source, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and ids).  ``shares`` (source, share) are the target token
    proportions; by default those of the corpus, which all queues can meet."""
    kind = dict(docs.dtypes)["doc_id"]
    tokens = cut(tokenised(docs, path, ranks_path))
    n_parts = parts_for(tokens.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], part_tokens)
    part = F.pmod(F.xxhash64("doc_id", "source", "n", F.crc32("ids")), F.lit(n_parts)).cast("int")
    dealt = tokens.withColumn("part", part)

    sums = cut(dealt.groupBy("part", "source").agg(F.sum("n").alias("n")))
    total = sums.groupBy("source").agg(F.sum("n").alias("all"))
    if shares is None:
        shares = total.select("source", F.col("all").cast("double").alias("share"))
    every = Window.partitionBy(F.lit(0))  # one row per source
    share = shares.withColumn("share", F.col("share") / F.sum("share").over(every)).select(F.col("source").alias("_s"), "share")
    per_part = sums.groupBy("part").agg(F.sum("n").alias("of_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    per_part = per_part.withColumn("part_before", F.coalesce(F.sum("of_part").over(before), F.lit(0))).drop("of_part")
    own = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    given = sums.withColumn("own_before", F.coalesce(F.sum("n").over(own), F.lit(0)))
    debts = (
        given.join(per_part, "part").join(share, F.col("source").eqNullSafe(F.col("_s")), "left")
        .select(F.col("part").alias("of_part"), F.col("source").alias("of_source"), F.coalesce("share", F.lit(0.0)).alias("share"),
                (F.coalesce("share", F.lit(0.0)) * F.col("part_before") - F.col("own_before")).alias("deficit"))
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        part_no = left.column("part")[0].as_py() if left.num_rows else 0
        sources, counts = left.column("source").to_pylist(), left.column("n").to_pylist()
        blobs = [memoryview(x.as_buffer()) for x in left.column("ids").combine_chunks()] if left.num_rows else []
        ids = left.column("doc_id").combine_chunks()
        order = sorted(range(left.num_rows), key=lambda i: (zlib.crc32(blobs[i]), counts[i], str(ids[i])))
        queues: dict = {}
        for i in order:
            queues.setdefault(sources[i], deque()).append((i, counts[i]))
        known = {r["of_source"]: r for r in right.to_pylist()}
        share_of = {s: known[s]["share"] for s in queues}
        owed = {s: max(-OPENING * window, min(OPENING * window, known[s]["deficit"])) for s in queues}
        later = {s: known[s]["deficit"] - owed[s] for s in queues}
        p = list(_fill(queues, share_of, owed, window, quantum, later))
        rows = [x[2] for x in p]
        pieces = [np.frombuffer(blobs[r][2 * a:2 * (a + k)], dtype="<u2").astype("<u4").tobytes() for _, _, r, a, k in p]
        return pa.table([
            ids.take(pa.array(rows, pa.int64())), pa.array([sources[r] for r in rows], pa.string()),
            pa.array([x[3] for x in p], pa.int64()), pa.array([x[4] for x in p], pa.int64()),
            pa.array([zlib.crc32(x) for x in pieces], pa.int64()), pa.array([counts[r] for r in rows], pa.int64()),
            pa.array([(part_no << 32) + x[0] for x in p], pa.int64()), pa.array([x[1] for x in p], pa.int64()),
            pa.array(pieces if with_ids else [None] * len(p), pa.binary()),
        ], names=names)

    schema = (f"doc_id {kind}, source string, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long, ids binary")
    packed = dealt.groupBy("part").cogroup(debts.groupBy("of_part")).applyInArrow(run, schema)
    return packed if with_ids else packed.drop("ids")
