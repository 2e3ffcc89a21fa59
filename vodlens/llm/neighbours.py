"""Approximate nearest neighbours by inner product on robust-pruned graphs.

Equal vectors are one point (with its smallest ids, as many as an answer can
hold).  Points are dealt to shards by hash.  A shard's directed graph is built over
the directions of its vectors, in batches: a greedy search from the entry proposes
neighbours, and relaxed pruning keeps a candidate only if no kept one is nearer to it
by the factor ``ALPHA``; edges back are pruned alike.  (Over the vectors themselves
long ones, which most answers are, lie far from all others and get hardly any edges.)
A query walks the graph by inner product with the vectors.

A graph is measured once it is built: up to ``PROBES`` of its points are asked, their
answers compared with all inner products, and the beam is doubled until ``RECALL`` of
the best k are found; a shard that would need a beam of over a quarter of its points
is searched whole.  Graph and beam are kept in the shared checkpoint folder; queries
are dealt by hash to blocks of about ``QUERY_ROWS``, and each (shard, block) is one
group, bounded on both sides.  Every query searches each shard; what the beams hold is
scored exactly in double precision and the shards' best are merged.

Every valid vector is indexed.  Defined results: vectors that are null, empty,
zero or hold a null or non-finite component take no part, nor do null ids; only
vectors of one length meet; repeated rows of one id and vector count once; ties
go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SHARD_ROWS, DEGREE, BEAM, ALPHA, BATCH = 8192, 32, 64, 1.2, 512
QUERY_ROWS = 8192  # queries that one task searches one shard for
PROBES, RECALL = 128, 0.95


def _search(x, sq, graph, entry, queries, beam):
    """Ids of the nearest points found per query, nearest first (-1: none)."""
    b = len(queries)
    ids = np.full((b, beam), -1, dtype=np.int64)
    dist = np.full((b, beam), np.inf, dtype=np.float32)
    done = np.ones((b, beam), dtype=bool)
    ids[:, 0], done[:, 0] = entry, False
    dist[:, 0] = sq[entry] - 2 * (queries @ x[entry])
    while True:
        act = np.flatnonzero(~done.all(axis=1))
        if not len(act):
            return ids
        col = np.argmax(~done[act], axis=1)  # beams are sorted: the nearest not yet expanded
        done[act, col] = True
        near = graph[ids[act, col]]
        d = sq[near] - 2 * np.matmul(x[near], queries[act][:, :, None])[:, :, 0]
        d[(near < 0) | (near[:, :, None] == ids[act][:, None, :]).any(axis=2)] = np.inf
        all_d = np.concatenate([dist[act], d], axis=1)
        best = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        all_ids = np.where(np.isinf(d), -1, near)
        ids[act] = np.take_along_axis(np.concatenate([ids[act], all_ids], axis=1), best, axis=1)
        dist[act] = np.take_along_axis(all_d, best, axis=1)
        done[act] = np.take_along_axis(np.concatenate([done[act], np.isinf(d)], axis=1), best, axis=1)


def _pruned(x, nodes, cands, degree):
    """Robust pruning: per node at most ``degree`` of its candidates, diverse."""
    cands = np.where(cands == nodes[:, None], -1, np.sort(cands, axis=1))
    cands[:, 1:][cands[:, 1:] == cands[:, :-1]] = -1
    v = x[cands]
    own = ((v - x[nodes][:, None, :]) ** 2).sum(axis=2)
    own[cands < 0] = np.inf
    sq = (v * v).sum(axis=2)
    between = sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    open_, out, rows = own.copy(), np.full((len(nodes), degree), -1, dtype=np.int64), np.arange(len(nodes))
    for k in range(degree):
        pick = np.argmin(open_, axis=1)
        good = np.isfinite(open_[rows, pick])
        if not good.any():
            break
        out[good, k] = cands[rows, pick][good]
        near = between[rows, pick]
        open_[(ALPHA * ALPHA * near <= own) & good[:, None]] = np.inf
        open_[rows, pick] = np.inf
    return out


def _graph(x, degree=DEGREE, beam=BEAM):
    """(graph, entry) over the rows of x."""
    n, sq = len(x), (x * x).sum(axis=1)
    rng = np.random.default_rng(7)
    entry = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
    graph = np.full((n, degree), -1, dtype=np.int64)
    if n > 1:
        first = rng.integers(0, n, size=(n, min(degree // 2, n - 1)))
        graph[:, :first.shape[1]] = np.where(first == np.arange(n)[:, None], (first + 1) % n, first)
    order = rng.permutation(n)
    for lo in range(0, n, BATCH):
        nodes = order[lo:lo + BATCH]
        found = _search(x, sq, graph, entry, x[nodes], beam)
        graph[nodes] = _pruned(x, nodes, np.concatenate([found, graph[nodes]], axis=1), degree)
        src, dst = np.repeat(nodes, degree), graph[nodes].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        to, at = np.unique(dst, return_index=True)
        back = np.full((len(to), BATCH), -1, dtype=np.int64)
        inside = np.arange(len(dst)) - np.repeat(at, np.diff(np.append(at, len(dst))))
        back[np.searchsorted(to, dst), inside] = src
        back = back[:, :int(inside.max()) + 1] if len(inside) else back[:, :0]
        for i in range(0, len(to), BATCH):
            t = to[i:i + BATCH]
            graph[t] = _pruned(x, t, np.concatenate([graph[t], back[i:i + BATCH]], axis=1), degree)
    return graph, entry


def _scaled(x):
    """Rows scaled to a largest component of 1: the order of inner products with them stays."""
    return x / np.abs(x).max(axis=1, keepdims=True)


def _walked(x):
    """The vectors as a search reads them: single precision, of one common scale."""
    return (x / np.abs(x).max()).astype(np.float32)


def _beam(x, graph, entry, k):
    """The beam that finds ``RECALL`` of the k best of sampled points; 0: none up to a
    quarter of the points does."""
    n, flat, none = len(x), _walked(x), np.zeros(len(x), dtype=np.float32)
    asked = _scaled(x[np.random.default_rng(11).permutation(n)[:PROBES]]).astype(np.float32)
    k = min(k, n)
    products = asked @ flat.T
    worst = np.partition(products, n - k, axis=1)[:, n - k]
    beam = max(BEAM, 2 * k)
    while beam <= n // 4:
        found = _search(flat, none, graph, entry, asked, beam)
        got = np.where(found >= 0, np.take_along_axis(products, np.maximum(found, 0), axis=1), -np.inf)
        if np.minimum((got >= worst[:, None]).sum(axis=1), k).sum() >= RECALL * k * len(asked):
            return beam
        beam *= 2
    return 0


def _stored(members, x, k):
    """The graph of one shard as one row of bytes."""
    unit = _scaled(x)
    unit = (unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))).astype(np.float32)
    graph, entry = _graph(unit)
    ends = np.cumsum([len(m) for m in members])
    ids = np.concatenate([np.array(m, dtype="<i8") for m in members])
    return {"x": x.astype("<f8").tobytes(), "graph": graph.astype("<i4").tobytes(), "entry": entry, "beam": _beam(x, graph, entry, k),
            "ends": ends.astype("<i8").tobytes(), "ids": ids.tobytes()}


def _answers(stored, query_ids, queries, k):
    """(query, id, score) of the k best of a stored shard per query."""
    ends, ids = (np.frombuffer(stored[c], dtype="<i8") for c in ("ends", "ids"))
    x = np.frombuffer(stored["x"], dtype="<f8").reshape(len(ends), -1)
    graph = np.frombuffer(stored["graph"], dtype="<i4").reshape(len(ends), -1).astype(np.int64)
    members = [m.tolist() for m in np.split(ids, ends[:-1])]
    flat, none, held = _walked(x), np.zeros(len(x), dtype=np.float32), min(len(x), max(BEAM, 2 * k))
    out = []
    for lo in range(0, len(queries), BATCH):
        q = queries[lo:lo + BATCH]
        asked = _scaled(q).astype(np.float32)
        if stored["beam"]:
            found = _search(flat, none, graph, stored["entry"], asked, stored["beam"])
        else:
            found = np.argpartition(-(asked @ flat.T), held - 1, axis=1)[:, :held]
        for i, row in enumerate(found):
            row = row[row >= 0]
            score = np.array([float(np.dot(x[r], q[i])) for r in row])
            own = query_ids[lo + i]
            best = sorted((-s, m) for r, s in zip(row, score, strict=True) for m in members[r] if m != own)[:k]
            out += [(own, m, -s) for s, m in best]
    return out


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query row."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), is_query.alias("is_query"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = v.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)).dropDuplicates(["id", "v"])
    v = cut(v.withColumns({"dim": F.size("v"), "h": F.xxhash64("v")}))
    shards = max(1, -(-v.count() // SHARD_ROWS))
    first = F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))  # an answer holds at most k + 1 of equal vectors
    points = (
        v.withColumn("no", first).where(F.col("no") <= k + 1).groupBy("h", "v", "dim").agg(F.sort_array(F.collect_list("id")).alias("members"))
        .select("dim", F.pmod("h", F.lit(shards)).cast("int").alias("shard"), "v", "members")
    )
    asked = v.where("is_query")
    blocks = max(1, -(-asked.count() // query_rows))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = asked.select(
        F.col("dim").alias("q_dim"), upto(shards).alias("q_shard"), F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("q_block"),
        F.col("id").alias("q_id"), F.col("v").alias("q_v"))

    def matrix(column):
        rows = column.combine_chunks()
        return rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)

    def build(key, table):
        row = _stored(table.column("members").to_pylist(), matrix(table.column("v")), k)
        return pa.Table.from_pylist([{"dim": key[0].as_py(), "shard": key[1].as_py()} | row], schema=pa.schema(
            [("dim", pa.int32()), ("shard", pa.int32()), ("x", pa.binary()), ("graph", pa.binary()), ("entry", pa.int64()), ("beam", pa.int64()),
             ("ends", pa.binary()), ("ids", pa.binary())]))

    graphs = cut(points.groupBy("dim", "shard").applyInArrow(
        build, "dim int, shard int, x binary, graph binary, entry long, beam long, ends binary, ids binary"))

    def run(left, right):
        rows = []
        if left.num_rows and right.num_rows:
            rows = _answers(left.to_pylist()[0], right.column("q_id").to_pylist(), matrix(right.column("q_v")), k)
        return pa.table({
            "query_id": pa.array([r[0] for r in rows], pa.int64()), "vec_id": pa.array([r[1] for r in rows], pa.int64()),
            "score": pa.array([r[2] for r in rows], pa.float64())})

    found = graphs.withColumn("block", upto(blocks)).groupBy("dim", "shard", "block").cogroup(
        queries.groupBy("q_dim", "q_shard", "q_block")).applyInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
