"""Similarity join of documents by their word shingles (Jaccard of 80 % or more).

Equal shingle sets form a class and are joined once.  Candidates come from prefix
lists: with every set in one common order, two sets that are similar enough share
a shingle among the first fifth of each.  The order puts heavy shingles (counted
over all documents) last, so lists stay short, whatever is common.

In a list, sorted by set size, each class is first paired with the smallest one
of its tile (sizes within 80 %).  Pairs pass a bound from hashed bitmap signatures
- a bit set on one side only hides at least one shingle that the other lacks - and
then the exact intersection of sorted arrays.  After components are built from
these links, and from those of neighbours in the lists that still hold several
components, what is left of such lists (one list of each set of members) is compared
tile by tile with the same bound.  Sets that the bound ties together form a group;
inside a group all pairs of different components and similar size are compared
exactly, until they are in one component.  So tiles and groups put out rows, not
pairs, and no link that joins two components is lost.

Defined results: a text with fewer than five words is one shingle; null, empty
and blank texts have no shingle and are linked with nothing; repeated rows fall
into one class; null or repeated ids are ordered as ``with_position`` says (the
component of rows without id may be null); an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, parts_for, shield, small, text_bytes, unshield
from .segments import chunks, mix, pack_arrays, unpack_arrays, with_position
from .substring import _words, sliding, word_hashes

SHINGLE, PERCENT = 5, 80
LEAST_BITS = 256
HEAVY_IN_CHUNK, HEAVY_TOTAL, HEAVY_KEPT = 4, 64, 50_000
BUCKET_BYTES = 64 << 20
BROADCAST_IDS = 1_000_000
TILE = 256
HOME_ROWS = 1024
BLOCK_SHINGLES = 4 << 20


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    lines = [b" ".join(t.lower().split()) for t in texts]
    buf, start, end = _words(b"\n".join(lines) + b"\n")
    n = np.array([x.count(b" ") + 1 if x else 0 for x in lines], dtype=np.int64)
    stop = np.cumsum(n)
    doc = np.repeat(np.arange(len(lines)), n)
    h = word_hashes(buf, start, end, 0x100000001B3)
    s = sliding(h, SHINGLE, 0x9FB21C651E98DF25)
    at = np.flatnonzero(np.arange(len(s)) + SHINGLE <= stop[doc[:len(s)]])
    value, owner = s[at], doc[at]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.append(True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])) if len(value) else np.zeros(0, bool)
    value, owner = value[new], owner[new]
    sets = np.split(value, np.cumsum(np.bincount(owner, minlength=len(lines)))[:-1]) if len(lines) else []
    for i in np.flatnonzero((n > 0) & (n < SHINGLE)):
        w = h[stop[i] - n[i]:stop[i]]
        sets[i] = mix(sliding(w, len(w), 0x9FB21C651E98DF25) + np.uint64(len(w)))
    return sets


def _bitmap(s: np.ndarray) -> bytes:
    """Hashed bits of a set: two to four a shingle, a power of two of them, so
    that sets of one size band have one width and others fold to the smaller."""
    width = max(LEAST_BITS, 1 << (2 * len(s) - 1).bit_length())
    bits = np.zeros(width, dtype=bool)
    bits[mix(s + np.uint64(7)) & np.uint64(width - 1)] = True
    return np.packbits(bits).tobytes()


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64-bit words folded to ``width`` words."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def _class_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _described(docs: DataFrame) -> DataFrame:
    """(_pos, doc_id, n, class, bitmap, heavy): ``heavy`` holds, on a chunk's first row,
    the shingles of several documents of the chunk with their counts."""
    kind = dict(docs.dtypes)["doc_id"]
    heavy = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []

        def seen(bs):
            for b in bs:
                ids.extend(b.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2)], names=["p", "t"])

        done = 0
        for pos, texts in chunks(seen(batches)):
            sets = shingle_sets(texts)
            classes = [_class_of(s) if len(s) else None for s in sets]
            one = {c: s for c, s in zip(classes, sets, strict=True) if c is not None}
            value, count = np.unique(np.concatenate([*one.values()]), return_counts=True) if one else (np.zeros(0, np.uint64),) * 2
            often = count >= HEAVY_IN_CHUNK
            found = [{"h": int(v), "n": int(c)} for v, c in zip(value[often].view(np.int64), count[often], strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(pos, pa.int64()), pa.array(ids[done:done + len(pos)], pa_kind), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(classes, pa.int64()), pa.array([_bitmap(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([found] + [None] * (len(pos) - 1), heavy)], names=["_pos", "doc_id", "n", "class", "bitmap", "heavy"])
            done += len(pos)

    pa_kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(kind, pa.int64())
    return docs.select("_pos", "doc_id", "_bytes").mapInArrow(
        run, f"_pos long, doc_id {kind}, n long, class long, bitmap binary, heavy array<struct<h:long,n:long>>")


def _prefix(s: np.ndarray, heavy: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles in the common order, as many as similar sets cannot all miss."""
    need = len(s) - -(-PERCENT * len(s) // 100) + 1
    if not len(heavy):
        return s[:need]
    at = np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)
    common = heavy[at] == s
    light = s[~common]
    if len(light) >= need:
        return light[:need]
    late = s[common][np.argsort(rank[at[common]], kind="stable")]
    return np.concatenate([light, late[:need - len(light)]])


def prefix_lists(docs: DataFrame, heavy: list[tuple[int, int]], buckets: int) -> DataFrame:
    """(token, class, n): shingles that open the sets of two classes or more."""
    by_hash = sorted(heavy, key=lambda x: x[0] % (1 << 64))
    hashes = np.array([h for h, _ in by_hash], dtype=np.int64).view(np.uint64)
    order = np.lexsort((hashes, np.array([n for _, n in by_hash], dtype=np.int64)))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches):
            one = {_class_of(s): s for s in shingle_sets(texts) if len(s)}
            if not one:
                continue
            heads = [_prefix(s, hashes, rank) for s in one.values()]
            token = np.concatenate(heads)
            owner = np.repeat(np.array(list(one), dtype=np.int64), [len(x) for x in heads])
            n = np.repeat(np.array([len(s) for s in one.values()], dtype="<u4"), [len(x) for x in heads])
            bucket = (mix(token) % np.uint64(buckets)).astype(np.int64)
            by = np.lexsort((token, bucket))
            token, owner, n, bucket = token[by], owner[by], n[by], bucket[by]
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            blobs = [pack_arrays(token[x:y], owner[x:y], n[x:y]) for x, y in zip(cuts, np.append(cuts[1:], len(bucket)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts], pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    def receive(key, table):
        parts = [unpack_arrays(b.as_py(), ["<u8", "<i8", "<u4"]) for b in table.column("blob")]
        token, owner, n = (np.concatenate([p[i] for p in parts]) for i in range(3))
        _, back, count = np.unique(token, return_inverse=True, return_counts=True)
        shared = count[back] > 1
        token, owner, n = token[shared], owner[shared], n[shared]
        order = np.lexsort((owner, n, token))
        token, owner, n = token[order], owner[order], n[order]
        new = np.append(True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])) if len(token) else np.zeros(0, bool)
        token, owner, n = token[new], owner[new], n[new]
        _, back, count = np.unique(token, return_inverse=True, return_counts=True)
        lists = count[back] > 1
        return pa.table({"token": pa.array(token[lists].view(np.int64)), "class": pa.array(owner[lists]), "n": pa.array(n[lists].astype(np.int64))})

    sent = docs.select("_pos", "_bytes").mapInArrow(send, "bucket int, blob binary")
    return sent.groupBy("bucket").applyInArrow(receive, "token long, class long, n long")


def _star_pairs(lists: DataFrame) -> DataFrame:
    """(a, b): every class of a list with the smallest class of its tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, hub, size = None, 0, 0  # a list may go on in the next batch
        for b in batches:
            pairs = set()
            for token, owner, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if token != of or size * 100 < PERCENT * n:
                    of, hub, size = token, owner, n
                else:
                    pairs.add((min(hub, owner), max(hub, owner)))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return lists.select("token", "class", "n").mapInArrow(run, "a long, b long").distinct()


def _open(lists: DataFrame, comp: DataFrame) -> DataFrame:
    """The lists, with components, that still hold several of them: of lists with
    the same members (two hashes of them) one.  A list of two has been compared
    whole.  ``home`` is the least class, or the token of a list of many rows."""
    named = cut(lists.join(comp, "class", "left").withColumn("comp", F.coalesce("comp", "class")))
    members = [F.bit_xor(F.xxhash64("class", F.lit(i))).alias(f"x{i}") for i in (1, 2)]
    mixed = named.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"), F.min("class").alias("least"), *members)
    one = mixed.where("lo <> hi and m > 2").groupBy("m", "least", "x1", "x2").agg(F.min("token").alias("token"))
    home = F.when(F.col("m") > HOME_ROWS, F.col("token")).otherwise(F.col("least")).alias("home")
    return named.join(one.select("token", home), "token")


def _chain_pairs(rows: DataFrame, order) -> DataFrame:
    """(a, b): neighbours in a list, in an order common to all lists, that are of
    different components and similar size."""
    w = Window.partitionBy("token").orderBy(order)
    d = rows.withColumns({"b": F.lag("class").over(w), "b_comp": F.lag("comp").over(w), "b_n": F.lag("n").over(w)})
    d = d.where((F.col("comp") != F.col("b_comp")) & (F.least("n", "b_n") * 100 >= F.greatest("n", "b_n") * PERCENT))
    return d.select(F.least("class", "b").alias("a"), F.greatest("class", "b").alias("b")).distinct()


def _arrays(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, items): the sorted shingles of the wanted documents (_pos)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches):
            sets = shingle_sets(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["class", "items"])

    chosen = docs.select("_pos", "_bytes").join(small(wanted, BROADCAST_IDS), "_pos", "left_semi")
    return chosen.mapInArrow(run, "class long, items binary")


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: bound by size and bitmaps, then exactly.  Sets
    are built again for the classes that pass the bound, and for no others."""
    side = lambda s: classes.select(F.col("class").alias(s), F.col("n").alias(f"n_{s}"), F.col("bitmap").alias(f"bitmap_{s}"))
    bits = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b")
    bits = bits.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT)

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ok = []
            for na, nb, x, y in zip(*(t.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True):
                width = min(len(x), len(y)) // 8
                x, y = (_folded(np.frombuffer(v, dtype="<u8"), width) for v in (x, y))
                ok.append(bool(_may_link(x, y, na, nb)))
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    near = cut(bits.mapInArrow(bound, "a long, b long"))
    ids = near.select(F.col("a").alias("class")).unionByName(near.select(F.col("b").alias("class"))).distinct()
    wanted = cut(ids.join(classes, "class").select(F.col("first._pos").alias("_pos")))
    arrays = cut(_arrays(docs, wanted))
    items = lambda s: arrays.select(F.col("class").alias(s), F.col("items").alias(f"items_{s}"))
    full = near.join(items("a"), "a").join(items("b"), "b").select("a", "b", "items_a", "items_b")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), dtype="<u8"), np.frombuffer(y.as_py(), dtype="<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return full.mapInArrow(exact, "a long, b long")


def _may_link(x: np.ndarray, y: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether bit counts allow 100 * intersection >= PERCENT * union."""
    only_x, only_y = (np.bitwise_count(v).sum(axis=-1, dtype=np.int64) for v in (x & ~y, y & ~x))
    both = np.minimum(na - only_x, nb - only_y)
    return 100 * both >= PERCENT * (na + nb - both)


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of a and b (``root``: the least member of each one's group)."""
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while len(a) and (root[root] != root).any():
            root[:] = root[root]


def _groups(rows: DataFrame, parts: int) -> DataFrame:
    """(group, class): classes that size and bitmap tie together, over pairs of one
    list and different components.  Blocks of a list meet as tiles, each in one
    vector operation; pairs already in one group are not looked at again."""

    def run(key, table):
        comp, n, cls, token = (table.column(c).to_numpy() for c in ("comp", "n", "class", "token"))
        raw = table.column("bitmap").to_pylist()
        order = np.lexsort((cls, n, token))
        comp, n, cls, token, raw = comp[order], n[order], cls[order], token[order], [raw[i] for i in order]
        name, own = np.unique(cls, return_inverse=True)
        root = np.arange(len(name))
        wide = np.array([len(x) // 8 for x in raw], dtype=np.int64)
        # Blocks: of one list and one width, at most TILE sets.
        edge = np.append(True, (token[1:] != token[:-1]) | (wide[1:] != wide[:-1]))
        run_at = np.flatnonzero(edge)
        inside = np.arange(len(edge)) - np.repeat(run_at, np.diff(np.append(run_at, len(edge))))
        lo = np.flatnonzero(edge | (inside % TILE == 0))
        hi = np.append(lo[1:], len(token))
        bits = [np.frombuffer(b"".join(raw[x:y]), dtype="<u8").reshape(y - x, -1) for x, y in zip(lo, hi, strict=True)]
        for i in range(len(lo)):
            for j in range(i, len(lo)):
                if token[lo[j]] != token[lo[i]] or n[hi[i] - 1] * 100 < PERCENT * n[lo[j]]:
                    break  # another list, or all further sets are too large for this block
                x, y = slice(lo[i], hi[i]), slice(lo[j], hi[j])
                apart = (comp[x, None] != comp[None, y]) & (root[own[x]][:, None] != root[own[y]][None, :])
                p, q = np.nonzero(np.triu(apart, 1) if i == j else apart)
                if not len(p):
                    continue
                width = min(bits[i].shape[1], bits[j].shape[1])
                a, b = p + lo[i], q + lo[j]
                ok = _may_link(_folded(bits[i], width)[p], _folded(bits[j], width)[q], n[a], n[b])
                _merge(root, own[a[ok]], own[b[ok]])
        tied = np.bincount(root, minlength=len(root))[root] > 1
        return pa.table({"group": pa.array(name[root[tied]], pa.int64()), "class": pa.array(name[tied], pa.int64())})

    dealt = rows.withColumn("part", F.pmod(F.xxhash64("home"), F.lit(parts)))
    return dealt.groupBy("part").applyInArrow(run, "group long, class long").distinct()


def _compared(block: np.ndarray, comp: np.ndarray, sets: list[np.ndarray], one: bool) -> list[tuple[int, int]]:
    """Links that join components, of sets ordered by size: in one block all pairs,
    else those of different blocks."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    root = np.unique(comp, return_inverse=True)[1]
    bits = [np.frombuffer(_bitmap(s), dtype="<u8") for s in sets]
    wide = np.array([len(b) for b in bits])
    links = []
    for width in np.unique(wide):
        # Sets of one width, then those of the next, folded: no others are of similar size.
        first, last, stop = np.searchsorted(wide, [width, width + 1, 2 * width + 1])
        rows = np.stack([_folded(b, width) for b in bits[first:stop]])
        for p in range(first, last):
            end = min(stop, np.searchsorted(n, n[p] * 100 // PERCENT, side="right"))
            q = np.arange(p + 1, end)
            q = q[(root[q] != root[p]) & (one | (block[q] != block[p]))]
            if not len(q):
                continue
            for i in q[_may_link(rows[p - first], rows[q - first], n[p], n[q])]:
                if root[i] == root[p]:
                    continue
                both = len(np.intersect1d(sets[p], sets[i], assume_unique=True))
                if 100 * both >= PERCENT * (n[p] + n[i] - both):
                    links.append((p, i))
                    root[root == root[i]] = root[p]
    return links


def _group_links(groups: DataFrame, classes: DataFrame, comp: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b): links inside the groups, found exactly, as many as join all that
    links.  A group of many shingles is cut into blocks, and each pair of blocks is
    compared in its own place, so no task holds a whole group that is large."""
    known = groups.join(classes.select("class", "n", F.col("first._pos").alias("_pos")), "class").join(comp, "class", "left")
    before = F.sum("n").over(Window.partitionBy("group").orderBy("n", "class").rowsBetween(Window.unboundedPreceding, -1))
    block = F.floor(F.coalesce(before, F.lit(0)) / BLOCK_SHINGLES).cast("int")
    rows = cut(known.select("group", "class", "n", "_pos", F.coalesce("comp", "class").alias("comp"), block.alias("block")))
    arrays = cut(_arrays(docs, cut(rows.select("_pos").distinct())))
    ends = rows.groupBy("group").agg(F.max("block").alias("last"))
    dealt = rows.join(ends, "group").withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
    dealt = cut(dealt.select("group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "class", "comp", "block", "n"))
    parts = parts_for(8 * (dealt.agg(F.sum("n")).first()[0] or 0), BUCKET_BYTES // 4)

    def run(key, table):
        group, i, j, cls, comp, block, n = (table.column(c).to_numpy() for c in ("group", "i", "j", "class", "comp", "block", "n"))
        items = table.column("items")
        order = np.lexsort((cls, n, j, i, group))
        place = np.stack([group, i, j])[:, order]
        cuts = np.flatnonzero(np.append(True, (place[:, 1:] != place[:, :-1]).any(axis=0)))
        found = []
        for x, y in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
            at = order[x:y]
            sets = [np.frombuffer(items[int(k)].as_buffer(), dtype="<u8") for k in at]
            found += [sorted((cls[at[p]], cls[at[q]])) for p, q in _compared(block[at], comp[at], sets, i[at[0]] == j[at[0]])]
        return pa.table({c: pa.array([f[k] for f in found], pa.int64()) for k, c in enumerate("ab")})

    full = dealt.join(arrays, "class").withColumn("part", F.pmod(F.xxhash64("group", "i", "j"), F.lit(parts)))
    return full.groupBy("part").applyInArrow(run, "a long, b long")


def components(links: DataFrame, steps: int | None = None) -> DataFrame:
    """(class, comp): least class reachable, by label passing and pointer jumping;
    after ``steps`` steps, if given: parts of components, never more."""
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(both.groupBy(F.col("a").alias("class")).agg(F.least(F.min("b"), F.first("a")).alias("comp")))
    step_no = 0
    while step_no != steps:
        step_no += 1
        seen = both.join(label.withColumnRenamed("class", "a"), "a").groupBy(F.col("b").alias("class")).agg(F.min("comp").alias("near"))
        step = label.join(seen, "class").select("class", "comp", F.least("comp", "near").alias("new"))
        jump = label.select(F.col("class").alias("new"), F.col("comp").alias("far"))
        step = cut(step.join(jump, "new", "left").select("class", "comp", F.least("new", F.coalesce("far", "new")).alias("new")))
        label = step.select("class", F.col("new").alias("comp"))
        if steps is None and not step.where("comp <> new").limit(1).count():
            break
    return label


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, class_id (least id with the
    same shingles, null without any), is_first (the row that stands for its component)."""
    placed = with_position(docs, text)
    size = text_bytes(docs, text)
    rows = cut(_described(placed))
    heavy = (
        rows.select(F.explode("heavy").alias("x")).groupBy("x.h").agg(F.sum("x.n").alias("n")).where(F.col("n") >= HEAVY_TOTAL)
        .orderBy(F.desc("n"), "h").limit(HEAVY_KEPT).collect()
    )
    buckets = parts_for(size, BUCKET_BYTES // 8)
    lists = cut(prefix_lists(placed, [(r["h"], r["n"]) for r in heavy], buckets))
    per_class = rows.where("class is not null").groupBy("class")
    classes = cut(per_class.agg(F.min(F.struct("_pos", "doc_id")).alias("first"), F.any_value("n").alias("n"), F.any_value("bitmap").alias("bitmap")))

    # Until the end, parts of components will do: pairs of different parts are compared.
    links = cut(_links(_star_pairs(lists), classes, placed))
    chain = cut(_links(_chain_pairs(_open(lists, components(links, 1)), F.xxhash64("class")), classes, placed))
    links = cut(links.unionByName(chain))
    parts = components(links, 2)
    groups = cut(_groups(_open(lists, parts).join(classes.select("class", "bitmap"), "class"), buckets))
    comp = components(links.unionByName(_group_links(groups, classes, parts, placed)))

    comp = classes.select("class", "first").join(comp, "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    least = comp.groupBy("comp").agg(F.min("first").alias("least"))
    named = cut(comp.join(least, "comp").select(F.col("class").alias("_class"), "first", "least"))
    out = rows.join(named, F.col("class") == F.col("_class"), "left")
    alone = F.col("class").isNull()
    return out.select(
        "_pos", "doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        (alone | (F.col("least._pos") == F.col("_pos"))).alias("is_first"),
    )


def one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the near copies: of each component the row with the least
    id stays (of rows with one id, the least text), all columns unchanged."""
    clash = docs.groupBy("doc_id").count().where("`count` > 1 or doc_id is null").limit(1).count()
    inner = shield(docs)
    if clash:
        inner = cut(inner.orderBy(F.col("_in_doc_id").asc_nulls_last(), f"_in_{text}").withColumn("_row", F.monotonically_increasing_id()))
    else:
        inner = inner.withColumn("_row", F.col("_in_doc_id").cast("long"))
    near = near_duplicates(inner.select(F.col("_row").alias("doc_id"), F.col(f"_in_{text}").alias("text")))
    keep = near.where("is_first").select(F.col("doc_id").alias("_row"))
    return unshield(inner.join(keep, "_row", "left_semi"), docs.columns)
