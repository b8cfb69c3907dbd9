"""N-gram Jaccard join over count-vector R-trees.

A text's set of word shingles is hashed into groups (a power of two, about an eighth of the
set); the counts per group are a point, and two sets share at most the sum of the smaller coordinates of their points. An
R-tree over points bounds whole boxes of sets the same way (sum of the smaller upper corners),
so the join descends only into box pairs that could still reach the threshold; the pairs of
points that survive are verified on the texts.

At this dimension the upper levels of one R-tree over all texts would overlap everywhere and
prune by size alone, which leaves a quadratic join. So the trees are kept small and exact:
two sets at the threshold t share one of the first (1 - t)|s| + 1 shingles of either in any
fixed order, hence every such shingle has its own tree, over the texts that list it. The
order puts shingles that very many texts hold last (heavy hitters over all texts) and goes
by hash otherwise, so the trees of common passages stay nearly empty.

Plan: (1) one pass over the texts gives set size, a 64-bit set identity, the point, and the
heavy hitters; equal sets become one node. (2) A second pass lists (shingle, node). (3) Every
node of a tree is tried against the tree's first node; survivors of the bound are verified
and joined to components. (4) Trees with nodes of different components are searched, split
into blocks so that no task holds a whole large tree: every node proposes its likeliest
untested partners of other components, these are verified, components grow, and so on until
no tree has an untested pair of different components that the bound allows. Links between
nodes of one component are not enumerated: the components are the same without them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketweave.llm import words as wd
from marketweave.llm.common import Shelf, checkpointed, lean, rows_of, small_batches
from marketweave.llm.components import connected_components

LEAST_GROUPS, MOST_GROUPS = 16, 4096
LEAF = 16
# Groups that the boxes of a tree are built on; the pairs of points use all they have.
BOX_GROUPS = 128
# Groups that a point takes along into the trees; pairs found there meet their whole points.
TREE_GROUPS = 512
# Trees up to this size have one node: all pairs are bounded at once.
ONE_NODE = 48
# Untested partners that a node proposes at a time, the likeliest first.
BEST = 8
# Shingles that the order puts last, at most (they are broadcast).
HEAVY = 250_000
# Rows of a tree that one task takes; larger trees are joined block by block.
BLOCK = 1024


@dataclass(frozen=True)
class Similarity:
    """``n``-word shingles, linked at ``num / den`` or more."""

    n: int = 5
    num: int = 80
    den: int = 100

    def linked(self, inter, total):
        """Whether ``inter`` shared of ``total`` = |a| + |b| reach the threshold."""
        return self.den * inter >= self.num * (total - inter)

    def prefix(self, size: int) -> int:
        """Shingles to list so that linked sets share one: |s| - ceil(t |s|) + 1."""
        return size - -(-self.num * size // self.den) + 1


def sets(raw: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle sets of every row, lower-cased A-Z (see ``words.shingle_sets``)."""
    h, _, _, first = wd.words(raw, offsets, lower=True)
    return wd.shingle_sets(h, first, n)


def _row_sums(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sums of ``values`` per row (0 for a row without any)."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    with np.errstate(over="ignore"):
        return total[start[1:]] - total[start[:-1]]


def identities(s: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, signed as Spark stores it (equal sets, equal names)."""
    with np.errstate(over="ignore"):
        return wd.mix(_row_sums(wd.mix(s), start) + np.diff(start).astype(np.uint64) * wd._BASE
                      ).astype(np.int64)


def group_count(size) -> np.ndarray:
    """Groups of a set's point: the power of two from the size of the set on, between
    ``LEAST_GROUPS`` and ``MOST_GROUPS``, and more where a count could pass 255."""
    size = np.asarray(size, dtype=np.int64)
    g = np.clip(size, LEAST_GROUPS, np.maximum(MOST_GROUPS, size // 64))
    return (2 ** np.ceil(np.log2(g))).astype(np.int64)


def points(s: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(counts, offsets)``: the counts per group of every set, row by row, as bytes. The group
    is the low bits of a shingle's upper half, so halving the groups folds a point onto
    itself."""
    g = group_count(np.diff(start))
    off = np.concatenate([[0], np.cumsum(g)])
    row = np.repeat(np.arange(len(g)), np.diff(start))
    at = off[row] + ((s >> np.uint64(32)).astype(np.int64) & (g[row] - 1))
    counts = np.bincount(at, minlength=int(off[-1]))
    if counts.max(initial=0) > 255:  # the mean is 64 at most
        raise ValueError("shingle hashes are not spread over the groups")
    return counts.astype(np.uint8), off


def folded(point: np.ndarray, most: int) -> bytes | None:
    """A point folded to ``most`` groups, or to as few as its counts allow; None when it has no
    more than that."""
    if len(point) <= most:
        return None
    while len(point) > most and point.max() < 128:
        point = point.reshape(2, -1).sum(0, dtype=np.uint8)
    return point.tobytes()


class Points:
    """Points of a batch, in one matrix per number of groups."""

    def __init__(self, col: pa.Array):
        col = col.cast(pa.large_binary())
        _, off, data = col.buffers()
        off = np.frombuffer(off, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
        raw = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if len(col) else np.zeros(0, np.uint8)
        self.groups = np.diff(off)
        self.place = np.zeros(len(col), dtype=np.int64)
        self.matrix: dict[int, np.ndarray] = {}
        begin = off[:-1] - off[0] if len(col) else off[:0]
        for g in np.unique(self.groups).tolist():
            at = np.flatnonzero(self.groups == g)
            self.matrix[g] = raw[begin[at][:, None] + np.arange(g)]
            self.place[at] = np.arange(len(at))

    def take(self, rows: np.ndarray, groups: int) -> np.ndarray:
        """Points of ``rows`` folded to ``groups``; all rows must have that many or more."""
        kinds = np.unique(self.groups[rows]).tolist()
        if kinds == [groups]:
            return self.matrix[groups][self.place[rows]]
        out = np.zeros((len(rows), groups), dtype=np.int32)
        for g in kinds:
            at = np.flatnonzero(self.groups[rows] == g)
            out[at] = self.matrix[g][self.place[rows[at]]].reshape(len(at), g // groups, groups).sum(
                1, dtype=np.int32)
        return out


def overlap_bound(p: Points, i: np.ndarray, q: Points, j: np.ndarray, size_p: np.ndarray,
                  size_q: np.ndarray, sim: "Similarity") -> np.ndarray:
    """The most members that sets ``i`` of ``p`` and ``j`` of ``q`` can share (the sum of their
    smaller coordinates), -1 where that is too few to link."""
    bound = np.full(len(i), -1, dtype=np.int64)
    near = np.flatnonzero((sim.den * size_p[i] >= sim.num * size_q[j])
                          & (sim.den * size_q[j] >= sim.num * size_p[i]))
    common = np.minimum(p.groups[i[near]], q.groups[j[near]])
    for g in np.unique(common).tolist():
        at = near[common == g]
        step = max(1, (1 << 21) // g)
        for a in range(0, len(at), step):
            own = at[a:a + step]
            inter = np.minimum(p.take(i[own], g), q.take(j[own], g)).sum(1, dtype=np.int64)
            ok = sim.linked(inter, size_p[i[own]] + size_q[j[own]])
            bound[own[ok]] = inter[ok]
    return bound


def box_join(points: np.ndarray, sizes: np.ndarray, sim: Similarity,
             slab: int = 200_000) -> np.ndarray:
    """Index pairs ``(i, j)`` whose bound reaches the threshold, each once, found by descending
    an R-tree of ``points`` with itself."""
    k = len(points)
    if k < 2:
        return np.zeros((0, 2), dtype=np.int64)
    order = np.lexsort((points[:, 1], points[:, 0] // 4, sizes // 8))
    levels = [(points[order], points[order], sizes[order], sizes[order])]  # low, high, sizes
    while len(levels[-1][0]) > 1:
        lo, hi, smin, smax = levels[-1]
        cut = np.arange(0, len(lo), LEAF)
        levels.append((np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut),
                       np.minimum.reduceat(smin, cut), np.maximum.reduceat(smax, cut)))
    found = []
    stack = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        depth, u, v = stack.pop()
        if len(u) > slab:
            half = len(u) // 2
            stack += [(depth, u[:half], v[:half]), (depth, u[half:], v[half:])]
            continue
        _, hi, smin, smax = levels[depth]
        ok = (sim.den * smax[v] >= sim.num * smin[u]) & (sim.den * smax[u] >= sim.num * smin[v])
        u, v = u[ok], v[ok]
        bound = np.concatenate([
            np.minimum(hi[u[a:a + 20_000]], hi[v[a:a + 20_000]]).sum(axis=1)
            for a in range(0, len(u), 20_000)] or [np.zeros(0)])
        ok = sim.linked(bound, smin[u] + smin[v])
        u, v = u[ok], v[ok]
        if depth == 0:
            found.append(np.stack([order[u], order[v]], axis=1))
            continue
        below = len(levels[depth - 1][0])
        a = (u[:, None, None] * LEAF + np.arange(LEAF)[None, :, None])
        b = (v[:, None, None] * LEAF + np.arange(LEAF)[None, None, :])
        a, b = np.broadcast_arrays(a, b)
        ok = (a < below) & (b < below) & ((a < b) if depth == 1 else (a <= b))
        if ok.any():
            stack.append((depth - 1, a[ok], b[ok]))
    return np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)


NAMES = ["doc_id", "n_shingles", "node", "point", "coarse", "heavy"]
# Shingles that a task of the survey counts at a time.
COUNTED = 1 << 22


def _survey(docs: DataFrame, sim: Similarity) -> DataFrame:
    """First pass: a row per document ``(doc_id, n_shingles, node, point)``, and rows
    ``(node = shingle, n_shingles = sets)`` flagged ``heavy`` for shingles that three or more
    different sets hold among some ``COUNTED`` shingles read together."""
    def counted(kept: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        every = np.sort(np.concatenate(kept)) if kept else np.zeros(0, np.uint64)
        cut = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else \
            np.zeros(0, np.int64)
        held = np.diff(np.append(cut, len(every)))
        many = held >= 3
        k = int(many.sum())
        return pa.RecordBatch.from_arrays([
            pa.nulls(k, kind), pa.array(held[many].astype(np.int64)),
            pa.array(every[cut[many]].astype(np.int64)), pa.nulls(k, pa.binary()),
            pa.nulls(k, pa.binary()), pa.array(np.ones(k, dtype=bool))], NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, seen, held, kind = [], set(), 0, None
        for batch in batches:
            key = batch.column(0)
            kind = key.type
            for a, b, raw, off in wd.chunks(batch.column(1)):
                s, start = sets(raw, off, sim.n)
                size, names = np.diff(start), identities(s, start)
                counts, where = points(s, start)
                none = size == 0
                point = pa.Array.from_buffers(pa.binary(), b - a, [
                    None, pa.py_buffer(where.astype(np.int32)), pa.py_buffer(counts)])
                yield pa.RecordBatch.from_arrays([
                    key.slice(a, b - a), pa.array(size), pa.array(names, mask=none), point,
                    pa.array([folded(counts[x:y], TREE_GROUPS) for x, y in zip(where, where[1:])],
                             pa.binary()),
                    pa.array(np.zeros(b - a, dtype=bool))], NAMES)
                new = np.zeros(b - a, dtype=bool)  # a set that repeats counts once
                for i, x in enumerate(names.tolist()):
                    if x not in seen:
                        seen.add(x)
                        new[i] = True
                kept.append(s[np.repeat(new, size)])
                held += len(kept[-1])
                if held >= COUNTED:
                    yield counted(kept, kind)
                    kept, seen, held = [], set(), 0
        if kind is not None:
            yield counted(kept, kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lean(run), f"doc_id {kind}, n_shingles long, node long, point binary, coarse binary, heavy boolean")


def prefixes(s: np.ndarray, start: np.ndarray, sim: Similarity, heavy: np.ndarray):
    """``(shingle, row)`` of every set's prefix in the order (not heavy, hash)."""
    size = np.diff(start)
    row = np.repeat(np.arange(len(size)), size)
    last = np.zeros(len(s), dtype=np.int64)
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)
        last = (heavy[at] == s).astype(np.int64)
    before_last = np.cumsum(last) - last
    before_rest = np.arange(len(s)) - before_last
    rest = size - _row_sums(last, start)
    head = start[:-1][row]
    rank = np.where(last == 1, rest[row] + before_last - np.append(before_last, 0)[head],
                    before_rest - np.append(before_rest, 0)[head])
    pick = rank < sim.prefix(size)[row]
    return s[pick], row[pick]


def _listed(docs: DataFrame, sim: Similarity, heavy: np.ndarray) -> DataFrame:
    """Second pass: ``(shingle, node)`` for the prefix of every set. A tree is named by 40 bits
    of its shingle: two shingles in one tree cost a few more bounds and lose nothing."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, raw, off in wd.chunks(batch.column(0)):
                s, start = sets(raw, off, sim.n)
                names = identities(s, start)
                _, one = np.unique(names, return_index=True)  # equal sets list once
                token, row = prefixes(s, start, sim, shared.value)
                new = np.zeros(len(names), dtype=bool)
                new[one] = True
                token, row = token[new[row]], row[new[row]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((token >> np.uint64(24)).astype(np.int64)), pa.array(names[row])],
                    ["shingle", "node"])

    return docs.select("text").mapInArrow(lean(run), "shingle long, node long")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, sim: Similarity, shelf: Shelf) -> DataFrame:
    """The pairs ``(u, v)`` of nodes whose texts reach the threshold."""
    need = shelf.put(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
                       .join(nodes.select("node", "doc_id"), "node"))
    # rows that repeat a document id may differ, so the node of each text is made anew
    every = docs.select("doc_id", "text")
    own = rows_of(every, need.select("doc_id").distinct(), "doc_id")
    if not need.filter("doc_id IS NULL").isEmpty():  # nodes that only rows without an id have
        own = own.unionByName(every.filter("doc_id IS NULL"))
    texts = shelf.put(rows_of(_with_node(own, sim), need.select("node"), "node").groupBy("node").agg(F.max("text").alias("text")))
    both = (pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("a")), "u")
            .join(texts.select(F.col("node").alias("v"), F.col("text").alias("b")), "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for a, b, raw, off in wd.chunks(batch.column(2)):
                left, x = sets(raw, off, sim.n)
                raw2, off2 = wd.text_buffers(batch.column(3).slice(a, b - a))
                right, y = sets(raw2[off2[0]:off2[-1]], off2 - off2[0], sim.n)
                for i in range(b - a):
                    own = np.concatenate([left[x[i]:x[i + 1]], right[y[i]:y[i + 1]]])
                    own.sort()
                    keep[a + i] = sim.linked(int((own[1:] == own[:-1]).sum()), len(own))
            ok = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(ok), batch.column(1).filter(ok)], ["u", "v"])

    return both.select("u", "v", "a", "b").mapInArrow(lean(run), "u long, v long")


def _with_node(docs: DataFrame, sim: Similarity) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, off in wd.chunks(batch.column(0)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(identities(*sets(raw, off, sim.n))), batch.column(0).slice(a, b - a)],
                    ["node", "text"])

    return docs.select("text").mapInArrow(lean(run), "node long, text string")


def _in_bound(pairs: DataFrame, nodes: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs whose points allow the threshold."""
    side = lambda name, c: nodes.select(F.col("node").alias(name), F.col("point").alias(c))
    size = lambda name, c: nodes.select(F.col("node").alias(name), F.col("n_shingles").alias(c))
    # sizes first: they travel light and decide most pairs
    sized = pairs.join(size("u", "np"), "u").join(size("v", "nq"), "v").filter(
        (sim.den * F.col("np") >= sim.num * F.col("nq")) & (sim.den * F.col("nq") >= sim.num * F.col("np")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = np.arange(batch.num_rows)
            ok = pa.array(overlap_bound(Points(batch.column(2)), every, Points(batch.column(3)), every,
                                        batch.column(4).to_numpy(), batch.column(5).to_numpy(), sim) >= 0)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)],
                                             ["u", "v"])

    both = sized.join(side("u", "p"), "u").join(side("v", "q"), "v")
    return both.select("u", "v", "p", "q", "np", "nq").mapInArrow(lean(run), "u long, v long")


def tree_pairs(p: Points, sizes: np.ndarray, group: np.ndarray, sim: Similarity, wanted):
    """``(i, j, bound)`` of the pairs inside each run of equal ``group`` (sorted) that
    ``wanted(i, j)`` flags and the bound allows."""
    cut = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    count = np.diff(np.append(cut, len(group)))
    found = [(np.zeros(0, np.int64),) * 3]

    def bounded(i: np.ndarray, j: np.ndarray) -> None:
        keep = wanted(i, j)
        i, j = i[keep], j[keep]
        bound = overlap_bound(p, i, p, j, sizes, sizes, sim)
        found.append((i[bound >= 0], j[bound >= 0], bound[bound >= 0]))

    for k in np.unique(count[(count > 1) & (count <= ONE_NODE)]).tolist():
        x, y = np.triu_indices(k, 1)
        head = cut[count == k][:, None]
        bounded((head + x).ravel(), (head + y).ravel())
    for a, k in zip(cut[count > ONE_NODE].tolist(), count[count > ONE_NODE].tolist()):
        own = np.arange(a, a + k)
        boxes = p.take(own, min(BOX_GROUPS, int(p.groups[own].min()))).astype(np.int32)
        pairs = box_join(boxes, sizes[own], sim) + a
        bounded(pairs[:, 0], pairs[:, 1])
    return tuple(np.concatenate(c) for c in zip(*found))


def likeliest(i: np.ndarray, j: np.ndarray, score: np.ndarray, tree: np.ndarray, most: int) -> np.ndarray:
    """Indices of the pairs that are among the ``most`` best of either end within their tree."""
    each = np.concatenate([i, j])
    best = np.concatenate([score, score])
    order = np.lexsort((-best, each, np.concatenate([tree, tree])))
    key = each[order]
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    rank = np.arange(len(key)) - np.repeat(head, np.diff(np.append(head, len(key))))
    return np.unique(order[rank < most] % len(i)) if len(i) else np.zeros(0, np.int64)


def pair_key(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """A 64-bit name of the unordered pair."""
    a, b = wd.mix(np.maximum(u, v).astype(np.uint64)), np.minimum(u, v).astype(np.uint64)
    with np.errstate(over="ignore"):
        return wd.mix(a * wd._BASE + wd.mix(b))


# Names of pairs that a task keeps, to make none twice (8 bytes each).
MADE = 1 << 20


def first_time(keys: np.ndarray, made: list[np.ndarray]) -> np.ndarray:
    """Which of ``keys`` are not in the sorted ``made[0]`` nor before in ``keys``; they are put
    there while it holds fewer than ``MADE``."""
    new = np.zeros(len(keys), dtype=bool)
    new[np.unique(keys, return_index=True)[1]] = True
    new &= ~np.isin(keys, made[0])
    if len(made[0]) < MADE:
        made[0] = np.union1d(made[0], keys[new])
    return new


def _tree_pairs(members: DataFrame, nodes: DataFrame, tested: DataFrame, sim: Similarity) -> DataFrame:
    """``(shingle, u, v)``: untested pairs of nodes of different components that some tree's
    bound allows, the ``BEST`` likeliest of every node in every tree, from
    ``members(shingle, node, component)``. Large trees are joined block by block; a task reads
    whole trees (or pairs of blocks) one after another. Near copies meet in many trees: a pair
    that a task has made already is not made again, and a tree whose pairs all are such is a row
    without nodes."""
    size = members.groupBy("shingle").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    done = tested.groupBy(F.col("u").alias("node")).agg(F.collect_set("v").alias("done"))
    own = (members.join(size, "shingle")
           .withColumn("x", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
           .withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("shingle", F.xxhash64("shingle", F.least("x", "y"), F.greatest("x", "y")).alias("tree"),
                   (F.col("x") > F.col("y")).alias("high"), (F.col("x") == F.col("y")).alias("same"),
                   "node", "component")
           .join(nodes.select("node", "n_shingles", F.coalesce("coarse", "point").alias("point")), "node")
           .join(done, "node", "left")
           .select("tree", "high", "same", "node", "component", "n_shingles", "point", "done", "shingle"))
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def joined(b: pa.RecordBatch, made: list[np.ndarray]) -> pa.RecordBatch:
        tree, node, comp, size, shingle = (b.column(i).to_numpy() for i in (0, 3, 4, 5, 8))
        high, same = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
        lists = b.column(7)
        before = pair_key(np.repeat(node, lists.value_lengths().fill_null(0).to_numpy()),
                          lists.flatten().to_numpy())

        def wanted(i, j):
            ok = (comp[i] != comp[j]) & (same[i] | (high[i] != high[j]))
            ok[ok] = ~np.isin(pair_key(node[i[ok]], node[j[ok]]), before)
            return ok

        i, j, bound = tree_pairs(Points(b.column(6)), size, tree, sim, wanted)
        top = likeliest(i, j, bound / np.maximum(size[i] + size[j] - bound, 1), tree[i], BEST)
        own, u, v = shingle[i[top]], node[i[top]], node[j[top]]
        new = first_time(pair_key(u, v), made)
        known = np.setdiff1d(own, own[new])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.append(own[new], known)),
             *(pa.concat_arrays([pa.array(x(u[new], v[new])), pa.nulls(len(known), pa.int64())])
               for x in (np.maximum, np.minimum))], ["shingle", "u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, made = None, [np.zeros(0, dtype=np.uint64)]  # a tree goes on in the next batch
        for batch in batches:
            if left is not None:
                batch = pa.Table.from_batches([left, batch]).combine_chunks().to_batches()[0]
            tree = batch.column(0).to_numpy()
            whole = int(np.searchsorted(tree, tree[-1]))
            left = batch.slice(whole)
            if whole:
                yield joined(batch.slice(0, whole), made)
        if left is not None:
            yield joined(left, made)

    return (own.repartition(n, "tree").sortWithinPartitions("tree")
            .mapInArrow(lean(run), "shingle long, u long, v long"))


def _one_of_equal_trees(members: DataFrame) -> DataFrame:
    """Of the trees that hold the same nodes, one."""
    each = members.groupBy("shingle").agg(
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"), F.count(F.lit(1)).alias("k"))
    kept = each.filter("k > 1").groupBy("sum", "k").agg(F.min("shingle").alias("shingle"))
    return members.join(kept.select("shingle"), "shingle", "left_semi")


def jaccard_components(docs: DataFrame, sim: Similarity = Similarity()) -> DataFrame:
    """``(doc_id, n_shingles, node, component_id, component)`` for every row of ``docs``; the
    component is the smallest document id reachable by links, itself included (``component``:
    the same as a number of its sets, which tells components without an id apart).

    Texts without words (null, empty, blank) have no shingles and are linked with nothing;
    a text shorter than a shingle is one shingle; equal sets are linked whatever their order.
    Rows that repeat an id are rows with their own set; a null id is a row whose component is
    the smallest id of its class (null when there is none). Other columns are ignored; an
    empty table gives no rows. Texts are read whole.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shelf = Shelf(spark)
    survey = checkpointed(_survey(docs, sim))
    rows = survey.filter("NOT heavy").select("doc_id", "n_shingles", "node")
    # the most frequent shingles; they only set the order, any list gives the same result
    heavy = (survey.filter("heavy").groupBy("node").agg(F.sum("n_shingles").alias("n"))
             .filter("n >= 8").orderBy(F.desc("n"), "node").limit(HEAVY).select("node").toPandas())
    heavy = np.sort(heavy["node"].to_numpy().astype(np.int64).astype(np.uint64))
    # equal sets have equal points, so any one stands for the node
    nodes = checkpointed(survey.filter("NOT heavy AND node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n_shingles"),
        F.min("point").alias("point"), F.min("coarse").alias("coarse")))
    # dealt out once for both the minima and the join
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = _listed(docs, sim, heavy).repartition(n, "shingle")
    ends = (listed.groupBy("shingle").agg(F.min("node").alias("first"), F.max("node").alias("last"))
            .filter("first < last").hint("merge"))
    listed = checkpointed(listed.join(ends, "shingle").select("shingle", "node", "first").distinct())
    tried = (listed.filter("node > first").select(F.col("node").alias("u"), F.col("first").alias("v"))
             .distinct())
    tried = shelf.put(_in_bound(tried, nodes, sim))
    links = shelf.put(_verified(tried, nodes, docs, sim, shelf))
    comp = shelf.put(connected_components(links, shelf))
    tested = shelf.put(tried.join(links, ["u", "v"], "left_anti"))
    # the first node of a tree has been tried against all others already
    live = shelf.put(_one_of_equal_trees(listed.filter("node <> first").select("shingle", "node")))
    while True:
        shelf.clear(tested, comp, live)
        named = (live.join(comp, "node", "left")
                 .select("shingle", "node", F.coalesce("component", "node").alias("component")))
        mixed = (named.groupBy("shingle").agg(F.min("component").alias("a"), F.max("component").alias("b"))
                 .filter("a < b").select("shingle"))
        found = shelf.put(_tree_pairs(named.join(mixed, "shingle", "left_semi"), nodes, tested, sim))
        if found.isEmpty():
            break
        pairs = shelf.put(found.filter("u IS NOT NULL").select("u", "v").distinct())
        more = shelf.put(_verified(shelf.put(_in_bound(pairs, nodes, sim)), nodes, docs, sim, shelf))
        tested = shelf.put(tested.unionByName(pairs.join(more, ["u", "v"], "left_anti")))
        comp = shelf.put(connected_components(comp.select(
            F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more), shelf))
        # a tree that proposed nothing has nothing left to propose
        live = shelf.put(live.join(found.select("shingle").distinct(), "shingle", "left_semi"))
    named_nodes = nodes.select("node", "doc_id").join(comp, "node", "left").select(
        "node", "doc_id", F.coalesce("component", "node").alias("component"))
    least = named_nodes.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = named_nodes.join(least, "component").select("node", "component_id", "component")
    return (rows.join(by_node, "node", "left")
            .select("doc_id", "n_shingles", "node",
                    F.when(F.col("node").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id"), "component"))


def one_of_each(docs: DataFrame, sim: Similarity = Similarity()) -> DataFrame:
    """``docs`` with one row of each component, the one that names it (of rows with that id and
    the same or another set of the component, any one; where all its ids are null, any row),
    and every row without shingles. Rows are told apart by id and set of shingles, so those
    that share an id, or have none, stay where their texts are of different components.
    Columns are unchanged."""
    classes = jaccard_components(docs, sim).filter("node IS NOT NULL")
    # one (id, set) per component; components are told apart by their smallest set
    kept = (classes.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("one"))
        .select("one.*"))
    key = lambda c: [F.col(c).isNull().alias("none"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("id")]
    # plain columns of the id, so that one exchange serves both the join and the choice; the row
    # itself travels as one column, so that its names clash with none of these
    named = _named(docs, sim)
    names = ["node", "none", "id"]
    once = (named.filter("node IS NOT NULL").select("row", "node", *key("row.doc_id"))
            .join(kept.select("node", *key("doc_id")), names, "left_semi").dropDuplicates(names))
    return named.filter("node IS NULL").select("row").unionByName(once.select("row")).select("row.*")


def _named(docs: DataFrame, sim: Similarity) -> DataFrame:
    """``(row, node)``: the rows of ``docs`` and the identity of their sets (null: no shingles)."""
    def node(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in texts:
            out = []
            for _, _, raw, off in wd.chunks(pa.array(text, pa.string())):
                s, start = sets(raw, off, sim.n)
                out.append(pd.Series(identities(s, start), dtype="Int64").mask(np.diff(start) == 0))
            yield pd.concat(out) if out else pd.Series([], dtype="Int64")

    return docs.select(F.struct("*").alias("row"), F.pandas_udf(node, "long")("text").alias("node"))
