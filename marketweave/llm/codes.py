"""Vector code compression: product codes by Lloyd rounds over partition-local cover trees.

Vectors become integers ``floor(1024 x)`` and are cut into equal consecutive parts. Every run of
``CHUNK`` rows of a partition gets one cover tree per part position, built once and stored under
the shared checkpoint folder with its points. A node covers a contiguous range of the tree's
order, so cumulative sums give the sum of any subtree.

A round sends the codebooks to the trees. With node centre c, radius r and nearest entry at
distance d, an entry farther than d + 2r from c is nearest to no point below (triangle
inequality): where one entry is left the whole subtree goes to it by its cumulative sums,
only ambiguous nodes are opened, and only ambiguous leaves compare their points exactly. Each
task adds up (part, entry) sums over all its trees and hands on one row per used coordinate; the
grouped sums make the next codebooks, whose size does not depend on the data.

All distances are exact: integers below 2**53 in double precision, Python integers beyond.
Triangle bounds carry a margin, and ties go to the lower index as entries that tie are never
pruned. So the result depends neither on the partitions nor on the trees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketweave.llm.common import BROADCAST_IDS
from marketweave.session import scratch_path

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
CHUNK = 4096
LEAF = 16
BASE = 1.5
LIMIT = 1 << 62  # integers are cut at +- this
LONG = (1 << 63) - 1
EXACT = 1 << 53
MARGIN = 1 + 1e-9


def quantise(m: np.ndarray) -> np.ndarray:
    """``floor(1024 x)`` as 64-bit integers, cut at +-2**62."""
    with np.errstate(over="ignore"):
        q = np.floor(m.astype(np.float64) * SCALE)
    big = np.abs(q) >= LIMIT
    out = np.where(big, 0, q).astype(np.int64)
    out[big] = np.where(q[big] > 0, LIMIT, -LIMIT)
    return out


def _size(m: np.ndarray) -> int:
    return max(abs(int(m.min())), abs(int(m.max()))) if m.size else 0


def squared_distances(p: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows ``p`` to integer rows ``e``: doubles where every
    term is an integer below 2**53, Python integers otherwise."""
    if (2 * max(_size(p), _size(e))) ** 2 * p.shape[1] < EXACT:
        a, b = p.astype(np.float64), e.astype(np.float64)
        return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    a, b = p.astype(object), e.astype(object)
    return np.stack([((a - row) ** 2).sum(1) for row in b], axis=1).reshape(len(p), len(e))


def _roots(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64))


@dataclass
class CoverTree:
    """A cover tree in arrays. ``order`` lists the points by node; node ``i`` covers
    ``order[lo[i]:hi[i]]``, ``centre[i]`` is one of its points, ``radius[i]`` reaches all of
    them, and its children are the nodes ``child[i]`` up to ``child[i] + fan[i]``."""

    order: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    fan: np.ndarray

    KINDS = (("order", "<i4"), ("lo", "<i4"), ("hi", "<i4"), ("centre", "<i4"),
             ("radius", "<f8"), ("child", "<i4"), ("fan", "<i4"))

    @classmethod
    def build(cls, points: np.ndarray) -> CoverTree:
        """Top down: the points of a node within the next smaller cover radius of its centre
        stay with the centre, the first one left becomes the next centre, and so on; centres of
        one node are farther apart than that radius."""
        order = np.arange(len(points))
        dist = _roots(squared_distances(points, points[:1])[:, 0])
        nodes = [[0, len(points), 0, float(dist.max()), 0, 0]]
        at = [dist]
        todo = 0
        while todo < len(nodes):
            lo, hi, centre, radius, _, _ = nodes[todo]
            here, dist = order[lo:hi].copy(), at[todo]
            at[todo] = None
            if hi - lo > LEAF and radius > 0:
                cover = BASE ** np.floor(np.log(radius) / np.log(BASE))
                if cover >= radius:
                    cover /= BASE
                nodes[todo][4] = len(nodes)
                put, rest = lo, np.arange(len(here))
                while len(rest):
                    near = dist <= cover
                    own = rest[near]
                    order[put:put + len(own)] = here[own]
                    nodes.append([put, put + len(own), centre, float(dist[near].max()), 0, 0])
                    at.append(dist[near])
                    put, rest = put + len(own), rest[~near]
                    if len(rest):
                        centre = int(here[rest[0]])
                        dist = _roots(squared_distances(points[here[rest]], points[[centre]])[:, 0])
                nodes[todo][5] = len(nodes) - nodes[todo][4]
            todo += 1
        n = np.array(nodes, dtype=object)
        return cls(order, *(n[:, i].astype(k) for i, (_, k) in enumerate(cls.KINDS[1:])))

    def pack(self) -> list[bytes]:
        return [getattr(self, name).astype(kind).tobytes() for name, kind in self.KINDS]

    @classmethod
    def unpack(cls, data: list[bytes]) -> CoverTree:
        return cls(*(np.frombuffer(d, kind) for d, (_, kind) in zip(data, cls.KINDS)))

    def assign(self, points: np.ndarray, entries: np.ndarray):
        """``(lo, hi, entry)``: ranges of ``order`` that cover every point once, each with the
        nearest entry of all its points (ties: the lowest)."""
        found = []
        nodes = np.zeros(1, dtype=np.int64)
        while len(nodes):
            d2 = squared_distances(points[self.centre[nodes]], entries)
            best = d2.argmin(axis=1)
            d = _roots(d2)
            reach = (d[np.arange(len(d)), best] + 2 * self.radius[nodes]) * MARGIN
            whole = ((d <= reach[:, None]).sum(axis=1) == 1) | (self.radius[nodes] == 0)
            found.append((self.lo[nodes[whole]], self.hi[nodes[whole]], best[whole]))
            leaf = nodes[~whole & (self.fan[nodes] == 0)]
            if len(leaf):
                at = _spans(self.lo[leaf], self.hi[leaf] - self.lo[leaf])
                exact = squared_distances(points[self.order[at]], entries).argmin(axis=1)
                found.append((at, at + 1, exact))
            inner = nodes[~whole & (self.fan[nodes] > 0)]
            nodes = _spans(self.child[inner], self.fan[inner])
        return (np.concatenate(x).astype(np.int64) for x in zip(*found))


def _spans(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers ``begin[i] .. begin[i] + length[i] - 1`` of all ``i``, one after another."""
    begin, length = begin.astype(np.int64), length.astype(np.int64)
    ends = np.cumsum(length)
    return np.repeat(begin - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)


def part_sums(points: np.ndarray, tree: CoverTree, entries: np.ndarray):
    """``(counts, sums)`` per entry of the points assigned to it, from cumulative sums."""
    lo, hi, best = tree.assign(points, entries)
    safe = _size(points) * max(1, len(points)) < 1 << 62
    own = points[tree.order].astype(np.int64 if safe else object)
    total = np.concatenate([np.zeros((1, points.shape[1]), own.dtype), np.cumsum(own, axis=0)])
    counts = np.zeros(len(entries), np.int64)
    sums = np.zeros((len(entries), points.shape[1]), own.dtype)
    np.add.at(counts, best, hi - lo)
    np.add.at(sums, best, total[hi] - total[lo])
    return counts, sums


def _usable(v: str):
    return F.col(v).isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def first_vectors(rows: DataFrame, parts: int, n: int) -> tuple[int, list]:
    """The vector length to compress (that of the first row whose length is a positive multiple
    of ``parts``) and the first ``n`` vectors of that length by ``vec_id``."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("vec").asc()]
    fit = rows.filter((F.size("vec") > 0) & (F.size("vec") % parts == 0))
    found = [r["vec"] for r in fit.orderBy(*order).limit(n).select("vec").collect()]
    dim = len(found[0]) if found else 0
    if any(len(v) != dim for v in found):
        found = [r["vec"] for r in fit.filter(F.size("vec") == dim).orderBy(*order).limit(n)
                 .select("vec").collect()]
    return dim, found


TREE = "trees array<struct<" + ", ".join(f"{k} binary" for k, _ in CoverTree.KINDS) + ">>"
_TREES = pa.list_(pa.struct([(k, pa.binary()) for k, _ in CoverTree.KINDS]))


def _planted(rows: DataFrame, dim: int, parts: int, chunk: int) -> DataFrame:
    """The rows in chunks with their trees, stored: ``(ids, labels, kind, points, trees)``."""
    ids, labels = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, chunk):
                own = batch.slice(a, min(chunk, batch.num_rows - a))
                q = quantise(own.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
                kind = next(k for k in ("<i2", "<i4", "<i8") if _size(q) <= np.iinfo(k).max)
                trees = [CoverTree.build(x).pack() for x in np.split(q, parts, axis=1)]
                names = [k for k, _ in CoverTree.KINDS]
                one = pa.array([0, own.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(one, own.column(0)),
                     pa.ListArray.from_arrays(one, own.column(1)), pa.array([kind]),
                     pa.array([q.astype(kind).tobytes()], pa.binary()),
                     pa.array([[dict(zip(names, t)) for t in trees]], _TREES)],
                    ["ids", "labels", "kind", "points", "trees"])

    spark = rows.sparkSession
    path = scratch_path(spark, "cover-trees")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows are dealt evenly, once and for all rounds: building the trees is the costly part.
    (rows.filter(F.size("vec") == dim).select("vec_id", "label", "vec").repartition(n)
     .mapInArrow(run, f"ids array<{ids}>, labels array<{labels}>, kind string, points binary, {TREE}")
     .write.parquet(path))
    return spark.read.parquet(path)


def _opened(batch: pa.RecordBatch, dim: int, parts: int) -> Iterator[tuple]:
    """``(ids, labels, parts' points, parts' trees)`` of every stored chunk."""
    for i in range(batch.num_rows):
        kind = batch.column(2)[i].as_py()
        q = np.frombuffer(batch.column(3)[i].as_buffer(), kind).astype(np.int64).reshape(-1, dim)
        trees = [CoverTree.unpack(list(t.values())) for t in batch.column(4)[i].as_py()]
        yield batch.column(0)[i].values, batch.column(1)[i].values, np.split(q, parts, axis=1), trees


def _next_books(planted: DataFrame, books: list[np.ndarray], dim: int) -> list[np.ndarray]:
    """One round: entries become the floored means of their parts, unused ones stay."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, object) for b in books]
        for batch in batches:
            for _, _, points, trees in _opened(batch, dim, parts):
                for k in range(parts):
                    n, s = part_sums(points[k], trees[k], books[k])
                    counts[k] += n
                    sums[k] = sums[k] + s
        for k in range(parts):
            at = np.flatnonzero(counts[k])
            if len(at):
                w = books[k].shape[1]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at) * w, k), pa.int32()),
                    pa.array(np.repeat(at, w), pa.int32()),
                    pa.array(np.tile(np.arange(w), len(at)), pa.int32()),
                    pa.array(np.repeat(counts[k][at], w)),
                    pa.array([Decimal(int(x)) for x in sums[k][at].ravel()], pa.decimal128(38, 0))],
                    ["part", "entry", "place", "n", "s"])

    found = (planted.mapInArrow(run, "part int, entry int, place int, n long, s decimal(38,0)")
             .groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
             .collect())  # one row per coordinate of the codebooks at most
    out = [b.copy() for b in books]
    for r in found:
        out[r["part"]][r["entry"], r["place"]] = int(r["s"]) // r["n"]
    return out


def _coded(planted: DataFrame, books: list[np.ndarray], dim: int) -> DataFrame:
    """``(vec_id, label, code, error)`` of every stored row; codes as hex digits."""
    parts = len(books)
    ids, labels = (planted.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, label, points, trees in _opened(batch, dim, parts):
                code = np.zeros((len(own), parts), np.uint8)
                error = np.zeros(len(own), object)
                for k, (p, t) in enumerate(zip(points, trees)):
                    lo, hi, best = t.assign(p, books[k])
                    code[t.order[_spans(lo, hi - lo)], k] = np.repeat(best, hi - lo)
                    wide = (2 * max(_size(p), _size(books[k]))) ** 2 * dim >= LONG
                    gap = p.astype(object if wide else np.int64) - books[k][code[:, k]]
                    error = error + (gap * gap).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [own, label, pa.array([c.tobytes().hex() for c in code], pa.string()),
                     pa.array([min(int(e), LONG) for e in error], pa.int64())],
                    ["vec_id", "label", "code", "error"])

    return planted.mapInArrow(run, f"vec_id {ids}, label {labels}, code string, error long")


def compress(vectors: DataFrame, column: str = "embedding", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, chunk: int = CHUNK):
    """``(codes, codebooks)`` of ``vectors(vec_id, label, <column>)``: codes is the table
    ``(vec_id, label, code, error)``, one row per kept row; codebooks is one integer array
    (entry, position) per part.

    Rows whose vector is null or has null or non-finite components are dropped, and so are
    vectors of another length than the first kept one's (by ``vec_id``, nulls last, then by
    components) whose length is a positive multiple of ``parts``. The first ``entries`` kept
    rows in that order start the codebooks; a repeated id counts as often as it stands there,
    and with fewer rows there are fewer entries. Null ids are coded as all others; other columns
    are ignored. Components beyond 2**62 / 1024 are cut there, an error beyond 64 bits is given
    as the largest. Nothing kept: an empty table and no codebooks.
    """
    if not 0 < entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    rows = vectors.select("vec_id", "label", F.col(column).alias("vec")).filter(_usable("vec"))
    dim, first = first_vectors(rows, parts, entries)
    if not first:
        empty = rows.limit(0).select("vec_id", "label", F.lit("").alias("code"),
                                     F.lit(0).cast("long").alias("error"))
        return empty, []
    books = np.split(quantise(np.array(first, dtype=np.float64)), parts, axis=1)
    planted = _planted(rows, dim, parts, chunk)
    for _ in range(rounds):
        books = _next_books(planted, books, dim)
    path = scratch_path(vectors.sparkSession, "vector-codes")
    _coded(planted, books, dim).write.parquet(path)
    return vectors.sparkSession.read.parquet(path), books


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' decimal components by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``, the sum of ``error`` over the rows of a label (nulls
    together; beyond 64 bits: the largest). Labels are summed first and sent to the rows: as a
    broadcast when they are few (counted), else by a join that can split a hot label."""
    total = codes.groupBy("label").agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG)).cast("long").alias("label_error"))
    total = total.withColumnRenamed("label", "own_label")
    few = total.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return codes.join(F.broadcast(total) if few else total,
                      F.col("label").eqNullSafe(F.col("own_label"))).drop("own_label")
