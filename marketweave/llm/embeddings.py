"""Embedding near-duplicates by an epsilon grid order join.

On the unit sphere cosine >= c means distance <= eps = sqrt(2 - 2c). Vectors are rotated to
their principal dimensions, laid on a grid of side eps, and sorted by label and grid cell of
the leading dimensions. The sorted sequence is cut into blocks; only blocks whose boxes come
within eps of each other meet, and a pair of blocks is joined by halving both sequence
intervals until a pair of intervals is provably distant or small enough to be compared at
once. Equal vectors of a label are one class before the join.

Counting happens inside the interval pairs, so links are never listed: an interval pair adds
up link counts and hands on one edge per vector and component it sees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketweave.llm.components import connected_components
from marketweave.session import cut_lineage

GRID_DIMS = 4
BLOCK = 2048
TILE = 128
# Vectors the principal dimensions are fitted on (they decide the order only, not the links).
FIT_ROWS = 20_000


def _usable(v):
    return (F.col(v).isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list array of ``dim`` numbers as doubles."""
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), dim)


def unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (by their largest component first, against under- and overflow)."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _bases(classes: DataFrame) -> dict[int, np.ndarray]:
    """Principal directions per vector length, strongest first."""
    sample = classes.orderBy(F.xxhash64("cls"), "cls").limit(FIT_ROWS).select("vec").toPandas()["vec"]
    out = {}
    for dim in sorted({len(v) for v in sample}):
        u = unit(np.array([v for v in sample if len(v) == dim], dtype=np.float64))
        _, axes = np.linalg.eigh(np.cov(u, rowvar=False, bias=True).reshape(dim, dim))
        out[dim] = axes[:, ::-1].copy()
    return out


def _basis(bases: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return bases.get(dim, np.eye(dim))


def _celled(classes: DataFrame, bases, eps: float) -> DataFrame:
    """Classes with their grid cells on the leading principal dimensions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(3).to_numpy()
            cells = np.zeros((batch.num_rows, GRID_DIMS), dtype=np.int32)
            for dim in np.unique(size).tolist():
                at = np.flatnonzero(size == dim)
                p = unit(_matrix(batch.column(4).take(pa.array(at)), dim)) @ _basis(bases, dim)
                k = min(GRID_DIMS, dim)
                cells[at, :k] = np.floor(p[:, :k] / eps)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(5)] + [pa.array(cells[:, i]) for i in range(GRID_DIMS)],
                ["label", "cls", "copies", "dim", "vec", *CELLS])

    kind = classes.schema
    return classes.select("label", "cls", "copies", "dim", "vec").mapInArrow(
        run, f"label {kind['label'].dataType.simpleString()}, cls long, copies long, dim int, "
             f"vec {kind['vec'].dataType.simpleString()}, " + ", ".join(f"{c} int" for c in CELLS))


CELLS = [f"c{i}" for i in range(GRID_DIMS)]


def _packed(vectors: DataFrame) -> str:
    """How a block packs its vectors: as they are stored, single or double precision."""
    return "<f4" if vectors.schema["vec"].dataType.elementType.simpleString() == "float" else "<f8"


def _blocks(celled: DataFrame, bases) -> DataFrame:
    """The sorted sequence in blocks of at most ``BLOCK`` classes of one label and first cell:
    ``(block, label, dim, c0, lo, hi, cls, copies, vecs)``, the last three packed."""
    order = ["label", "dim", *CELLS, "cls"]
    kind = _packed(celled)
    n = int(celled.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            label, size = batch.column(0), batch.column(3).to_numpy()
            c0, codes = batch.column(5).to_numpy(), batch.column(0).dictionary_encode().indices.to_numpy()
            new = np.flatnonzero((np.diff(codes) != 0) | (np.diff(size) != 0) | (np.diff(c0) != 0)) + 1
            ends = [0, *new.tolist(), batch.num_rows]
            for a, b in zip(ends, ends[1:]):
                for s in range(a, b, BLOCK):
                    own = batch.slice(s, min(BLOCK, b - s))
                    v = _matrix(own.column(4), int(size[s]))
                    p = unit(v) @ _basis(bases, int(size[s]))
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([part << 32 | seq]), "label": label.slice(s, 1),
                        "dim": pa.array([size[s]], pa.int32()), "c0": pa.array([c0[s]], pa.int32()),
                        "lo": [p.min(0).tolist()], "hi": [p.max(0).tolist()],
                        "cls": [own.column(1).to_numpy().astype("<i8").tobytes()],
                        "copies": [own.column(2).to_numpy().astype("<i8").tobytes()],
                        "vecs": [v.astype(kind).tobytes()]})
                    seq += 1

    label_type = celled.schema["label"].dataType.simpleString()
    return (celled.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(
        run, f"block long, label {label_type}, dim int, c0 int, lo array<double>, hi array<double>, "
             "cls binary, copies binary, vecs binary"))


class _Join:
    """Joins two sequence intervals by halving; adds up link counts and collects edges."""

    def __init__(self, a, b, same: bool, least: float, eps: float):
        (self.va, self.pa, self.ka, self.na), (self.vb, self.pb, self.kb, self.nb) = a, b
        self.same, self.least, self.eps2 = same, least, eps * eps
        self.ca, self.cb = np.zeros(len(self.ka), np.int64), np.zeros(len(self.kb), np.int64)
        self.edges: list[np.ndarray] = []
        self.la, self.lb = (np.sqrt((v * v).sum(1)) for v in (self.va, self.vb))

    def run(self, a0: int, a1: int, b0: int, b1: int) -> None:
        if self.same and b1 <= a0:
            return  # the mirrored interval pair is the one that counts
        p, q = self.pa[a0:a1], self.pb[b0:b1]
        gap = np.maximum(0, np.maximum(p.min(0) - q.max(0), q.min(0) - p.max(0)))
        if (gap * gap).sum() > self.eps2:
            return
        if a1 - a0 <= TILE and b1 - b0 <= TILE:
            return self.compare(a0, a1, b0, b1)
        am, bm = (a0 + a1) // 2, (b0 + b1) // 2
        for x0, x1 in ((a0, am), (am, a1)) if a1 - a0 > TILE else ((a0, a1),):
            for y0, y1 in ((b0, bm), (bm, b1)) if b1 - b0 > TILE else ((b0, b1),):
                self.run(x0, x1, y0, y1)

    def compare(self, a0: int, a1: int, b0: int, b1: int) -> None:
        cos = (self.va[a0:a1] @ self.vb[b0:b1].T) / (self.la[a0:a1, None] * self.lb[None, b0:b1])
        hit = cos >= self.least
        if self.same:
            hit &= np.arange(a0, a1)[:, None] < np.arange(b0, b1)[None, :]
        if not hit.any():
            return
        self.ca[a0:a1] += hit @ self.nb[b0:b1]
        self.cb[b0:b1] += self.na[a0:a1] @ hit
        top = np.iinfo(np.int64).max
        x, y = self.ka[a0:a1].copy(), self.kb[b0:b1].copy()
        while True:  # smallest key reachable inside the tile
            low = np.where(hit, y[None, :], top).min(1)
            x2 = np.minimum(x, low)
            y2 = np.minimum(y, np.where(hit, x2[:, None], top).min(0))
            if (x2 == x).all() and (y2 == y).all():
                break
            x, y = x2, y2
        for own, root in ((self.ka[a0:a1], x), (self.kb[b0:b1], y)):
            moved = own != root
            self.edges.append(np.stack([own[moved], root[moved]], axis=1))


def _linked(pairs: DataFrame, bases, least: float, eps: float, kind: str) -> DataFrame:
    """``(u, n, v)``: partial link counts ``n`` of class ``u`` (null ``v``), and edges u-v."""
    def side(r, s, dim):
        v = np.frombuffer(r[f"vecs_{s}"], dtype=kind).astype(np.float64).reshape(-1, dim)
        return (v, unit(v) @ _basis(bases, dim), np.frombuffer(r[f"cls_{s}"], dtype="<i8"),
                np.frombuffer(r[f"copies_{s}"], dtype="<i8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                a = side(r, "a", r["dim"])
                same = r["a"] == r["b"]
                b = a if same else side(r, "b", r["dim"])
                j = _Join(a, b, same, least, eps)
                j.run(0, len(a[2]), 0, len(b[2]))
                e = np.unique(np.concatenate(j.edges), axis=0) if j.edges else np.zeros((0, 2), np.int64)
                at, bt = np.flatnonzero(j.ca), np.flatnonzero(j.cb)
                u = np.concatenate([a[2][at], b[2][bt], e[:, 0]])
                n = np.concatenate([j.ca[at], j.cb[bt], np.zeros(len(e), np.int64)])
                v = np.concatenate([np.zeros(len(at) + len(bt), np.int64), e[:, 1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u), pa.array(n), pa.array(v, mask=n > 0)], ["u", "n", "v"])

    return pairs.mapInArrow(run, "u long, n long, v long")


def near_duplicates(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id, embedding,
    label)``: two vectors link when their labels are equal and not null and their cosine in
    double precision is ``least`` or more.

    Vectors that are null, empty, zero or hold a null or non-finite component, and vectors
    with a null label, link with nothing, nor do vectors of different length. Equal vectors
    link. Rows that repeat an id are vectors of their own; a null id never names a component
    unless all its vectors have one. Other columns are ignored; no rows give no rows.
    """
    spark = vectors.sparkSession
    eps = float(np.sqrt(2.0 - 2.0 * least)) + 1e-6
    v = vectors.select("vec_id", "label", F.col("embedding").alias("vec"))
    ok = F.col("label").isNotNull() & _usable("vec")
    keyed = v.select("vec_id", "label", "vec", F.when(
        ok, F.xxhash64("label", F.transform("vec", lambda x: x + F.lit(0).cast("float"))))
        .alias("cls"))
    classes = cut_lineage(
        keyed.filter("cls IS NOT NULL").groupBy("label", "cls")
        .agg(F.min("vec").alias("vec"), F.count(F.lit(1)).alias("copies"),
             F.min("vec_id").alias("first_id"))
        .withColumn("dim", F.size("vec")))
    bases = _bases(classes)
    blocks = cut_lineage(_blocks(_celled(classes, bases, eps), bases))
    box = blocks.select("block", "label", "dim", "c0", "lo", "hi")
    a = box.select(F.col("block").alias("a"), "label", "dim", F.col("c0").alias("ac"),
                   F.col("lo").alias("alo"), F.col("hi").alias("ahi"),
                   F.explode(F.array("c0", F.col("c0") + 1)).alias("key"))
    b = box.select(F.col("block").alias("b"), "label", "dim", F.col("c0").alias("key"),
                   F.col("lo").alias("blo"), F.col("hi").alias("bhi"))
    near = a.join(b, ["label", "dim", "key"]).filter(
        (F.col("ac") != F.col("key")) | (F.col("a") <= F.col("b")))
    gaps = F.zip_with(F.zip_with("alo", "bhi", lambda x, y: x - y),
                      F.zip_with("blo", "ahi", lambda x, y: x - y),
                      lambda x, y: F.greatest(x, y, F.lit(0.0)))
    near = near.filter(F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= eps * eps)
    pairs = near.select("a", "b", "dim")
    for s in ("a", "b"):
        pairs = pairs.join(blocks.select(F.col("block").alias(s), F.col("cls").alias(f"cls_{s}"),
                                         F.col("copies").alias(f"copies_{s}"),
                                         F.col("vecs").alias(f"vecs_{s}")), s)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    linked = cut_lineage(_linked(pairs.repartition(n, "a", "b"), bases, least, eps,
                                 _packed(classes)))
    counts = linked.filter("v IS NULL").groupBy(F.col("u").alias("cls")).agg(F.sum("n").alias("others"))
    comp = connected_components(linked.filter("v IS NOT NULL").select("u", "v"))
    named = (classes.select("cls", "copies", "first_id")
             .join(comp.withColumnRenamed("node", "cls"), "cls", "left")
             .join(counts, "cls", "left")
             .select("cls", "first_id", F.coalesce("component", "cls").alias("component"),
                     (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    least_id = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_class = named.join(least_id, "component").select("cls", "n_links", "component_id")
    return (keyed.select("vec_id", "cls").join(by_class, "cls", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
