"""Small column helpers the training-data operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketweave.session import cut_lineage, scratch_path
from marketweave.sources import folders

# A word is a maximal run of characters other than ASCII space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of ``text`` (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(*cols: Column) -> Column:
    """A reproducible number in (0, 1) from the columns' text, equal in any SQL engine:
    the first 52 bits of the MD5 of the '|'-joined texts (null: '-')."""
    key = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in cols])
    bits = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str, tasks: int | None = None) -> DataFrame:
    """Deal rows by a hash of ``keys`` over at least ``tasks`` partitions (default: the
    session's shuffle partitions) before CPU-heavy work on few or uneven input splits."""
    n = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


# Ids that may be broadcast to pick rows of a large table (8 bytes each).
BROADCAST_IDS = 250_000


def rows_of(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``ids(key)``: a broadcast of at most
    ``BROADCAST_IDS`` ids (counted first), so the wide rows stay where they are, and a shuffled
    semi join beyond. ``ids`` should be cheap to read twice (a checkpoint)."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, key, "left_semi")


BATCH_BYTES = 4 << 20
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound what travels to a Python worker at once to ``BATCH_BYTES`` (session setting, only
    ever lowered), for operators whose rows hold texts."""
    now = spark.conf.get(_ARROW_BYTES, None)
    if now is not None and int(now.lower().rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_ARROW_BYTES, str(BATCH_BYTES))


def give_back() -> None:
    """Hand memory that this worker no longer uses back to the system. Workers serve one task after
    another and their allocators keep what the largest one took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of GNU systems has it
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, giving memory back when a task ends."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What runs inside gives its shuffle files back when it ends, not when the driver happens to
    collect its garbage: for plans whose result is stored and that are run only once."""
    before = spark.conf.get(_FREED, "false")
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """A checkpoint of ``df`` that leaves no shuffle files behind."""
    with shuffles_freed(df.sparkSession):
        return cut_lineage(df)


class Shelf:
    """Intermediate tables of a loop: each is written once under the shared checkpoint folder,
    compressed, and read back from there, so lineage is cut and a lost executor costs nothing
    but its running tasks. ``clear`` deletes what later rounds do not need."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.held: list[tuple[DataFrame, str]] = []

    def put(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "shelf")
        # small row groups: a writer buffers a whole one
        with shuffles_freed(self.spark):
            df.write.option("compression", "snappy").option("parquet.block.size", str(8 << 20)).parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((back, path))
        return back

    def clear(self, *keep: DataFrame) -> None:
        """Delete all tables but ``keep`` (as ``put`` returned them); nothing that is still to be
        computed may read the others."""
        gone = [(d, p) for d, p in self.held if not any(d is k for k in keep)]
        self.held = [(d, p) for d, p in self.held if any(d is k for k in keep)]
        for _, path in gone:
            folders.remove(self.spark, path)
