"""Keyed tables whose micro-batches rewrite only the key-hash buckets that they touch.

Layout: ``<path>/version=<batch id>/bucket=<b>/``. A version holds the new contents of the
buckets that its batch touched; Spark writes it under a staging folder and its ``_SUCCESS``
file publishes it. The current contents of a bucket are those of its newest published
version, so a reader sees a batch whole or not at all, and a batch that is run again reads
only older versions and rewrites its own folder.

Buckets hold equal shares of the distinct keys, whatever the keys are; their number should
give buckets of some 100 MB. ``vacuum`` deletes what newer versions have replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketweave.operators import tables as TB
from marketweave.sources import folders

BUCKETS = 64
BASE = -1  # the version that the initial contents get


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = BUCKETS

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def versions(self, before: int | None = None) -> list[int]:
        """Published versions (below ``before``), oldest first."""
        found = [int(v) for v in folders.partitions(self.spark, self.path, "version")]
        return sorted(v for v in found if (before is None or v < before)
                      and folders.exists(self.spark, f"{self._folder(v)}/_SUCCESS"))

    def places(self, before: int | None = None) -> dict[int, int]:
        """The newest version of every bucket."""
        at: dict[int, int] = {}
        for v in self.versions(before):
            at.update((int(b), v) for b in folders.partitions(self.spark, self._folder(v), "bucket"))
        return at

    def read(self, only: Iterable[int] | None = None, before: int | None = None) -> DataFrame:
        """The table (of the buckets ``only``): nothing but the folders that hold it is read."""
        newest = self.spark.read.parquet(f"{self._folder(self.versions(before)[-1])}/schema")
        at = self.places(before)
        wanted = sorted(at if only is None else at.keys() & set(only))
        if not wanted:
            return newest
        return self.spark.read.schema(newest.schema).parquet(
            *[f"{self._folder(at[b])}/bucket={b}" for b in wanted])

    def write(self, rows: DataFrame, version: int) -> None:
        """Publish ``rows`` as the contents of their buckets."""
        folder = self._folder(version)
        folders.remove(self.spark, folder)
        # the schema first: a version may have no rows, and columns only ever come on top
        rows.limit(0).write.parquet(f"{folder}/schema")
        (rows.withColumn("bucket", self.bucket()).repartition(self.buckets, "bucket")
         .write.mode("append").partitionBy("bucket").parquet(folder))

    def start(self, initial: DataFrame) -> None:
        """Store the initial contents, once."""
        if not folders.exists(self.spark, f"{self._folder(BASE)}/_SUCCESS"):
            self.write(initial, BASE)

    def touched(self, rows: DataFrame) -> tuple[DataFrame, list[int]]:
        """``rows`` with their keys in the table's types, and the buckets of those keys."""
        kinds = {f.name: f.dataType for f in self.read().schema.fields}
        rows = rows.withColumns({k: F.col(k).cast(kinds[k]) for k in self.keys})
        return rows, sorted(r["bucket"] for r in rows.select(self.bucket()).distinct().collect())

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete bucket folders that a newer version replaced, but for those which the ``keep``
        newest versions still need as the table stood then; returns what went."""
        versions = self.versions()
        needed = {(v, b) for last in versions[-keep:] for b, v in self.places(last + 1).items()}
        gone = []
        for v in versions:
            for b in folders.partitions(self.spark, self._folder(v), "bucket"):
                if (v, int(b)) not in needed:
                    gone.append(f"{self._folder(v)}/bucket={b}")
                    folders.remove(self.spark, gone[-1])
        return gone


def _merging_sink(table_path: str, keys: Sequence[str], initial: str, buckets: int,
                  merge: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = KeyedTable(spark, table_path, tuple(keys), buckets)
        table.start(spark.read.parquet(initial))
        batch.persist()  # read for its buckets and for the merge; recomputed if lost
        try:
            rows, own = table.touched(batch)
            if own:  # update mode has batches that only move the watermark
                table.write(merge(table.read(own, batch_id), rows), batch_id)
        finally:
            batch.unpersist()
    return sink


def upsert_sink(table_path: str, keys: Sequence[str], arrival: Sequence[str], as_of: str,
                initial: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """T03: a ``foreachBatch`` sink that merges each micro-batch into the buckets of its keys.
    ``initial`` is a stored table with the contents before the first batch."""
    return _merging_sink(table_path, keys, initial, buckets, lambda old, new: TB.upsert_merge(
        old, new, keys, arrival, as_of, with_action=False))


def insert_ignore_sink(table_path: str, keys: Sequence[str], order_by: Sequence[str],
                       initial: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """T03 for append-only kinds: the batch's first row of every key that its bucket does not
    hold yet is added."""
    return _merging_sink(table_path, keys, initial, buckets, lambda old, new: TB.insert_ignore(
        old, new, keys, order_by))
