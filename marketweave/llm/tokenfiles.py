"""Token ids as flat binary files with 64-bit document offsets.

Format, per shard: ``<name>.bin`` holds the ids of its documents one after another as
little-endian unsigned integers (16 bits when the vocabulary fits, else 32); ``<name>.idx``
holds 64-bit little-endian offsets in ids, one more than there are documents; ``<name>.doc``
holds the 64-bit document ids. Shards follow each other in ascending order of document id;
the shard's base (ids in all shards before it) comes from a prefix sum over the manifest, one
row per shard, so ``base + offset`` is a document's place in the whole sequence.

A shard is written under a name of its own by each task attempt, and only the names that the
successful attempts report enter the manifest: a lost executor or a repeated task leaves an
orphan file, never a mixed one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketweave.llm import words as wd
from marketweave.llm.bpe import library_encoder, read_spec
from marketweave.session import checkpoint_dir

MANIFEST = ("name string, width int, n_docs long, n_null long, n_tokens long")


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None = 2,
                      shards: int | None = None) -> DataFrame:
    """Write the token files of ``docs`` under ``folder`` and return the manifest
    ``(shard, name, width, n_docs, n_null, n_tokens, base)``.

    Every text is encoded whole by the tokenizers library (null: empty) and ``end_id`` ends
    each document. Order is ascending document id, null ids first, equal ids by a hash of
    the text; repeated rows are written each. An empty table gives an empty manifest; other
    columns are ignored. ``doc_id`` must be an integer column.
    """
    spark = docs.sparkSession
    spec = read_spec(tokenizer_path)
    shared = spark.sparkContext.broadcast(spec)
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = library_encoder(shared.value)
        own_fs, own_root = filesystem(folder)
        first = next(batches, None)
        if first is None:
            return
        name = f"shard-{uuid.uuid4().hex}"
        width = 2 if max(vocabulary_size(shared.value), (end_id or 0) + 1) <= 1 << 16 else 4
        n_docs = n_null = n_tokens = 0
        with own_fs.open_output_stream(f"{own_root}/{name}.bin") as ids_out, \
                own_fs.open_output_stream(f"{own_root}/{name}.idx") as idx_out, \
                own_fs.open_output_stream(f"{own_root}/{name}.doc") as doc_out:
            idx_out.write(np.zeros(1, "<i8").tobytes())
            batch = first
            while batch is not None:
                key = batch.column(0)
                n_null += key.null_count
                doc_out.write(key.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
                              .astype("<i8").tobytes())
                for _, _, raw, off in wd.chunks(batch.column(1)):
                    ids, ends = enc.encode(raw, off)
                    if end_id is not None:
                        ids = np.insert(ids, ends[1:], end_id)
                        ends = ends + np.arange(len(ends))
                    ids_out.write(ids.astype(f"<u{width}").tobytes())
                    idx_out.write((ends[1:] + n_tokens).astype("<i8").tobytes())
                    n_docs += len(ends) - 1
                    n_tokens += len(ids)
                batch = next(batches, None)
        yield pa.RecordBatch.from_pydict({
            "name": [name], "width": pa.array([width], pa.int32()), "n_docs": [n_docs],
            "n_null": [n_null], "n_tokens": [n_tokens]})

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    written = (docs.select("doc_id", "text").repartitionByRange(n, *order)
               .sortWithinPartitions(*order).mapInArrow(run, MANIFEST)
               .withColumn("shard", F.spark_partition_id()).collect())  # one row per shard
    written.sort(key=lambda r: r["shard"])
    bases = [0, *accumulate(r["n_tokens"] for r in written)]
    rows = [(i, r["name"], r["width"], r["n_docs"], r["n_null"], r["n_tokens"], b)
            for i, (r, b) in enumerate(zip(written, bases))]
    return spark.createDataFrame(rows, f"shard int, {MANIFEST}, base long")


def vocabulary_size(spec: str) -> int:
    import json

    s = json.loads(spec)
    return 1 + max([*s["model"]["vocab"].values(), *(t["id"] for t in s.get("added_tokens", []))])


def map_array(fs: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """The file as a read-only array: memory-mapped where the store is a mounted path."""
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if fs.get_file_info(path).size else \
            np.zeros(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype=dtype)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document in the shards of ``manifest``;
    ``ids`` are little-endian unsigned 32-bit integers. One task reads one shard or more,
    in runs of about a megabyte."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for batch in batches:
            for s in batch.to_pylist():
                path = f"{root}/{s['name']}"
                ids = map_array(fs, path + ".bin", f"<u{s['width']}")
                idx = map_array(fs, path + ".idx", "<i8")
                doc = map_array(fs, path + ".doc", "<i8")
                a = 0
                while a < s["n_docs"]:
                    b = max(a + 1, int(np.searchsorted(idx, idx[a] + (wd.CHUNK_BYTES >> 2), "right")) - 1)
                    b = min(b, s["n_docs"], a + 10_000)
                    own = np.ascontiguousarray(ids[idx[a]:idx[b]]).astype("<u4")
                    at = (idx[a:b + 1] - idx[a]).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.array(doc[a:b]), mask=np.arange(a, b) < s["n_null"]),
                        pa.array(np.array(idx[a:b]) + s["base"]), pa.array(np.diff(at)),
                        pa.Array.from_buffers(pa.binary(), b - a, [
                            None, pa.py_buffer((at * 4).astype(np.int32)),
                            pa.py_buffer(own.view(np.uint8))])],
                        ["doc_id", "start", "n_tokens", "ids"])
                    a = b

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n, "shard").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder, as a URI."""
    d = checkpoint_dir(spark).rstrip("/")
    return f"{d if '://' in d or d.startswith('file:') else 'file://' + d}/tokens-{uuid.uuid4().hex}"
