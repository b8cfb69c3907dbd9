"""Large JSON-array files read by several tasks, split at record borders.

A file is cut into byte ranges. Whether a byte stands inside a string, and how deep, depends on
everything before it, so reading takes two passes:

1. every range is summed up on its own: the parity of its quotes, and the change of depth
   it makes if it begins outside and if it begins inside a string;
2. running sums over a file's ranges (one small row each) give every range its true state at
   its first byte; each task then finds the separators of the root array in its range and
   reads every record that begins there, beyond its end if need be.

Records are JSON texts that Spark parses on their own: a damaged one costs itself, and a file
that breaks off costs the record it broke off in. Ranges are read with ``pyarrow.fs``, so the
store must be one that it opens (local paths, HDFS, S3, GCS).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketweave.sources.json_io import CORRUPT_COL, as_text, typed

BLOCK_BYTES = 16 << 20
MAX_RECORD = 64 << 20  # a longer record counts as damaged; it is not held whole
BEYOND_BYTES = 4 << 10  # first read beyond a range for the record that is open at its end

_QUOTE, _BACKSLASH, _COMMA = b'"\\,'
_STEP = np.zeros(256, np.int8)
_STEP[list(b"[{")], _STEP[list(b"]}")] = 1, -1
_SPACE = b" \t\r\n"


class _File:
    """Byte ranges of one file; outside of it there are no bytes."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        self.size = self.file.size()

    def read(self, a: int, b: int) -> bytes:
        a, b = max(0, a), min(b, self.size)
        return self.file.read_at(b - a, a) if b > a else b""

    def escaped(self, at: int) -> bool:
        """Whether the byte at ``at`` follows an odd number of backslashes."""
        n, step = 0, 64
        while at > n:
            before = self.read(at - n - step, at - n)
            run = len(before) - len(before.rstrip(b"\\"))
            n += run
            if run < len(before):
                break
        return n % 2 == 1


def _quotes(raw: np.ndarray, escaped: bool) -> np.ndarray:
    """Places of the quotes that no backslash escapes."""
    at = np.flatnonzero(raw == _QUOTE)
    slash = raw == _BACKSLASH
    if not escaped and not slash.any():
        return at
    # length of the run of backslashes that ends right before each place
    last = np.where(slash, -1, np.arange(len(raw)))
    last = np.maximum.accumulate(np.concatenate([[-1], last]))[:-1]
    run = np.arange(len(raw)) - 1 - last
    run = run + np.where(last == -1, int(escaped), 0)
    return at[run[at] % 2 == 0]


def _outside(raw: np.ndarray, escaped: bool, inside: bool) -> tuple[np.ndarray, int]:
    """For every byte whether it stands outside strings, and the number of quotes."""
    q = _quotes(raw, escaped)
    flips = np.zeros(len(raw), np.int8)
    flips[q] = 1
    return (np.cumsum(flips) + int(inside)) % 2 == 0, len(q)


def _sum_up(files: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in files:
        for r in batch.to_pylist():
            f = _File(r["file"])
            data = f.read(r["begin"], r["end"])
            raw = np.frombuffer(data, np.uint8)
            out, n = _outside(raw, f.escaped(r["begin"]), False)
            step = _STEP[raw]
            root = f.read(0, 4096).lstrip(_SPACE)[:1].decode("latin-1") if r["begin"] == 0 else None
            yield pa.RecordBatch.from_pylist([r | {
                "quotes": n % 2, "out_step": int(step[out].sum()), "in_step": int(step[~out].sum()), "root": root}],
                schema=pa.schema([*batch.schema, ("quotes", pa.int32()), ("out_step", pa.int64()),
                                  ("in_step", pa.int64()), ("root", pa.string())]))


def _marks(raw: np.ndarray, escaped: bool, inside: bool, depth: int):
    """``(places, bytes, inside, depth)``: the separators of the root array in a stretch (its
    ends and the commas right inside it), and the state after it."""
    out, n = _outside(raw, escaped, inside)
    step = np.where(out, _STEP[raw], 0).astype(np.int64)
    after = depth + np.cumsum(step)
    root = out & (((raw == _COMMA) & (after == 1)) | ((step == 1) & (after == 1)) | ((step == -1) & (after == 0)))
    at = np.flatnonzero(root)
    return at, raw[at], (n + int(inside)) % 2 == 1, int(after[-1]) if len(raw) else depth


def _records(r: dict) -> Iterator[tuple[int, str | None, bool]]:
    """``(offset, text, whole)`` of the records that begin in a range with a known state; text
    None: too long, or nothing where a record must stand."""
    f = _File(r["file"])
    if r["root"] != "[":  # one value: the whole file is a record
        if r["begin"] == 0:
            data = f.read(0, MAX_RECORD + 1)
            yield 0, data.decode("utf-8", "replace") if len(data) <= MAX_RECORD else None, True
        return
    begin, end, inside, depth = r["begin"], r["end"], bool(r["inside"]), r["depth"]
    held, at, kind, first = b"", None, None, begin  # the open record: text so far, its place
    step = BEYOND_BYTES
    while first < f.size and (first < end or at is not None):
        last = end
        if first >= end:  # the rest of one record, however much follows it
            last, step = min(first + step, f.size), min(2 * step, BLOCK_BYTES)
        data = f.read(first, last)
        marks, kinds, inside, depth = _marks(np.frombuffer(data, np.uint8), f.escaped(first), inside, depth)
        here = 0
        for m, k in zip(marks.tolist(), kinds.tolist()):
            if at is not None:
                text = held + data[here:m]
                if text.strip(_SPACE):
                    yield at, text.decode("utf-8", "replace") if len(text) <= MAX_RECORD else None, \
                        kind != "]"
                elif not (kind == "[" and chr(k) == "]"):
                    yield at, None, True
            if first + m >= end:
                return
            held, at, kind, here = b"", first + m + 1, chr(k), m + 1
        if at is not None and len(held) <= MAX_RECORD:
            held += data[here:]
        first = last
    if at is not None and (held.strip(_SPACE) or kind != "]"):  # the file ends in it
        yield at, held.decode("utf-8", "replace") if kind != "]" and len(held) <= MAX_RECORD else None, False


def split_records(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(<folder columns>, file, offset, record, whole)``: every element of the root arrays under
    ``path`` as JSON text. ``record`` is null where none can be read, ``whole`` is false for
    what is not closed by a separator. A missing path gives no rows."""
    try:
        found = spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    own = [c for c in found.columns if c not in ("path", "modificationTime", "length", "content")]
    ranges = found.where("length > 0").select(*own, F.col("path").alias("file"), "length", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("length") - 1, F.lit(block_bytes).cast("long"))).alias("begin"))
    ranges = ranges.withColumn("end", F.least(F.col("begin") + block_bytes, "length")).drop("length")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema.fields)
    states = ranges.repartition(n, "file", "begin").mapInArrow(
        _sum_up, f"{kinds}, quotes int, out_step long, in_step long, root string")
    # a row per range: the state before it is the sum over the ranges before it
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    states = states.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    step = F.when(F.col("inside") == 1, F.col("in_step")).otherwise(F.col("out_step"))
    states = states.withColumn("depth", F.coalesce(F.sum(step).over(before), F.lit(0))).withColumn(
        "root", F.first("root").over(Window.partitionBy("file").orderBy("begin")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            for i, r in enumerate(batch.to_pylist()):
                found = iter(_records(r))
                while rows := [x for _, x in zip(range(10_000), found)]:
                    offset, text, whole = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.concat_arrays([batch.column(names.index(c)).slice(i, 1)] * len(rows)) for c in [*own, "file"]]
                        + [pa.array(offset, pa.int64()), pa.array(text, pa.string()), pa.array(whole, pa.bool_())],
                        [*own, "file", "offset", "record", "whole"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema.fields
                     if f.name not in ("begin", "end"))
    return states.select(*own, "file", "begin", "end", "root", "inside", "depth").repartition(
        n, "file", "begin").mapInArrow(read, f"{kept}, offset long, record string, whole boolean")


def scan_json_splits(spark: SparkSession, path: str, schema: T.StructType | str, keep_corrupt: bool = False,
                     partial: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``scan_json_records`` for files of any size: typed fields of every record, then the
    folders' columns. With ``partial`` the sound records of a damaged file are kept, without it
    such a file gives no rows, as one that does not parse. ``keep_corrupt`` adds damaged records
    (or, without ``partial``, all records of damaged files) with their text in ``_corrupt``."""
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    split = split_records(spark, path, block_bytes)
    own = [c for c in split.columns if c not in ("file", "offset", "record", "whole")]
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}
    # an object as it stands; an array would be read as its first element
    text = F.when(F.ltrim("record").startswith("{"), F.col("record"))
    rows = split.select(*own, "file", "record", "whole", F.from_json(
        text, as_text(st).add(CORRUPT_COL, T.StringType()), how).alias("_r"))
    rows = rows.withColumn("_ok", F.col("_r").isNotNull() & F.col(f"_r.{CORRUPT_COL}").isNull())
    if not partial:
        bad = rows.where("NOT (_ok AND whole)").select(F.col("file").alias("_bad")).distinct()
        rows = rows.join(bad, F.col("file") == F.col("_bad"), "left") \
            .withColumn("_ok", F.col("_ok") & F.col("_bad").isNull()).drop("_bad")
    fields = [F.when(F.col("_ok"), F.col(f"_r.{f.name}")).alias(f.name) for f in st.fields]
    rows = rows.select(*own, *fields, "_ok", F.when(~F.col("_ok"), F.coalesce("record", F.lit(""))).alias(CORRUPT_COL))
    if not keep_corrupt:
        rows = rows.where("_ok")
    return rows.select(*[typed(f) for f in st.fields], *own, *([CORRUPT_COL] if keep_corrupt else []))
