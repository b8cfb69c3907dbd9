"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as zstandard frames of ``FRAME`` code points, each compressed on its own, with
the cumulative number of code points at the end of every frame. A cut at code point ``u`` is
found by bisection of those numbers, and only the frame that holds it is decompressed; whole
frames move to their new place as they are. The transformed text is again a row of frames
(their bytes one after another are one valid zstandard stream), read in order, one frame in
memory at a time, for digests and texts.

Everything happens inside rows: documents are never shuffled.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from marketweave.llm import words as wd
from marketweave.session import scratch_path

FRAME = 1 << 14
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"
FRAMES = "ends array<long>, frames array<binary>"
_FRAME_TYPES = [pa.list_(pa.int64()), pa.list_(pa.binary())]


class Frames:
    """A text as compressed frames; ``ends[i]`` is the number of code points up to and with
    frame ``i``."""

    packer, unpacker = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()

    def __init__(self, data: list[bytes] = (), ends: list[int] = ()):
        self.data, self.ends = list(data), list(ends)

    @classmethod
    def of(cls, text: str, frame: int = FRAME) -> Frames:
        parts = [text[i:i + frame] for i in range(0, len(text), frame)]
        return cls([cls.packer.compress(p.encode()) for p in parts],
                   list(accumulate(map(len, parts))))

    def __len__(self) -> int:
        return self.ends[-1] if self.ends else 0

    def open(self, k: int) -> str:
        return self.unpacker.decompress(self.data[k]).decode()

    def add(self, data: bytes, n: int) -> None:
        self.data.append(data)
        self.ends.append(len(self) + n)

    def add_text(self, text: str) -> None:
        if text:
            self.add(self.packer.compress(text.encode()), len(text))

    def _covering(self, a: int, b: int) -> Iterator[tuple[int, int, int]]:
        """``(frame, from, to)``: the frames that hold code points ``a`` to ``b`` and the
        stretch of each that does."""
        k = bisect_right(self.ends, a)
        while a < b:
            begin = self.ends[k - 1] if k else 0
            to = min(b, self.ends[k])
            yield k, a - begin, to - begin
            a, k = to, k + 1

    def copy_to(self, out: Frames, a: int, b: int) -> None:
        """Append code points ``a`` to ``b`` to ``out``: whole frames as they are, of cut ones
        the wanted part."""
        for k, x, y in self._covering(a, b):
            n = self.ends[k] - (self.ends[k - 1] if k else 0)
            if (x, y) == (0, n):
                out.add(self.data[k], n)
            else:
                out.add_text(self.open(k)[x:y])

    def stream(self, a: int = 0, b: int | None = None) -> Iterator[str]:
        """Code points ``a`` to ``b`` in order, at most one frame at a time."""
        for k, x, y in self._covering(a, len(self) if b is None else b):
            yield self.open(k)[x:y]

    def find(self, mark: str, a: int) -> int:
        """The first place of ``mark`` at or after code point ``a`` (-1: none)."""
        tail, done = "", a
        for piece in self.stream(a):
            at = (tail + piece).find(mark)
            if at >= 0:
                return done - len(tail) + at
            done += len(piece)
            tail = (tail + piece)[-(len(mark) - 1):]
        return -1


def digest(pieces: Iterable[str]) -> str:
    """Lowercase hex SHA-256 of the pieces' UTF-8."""
    h = hashlib.sha256()
    for p in pieces:
        h.update(p.encode())
    return h.hexdigest()


def draws(seed: int, doc_id) -> list[int]:
    """The first four 32-bit numbers of SHA-256 of ``seed:doc_id`` (a null id: ``seed:``)."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def transform(text: Frames, marked: bool, draw: list[int], plain_from: int = 90,
              spm_below: int = 20) -> tuple[str, int | None, int | None, Frames]:
    """``(form, prefix code points, middle code points, output)`` of one text."""
    n = len(text)
    if not n or marked or draw[2] % 100 >= plain_from:
        return PLAIN, None, None, text
    a, b = sorted((draw[0] % (n + 1), draw[1] % (n + 1)))
    prefix, middle, suffix = (PREFIX, 0, a), (MIDDLE, a, b), (SUFFIX, b, n)
    form, order = (SPM, (suffix, prefix, middle)) if draw[3] % 100 < spm_below else \
        (PSM, (prefix, suffix, middle))
    out = Frames()
    for mark, x, y in order:
        out.add_text(mark)
        text.copy_to(out, x, y)
    return form, a, b - a, out


def restore(out: Frames, form: str) -> Iterator[str]:
    """The text that ``out`` was made of, rebuilt from the output and its form alone."""
    if form == PLAIN:
        yield from out.stream()
        return
    marks = (PREFIX, SUFFIX, MIDDLE) if form == PSM else (SUFFIX, PREFIX, MIDDLE)
    at, where = 0, {}
    for m in marks:
        at = out.find(m, at)
        where[m] = at
        at += len(m)
    ends = dict(zip(marks, [*(where[m] for m in marks[1:]), len(out)]))
    for m in (PREFIX, MIDDLE, SUFFIX):
        yield from out.stream(where[m] + len(m), ends[m])


def _types(df: DataFrame, *names: str) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in names)


def store_frames(docs: DataFrame, path: str | None = None, frame: int = FRAME) -> DataFrame:
    """Store ``docs(doc_id, text)`` as frames at ``path`` (default: a new folder under the
    shared checkpoint folder) and return the stored table ``(doc_id, marked, ends, frames)``;
    ``marked`` says that the text holds one of the marks.

    A null text is empty, an empty one has no frames; repeated rows and null ids are stored as
    they come; other columns are ignored; an empty table is stored as an empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _, _ in wd.chunks(batch.column(1)):
                texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
                packed = [Frames.of(t, frame) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.array([any(m in t for m in MARKS) for t in texts], pa.bool_()),
                     pa.array([p.ends for p in packed], _FRAME_TYPES[0]),
                     pa.array([p.data for p in packed], _FRAME_TYPES[1])],
                    ["doc_id", "marked", "ends", "frames"])

    path = path or scratch_path(docs.sparkSession, "frames")
    (docs.select("doc_id", "text")
     .mapInArrow(run, f"{_types(docs, 'doc_id')}, marked boolean, {FRAMES}")
     .write.option("compression", "uncompressed").parquet(path))
    return docs.sparkSession.read.parquet(path)


def _rows(batch: pa.RecordBatch, limit: int = wd.CHUNK_BYTES) -> Iterator[tuple[int, list[dict]]]:
    """The batch's rows as dictionaries, in runs of about ``limit`` bytes of frames."""
    a, run, held = 0, [], 0
    for i in range(batch.num_rows):
        row = {c: batch.column(k)[i].as_py() for k, c in enumerate(batch.schema.names)}
        run.append(row)
        held += sum(map(len, row["frames"]))
        if held >= limit:
            yield a, run
            a, run, held = i + 1, [], 0
    if run:
        yield a, run


def fill_in_middle(stored: DataFrame, seed: int = 1, plain_from: int = 90,
                   spm_below: int = 20) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, ends, frames)`` for every row of a frame
    table: the text with its middle last, as frames.

    Cuts and form follow from ``seed`` and the id alone (a null id: one draw for all of them).
    An empty text, one that holds a mark and ``100 - plain_from`` of 100 draws stay plain
    (null lengths); of the others ``spm_below`` of 100 begin with the suffix.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, rows in _rows(batch):
                texts = [Frames(r["frames"], r["ends"]) for r in rows]
                done = [transform(t, r["marked"], draws(seed, r["doc_id"]), plain_from, spm_below)
                        for t, r in zip(texts, rows)]
                form, prefix, middle, out = zip(*done)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, len(rows)), pa.array(list(map(len, texts)), pa.int64()),
                     pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()),
                     pa.array([o.ends for o in out], _FRAME_TYPES[0]),
                     pa.array([o.data for o in out], _FRAME_TYPES[1])],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "ends", "frames"])

    return stored.select("doc_id", "marked", "ends", "frames").mapInArrow(
        run, f"{_types(stored, 'doc_id')}, n long, form string, prefix_chars long, "
             f"middle_chars long, {FRAMES}")


def _mapped(done: DataFrame, makes: list[tuple[str, object]]) -> DataFrame:
    """``done`` without its frames, with string columns made of (frames, form)."""
    kept = [c for c in done.columns if c not in ("ends", "frames")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, rows in _rows(batch):
                out = [Frames(r["frames"], r["ends"]) for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(a, len(rows)) for k in range(len(kept))]
                    + [pa.array([f(o, r["form"]) for o, r in zip(out, rows)], pa.string())
                       for _, f in makes], [*kept, *(name for name, _ in makes)])

    return done.select(*kept, "ends", "frames").mapInArrow(
        run, ", ".join([_types(done, *kept), *(f"{name} string" for name, _ in makes)]))


def with_digests(done: DataFrame) -> DataFrame:
    """The transformed rows with ``output_sha256`` and ``restored_sha256`` in place of their
    frames, which are streamed in order."""
    return _mapped(done, [("output_sha256", lambda out, form: digest(out.stream())),
                          ("restored_sha256", lambda out, form: digest(restore(out, form)))])


def with_texts(done: DataFrame) -> DataFrame:
    """The transformed rows with their ``output`` as one string in place of the frames."""
    return _mapped(done, [("output", lambda out, form: "".join(out.stream()))])
