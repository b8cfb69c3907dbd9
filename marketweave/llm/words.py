"""Words and word shingles of Arrow text batches as numpy arrays, whole batches at a time.

Texts are read from the Arrow buffers without building Python strings. A word is a maximal
run of bytes other than space and 0x09-0x0D, so UTF-8 text splits exactly at the ASCII
separators. Words and shingles are named by 64-bit hashes (polynomial over random odd
powers, mixed); equal words have equal hashes on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _rng.integers(1, 1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd constant modulo 2**64."""
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            p = np.full(max(n, 1024), _BASE, dtype=np.uint64)
            p[0] = 1
            _powers = np.multiply.accumulate(p)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64 constants), so nearby sums spread."""
    h = h.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    return h


def text_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string array; null texts have no bytes."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    arr = arr.cast(pa.large_string())
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def chunks(arr: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows ``[a, b)`` of at most ``limit`` bytes (one longer text stands alone)
    with their bytes and their row offsets into those bytes."""
    raw, offsets = text_buffers(arr)
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b, raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = False, is_word: np.ndarray = _IS_WORD):
    """``(hash, start, end, first)``: per word its hash and byte range, per row the index of
    its first word (``first`` has one entry more than there are rows). ``is_word`` says of
    each byte whether it belongs to words."""
    is_word = is_word[raw]
    begin = is_word.copy()
    begin[1:] &= ~is_word[:-1]
    cut = offsets[:-1][offsets[:-1] < len(raw)]
    begin[cut] |= is_word[cut]
    start = np.flatnonzero(begin)
    first = np.searchsorted(start, offsets)
    at = np.flatnonzero(is_word)
    if not len(at):
        z = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), z, z, first
    head = np.searchsorted(at, start)
    length = np.diff(np.append(head, len(at)))
    pos = np.arange(len(at)) - np.repeat(head, length)
    chars = raw[at]
    if lower:
        chars = _LOWER[chars]
    with np.errstate(over="ignore"):
        h = np.add.reduceat(_BYTE[chars] * powers(int(length.max()))[pos], head)
    return mix(h), start, start + length, first


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(start, end)`` of the words of one text."""
    edge = np.diff(_IS_WORD[raw].astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def combine(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` neighbouring entries of ``h`` (``len(h) - n + 1``)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out += h[j:j + m] * _STEP[j]
    return mix(out)


def short_hash(h: np.ndarray) -> np.uint64:
    """One hash for a whole sequence shorter than a shingle."""
    with np.errstate(over="ignore"):
        return mix(np.array([(h * _STEP[:len(h)]).sum() + np.uint64(len(h))], dtype=np.uint64))[0]


def shingle_sets(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(members, start)``: the sorted distinct ``n``-word shingle hashes of every row one after
    another, and where each row's begin (one entry more than there are rows). ``h`` and
    ``first`` are those of ``words``; a row shorter than a shingle is one shingle, a row
    without words has none."""
    m = np.diff(first)
    count = np.where(m >= n, m - n + 1, np.minimum(m, 1))
    ends = np.cumsum(count)
    at = np.repeat(first[:-1] - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)
    every = np.zeros(len(h), dtype=np.uint64)
    run = combine(h, n)
    every[:len(run)] = run
    s = every[at]
    begin = ends - count
    for i in np.flatnonzero((m > 0) & (m < n)).tolist():
        s[begin[i]] = short_hash(h[first[i]:first[i + 1]])
    for a, b in zip(begin.tolist(), ends.tolist()):
        s[a:b].sort()
    keep = np.ones(len(s), dtype=bool)
    keep[1:] = s[1:] != s[:-1]
    keep[begin[count > 0]] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    return s[keep], total[np.append(begin, len(s))]
