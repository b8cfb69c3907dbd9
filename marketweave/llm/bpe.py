"""Byte-level BPE by a tokenization automaton: encoding and decoding.

``MergeAutomaton`` is the deterministic automaton over vocabulary tokens that accepts exactly
the token sequences the ordered merges produce. It is compiled by one gadget per merge
``(u, v) -> w``: the state reached by ``u`` loses its arc ``v``; every state with an arc ``u``
gets an arc ``w``; the state reached by ``w`` is a copy of the one ``v`` reaches at that
moment. States are kept copy-on-write (origin, moment, removed arcs), so compiling costs one
step per merge and a transition looks through the copies once and is then a table entry.

Every prefix of a word has one accepted path, so a word is encoded left to right with one
table look-up per vocabulary token that ends at a position. Texts are pre-split whole
batches at a time with numpy; the words of a batch are named by hash, encoded once and
gathered. Decoding concatenates the bytes each arc stands for.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketweave.llm import words as wd
from marketweave.llm.common import give_back, small_batches

# Words (about 40 bytes each) and transitions (about 120) kept by a worker before a table is
# started anew, and the bytes of text worked through at once.
TABLE_WORDS = 1_000_000
TABLE_STEPS = 500_000
RUN_BYTES = 1 << 18
SPACE, LETTER, NUMBER, OTHER = 3, 1, 2, 0
# The code points Unicode gives the property White_Space.
WHITE_SPACE = (0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002,
               0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000)
_classes: np.ndarray | None = None


def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    global _classes
    if _classes is None:
        kinds = {"L": LETTER, "N": NUMBER}
        cls = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER)
                        for c in range(0x110000)], dtype=np.uint8)
        cls[list(WHITE_SPACE)] = SPACE
        _classes = cls
    return _classes


def split_points(cp: np.ndarray, segment_start: np.ndarray) -> np.ndarray:
    """Start flags of the pre-split words of code points ``cp``; ``segment_start`` flags the
    first code point of each text (and of each part around a special token).

    The rule: runs of letters, numbers, white space or other characters; one space before a
    run belongs to it; the last character of a white-space run before anything else stands
    apart from the run; an apostrophe that begins a word takes s, t, m, d, re, ve or ll."""
    n = len(cp)
    if n == 0:
        return np.zeros(0, dtype=bool)
    k = char_classes()[cp]
    flag = segment_start.copy()
    flag[1:] |= k[1:] != k[:-1]
    joined = np.zeros(n, dtype=bool)  # i and i + 1 lie in one text
    joined[:-1] = ~segment_start[1:]
    last = np.flatnonzero((k[:-1] == SPACE) & (k[1:] != SPACE) & joined[:-1])
    flag[last] = True
    flag[last[cp[last] == 0x20] + 1] = False
    q = np.flatnonzero((cp[:-1] == 0x27) & flag[:-1] & joined[:-1])
    if len(q):
        a = cp[q + 1]
        two = (q + 2 < n) & joined[q + 1]
        b = np.where(two, cp[np.minimum(q + 2, n - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        pair = (((a == ord("r")) | (a == ord("v"))) & (b == ord("e"))) | (
            (a == ord("l")) & (b == ord("l")))
        for hit, size in ((one, 1), (pair, 2)):
            at = q[hit]
            flag[at + 1] = False
            after = at + 1 + size
            ok = after < n
            ok[ok] &= joined[after[ok] - 1]
            flag[after[ok]] = True
    return flag


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in a byte-level vocabulary: printable Latin-1 bytes
    stand for themselves, the others take the code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary(spec: dict) -> tuple[dict[str, int], dict[int, bytes]]:
    """``(special, bytes_of)`` of a byte-level BPE file: special tokens by their text, and the
    bytes every token id stands for."""
    alphabet = byte_alphabet()
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    bytes_of = {i: bytes(alphabet[c] for c in t) for t, i in spec["model"]["vocab"].items()
                if t not in special}
    return special, bytes_of | {i: t.encode() for t, i in special.items()}


class MergeAutomaton:
    """The tokenization automaton of a byte-level BPE file (its JSON text). Pairs of a state and an
    arc are packed into one number."""

    START = -1

    def __init__(self, text: str):
        spec = json.loads(text)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special, self.bytes_of = vocabulary(spec)
        self.id_of = {b: i for i, b in self.bytes_of.items() if i not in self.special.values()}
        self.longest = max(map(len, self.id_of), default=0)
        size = max(self.bytes_of, default=0) + 1
        # a state per token: the state it copies, the token its arc extends, and when
        self.origin, self.stem, self.made = ([0] * size for _ in range(3))
        self.alive = [False] * size
        for i, b in self.bytes_of.items():
            self.alive[i] = len(b) == 1 and i not in self.special.values()
        self.removed: dict[int, int] = {}
        self.table: dict[int, bool] = {}
        for moment, rule in enumerate(spec["model"]["merges"], 1):
            left, right = rule.split(" ") if isinstance(rule, str) else rule
            self._gadget(vocab[left], vocab[right], vocab[left + right], moment)
        self.end = len(spec["model"]["merges"]) + 1

    def _gadget(self, u: int, v: int, w: int, moment: int) -> None:
        """Compile the merge ``u v -> w`` into the automaton as it is at ``moment``."""
        if not (self.alive[u] and self.alive[v]) or not self._arc(u, v, moment - 1):
            return  # no accepted sequence holds u v any more
        if self.alive[w]:
            raise ValueError(f"token {w} is the result of two merges")
        self.removed[u << 32 | v] = moment
        self.origin[w], self.stem[w], self.made[w], self.alive[w] = v, u, moment, True

    def _arc(self, p: int, y: int, moment: int) -> bool:
        """Whether state ``p`` has the arc ``y`` after the gadgets up to ``moment``."""
        while True:
            if p == self.START:
                return True
            cut = self.removed.get(p << 32 | y)
            if cut is not None and cut <= moment:
                return False
            mp, my = self.made[p], self.made[y]
            if mp == 0 and my == 0:
                return True
            if mp > my:  # the arc was copied from p's origin
                p, moment = self.origin[p], mp - 1
            elif mp < my:  # the arc was added beside that of y's first part
                if p == self.stem[y] == self.origin[y]:
                    return False  # u before w = u u would have merged the other way
                y, moment = self.stem[y], my - 1
            else:  # y after itself: w's state is a copy of its origin's
                p, y, moment = self.origin[p], self.stem[y], mp - 1

    def step(self, p: int, y: int) -> bool:
        key = p << 32 | y
        ok = self.table.get(key)
        if ok is None:
            if len(self.table) >= TABLE_STEPS:
                self.table.clear()
            ok = self.table[key] = self._arc(p, y, self.end)
        return ok

    def encode_word(self, word: bytes) -> list[int]:
        """Token ids of one pre-split word: the accepted path, found from its last arc; a
        prefix is resolved only when an arc that may follow it is tried."""
        n = len(word)
        last: list[int | None] = [self.START] + [None] * n  # last arc of each prefix's path
        if n > 400:
            for i in range(1, n):
                self._resolve(word, i, last)
        i, out = n, []
        while i:
            t = last[i]
            if t is None:
                t = self._resolve(word, i, last)
            out.append(t)
            i -= len(self.bytes_of[t])
        return out[::-1]

    def _resolve(self, word: bytes, i: int, last: list[int | None]) -> int:
        id_of, table = self.id_of, self.table
        for j in range(max(0, i - self.longest), i):
            t = id_of.get(word[j:i])
            if t is None or not self.alive[t]:
                continue
            p = last[j]
            if p is None:
                p = self._resolve(word, j, last)
            ok = table.get(p << 32 | t)
            if ok or (ok is None and self.step(p, t)):
                last[i] = t
                return t
        raise ValueError(f"no path for {word[:i]!r}: a byte is not in the vocabulary")

    def encode_words(self, texts: list[str]) -> list[list[int]]:
        return [[self.special[t]] if t in self.special else self.encode_word(t.encode())
                for t in texts]


class BatchEncoder:
    """Encodes runs of texts: pre-split all at once, each distinct word encoded once."""

    def __init__(self, encode_words: Callable[[list[str]], list[list[int]]],
                 special: tuple[str, ...]):
        self.encode_words, self.special = encode_words, special
        self._reset()

    def _reset(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)  # hashes of the words met, in order
        self.slot = np.zeros(0, dtype=np.int32)  # where ``start`` has each of them
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.start = np.zeros(1 << 14, dtype=np.int64)  # one entry more than there are words

    def _add(self, texts: list[str]) -> None:
        """Append the ids of words behind those of the words met so far."""
        n = len(self.known)
        encoded = self.encode_words(texts)
        ends = int(self.start[n]) + np.cumsum([len(ids) for ids in encoded])
        while n + len(texts) >= len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        while ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[int(self.start[n]):int(ends[-1])] = [t for ids in encoded for t in ids]
        self.start[n + 1:n + 1 + len(texts)] = ends

    def _slots(self, hashes: np.ndarray, texts: Callable[[np.ndarray], list[str]]) -> np.ndarray:
        """The slots of words by their sorted distinct hashes; ``texts`` gives those of some of them."""
        if len(self.known) + len(hashes) > TABLE_WORDS:
            self._reset()
        at = np.searchsorted(self.known, hashes)
        met = at < len(self.known)
        met[met] = self.known[at[met]] == hashes[met]
        out = np.empty(len(hashes), dtype=np.int32)
        out[met] = self.slot[at[met]]
        new = np.flatnonzero(~met)
        if len(new):
            self._add(texts(new))
            out[new] = len(self.known) + np.arange(len(new), dtype=np.int32)
            self.known = np.insert(self.known, at[new], hashes[new])
            self.slot = np.insert(self.slot, at[new], out[new])
        return out

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of the texts in the UTF-8 bytes ``raw``."""
        text = raw.tobytes().decode("utf-8")
        cp = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        if not len(cp):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offsets]
        seg = np.zeros(len(cp), dtype=bool)
        seg[chars[:-1][chars[:-1] < len(cp)]] = True
        held = []
        for s in self.special:
            at = text.find(s)
            while at >= 0:
                if not seg[at + 1:at + len(s)].any():
                    held.append((at, at + len(s)))
                    at = text.find(s, at + len(s))
                else:
                    at = text.find(s, at + 1)
        for a, b in held:
            seg[a] = True
            if b < len(cp):
                seg[b] = True
        flag = split_points(cp, seg)
        for a, b in held:
            flag[a + 1:b] = False
        start = np.flatnonzero(flag)
        length = np.diff(np.append(start, len(cp)))
        pos = np.arange(len(cp)) - np.repeat(start, length)
        with np.errstate(over="ignore"):
            v = (cp.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            v ^= v >> np.uint64(32)
            h = wd.mix(np.add.reduceat(v * wd.powers(int(length.max()))[pos], start))
        uniq, where, inverse = np.unique(h, return_index=True, return_inverse=True)
        word = self._slots(uniq, lambda new: [
            text[a:a + n] for a, n in zip(start[where[new]].tolist(), length[where[new]].tolist())])[inverse]
        ids, ends = gather(self.flat, self.start, word)
        first_word = np.searchsorted(start, chars)
        return ids, np.concatenate([[0], ends])[first_word]


def gather(flat: np.ndarray, start: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated entries ``flat[start[i]:start[i + 1]]`` for ``i`` in ``pick``, and the
    end of each in the result."""
    length = start[pick + 1] - start[pick]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(start[pick] - (ends - length), length)
    return flat[shift + np.arange(total)], ends


_encoders: dict[tuple[str, str], BatchEncoder] = {}
_decoders: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def automaton_encoder(spec: str) -> BatchEncoder:
    """The worker's encoder for a tokenizer file's JSON text, driven by the automaton."""
    key = ("automaton", spec)
    if key not in _encoders:
        m = MergeAutomaton(spec)
        _encoders[key] = BatchEncoder(m.encode_words, tuple(m.special))
    return _encoders[key]


def library_encoder(spec: str) -> BatchEncoder:
    """The same with the tokenizers library encoding the pre-split words."""
    key = ("library", spec)
    if key not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(spec)
        t.no_truncation()
        t.no_padding()
        special = tuple(x["content"] for x in json.loads(spec).get("added_tokens", []))
        _encoders[key] = BatchEncoder(
            lambda ws: [e.ids for e in t.encode_batch_fast(ws, add_special_tokens=False)], special)
    return _encoders[key]


def byte_table(spec: str) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, start)``: what each arc label stands for, by token id."""
    if spec not in _decoders:
        _, own = vocabulary(json.loads(spec))
        parts = [own.get(i, b"") for i in range(max(own) + 1)]
        _decoders[spec] = (np.frombuffer(b"".join(parts), dtype=np.uint8),
                           np.concatenate([[0], np.cumsum([len(p) for p in parts])]))
    return _decoders[spec]


def read_spec(path: str) -> str:
    """The JSON text of a tokenizer file (a fixed vocabulary, not data: a few MB)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def binary_rows(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary array with one entry per row from its bytes and int64 row offsets."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` for every row of ``docs``: the whole text's token ids as
    little-endian unsigned 32-bit integers.

    Null and empty texts have no ids; repeated rows and null ids stay rows; other columns
    are ignored; an empty table gives no rows. A batch is worked through in runs of at
    most ``RUN_BYTES`` (a longer text alone), whatever the size of the batch.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what earlier tasks of this worker left
        enc = automaton_encoder(shared.value)
        for batch in batches:
            key = batch.column(0)
            for a, b, raw, off in wd.chunks(batch.column(1), RUN_BYTES):
                ids, ends = enc.encode(raw, off)
                yield pa.RecordBatch.from_arrays(
                    [key.slice(a, b - a), pa.array(np.diff(ends)),
                     binary_rows(ids.astype("<u4").view(np.uint8), ends * 4)],
                    ["doc_id", "n_tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)``: the text the ids of ``encode_documents`` stand
    for; bytes that are not UTF-8 become U+FFFD. Null ids decode to the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, start = byte_table(shared.value)
        for batch in batches:
            ids = batch.column(2).fill_null(b"")
            out = []
            for row in ids:
                own = np.frombuffer(row.as_buffer(), dtype="<u4").astype(np.int64)
                out.append(gather(flat, start, own)[0].tobytes().decode("utf-8", "replace"))
                if sum(map(len, out[-64:])) > wd.CHUNK_BYTES or len(out) == 512:
                    a = len(out)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(i).slice(0, a) for i in range(3)] + [pa.array(out, pa.string())],
                        ["doc_id", "n_tokens", "ids", "decoded"])
                    batch, out = batch.slice(a), []
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(3)] + [pa.array(out, pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids binary, decoded string")
