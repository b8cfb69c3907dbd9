"""BPE round trip and token files against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketweave.llm import bpe, queries, tokenfiles
from tests.conftest import SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, dtype="<u4")


def test_char_classes_agree_with_the_library(library):
    """A code point after a letter, a digit and a symbol splits as its class says."""
    split = library.pre_tokenizer.pre_tokenize_str
    cls = bpe.char_classes()
    for c in [*range(0x80, 0x3000, 7), *range(0x3000, 0x11000, 97), 0x1F600, 0x1E900, 0x16FE0]:
        if 0xD800 <= c < 0xE000:
            continue
        parts = len(split("a" + chr(c) + "b"))
        assert (parts == 1) == (cls[c] == bpe.LETTER), hex(c)


def test_automaton_paths_are_the_merges(library):
    m = bpe.MergeAutomaton(bpe.read_spec(PATH))
    assert sum(m.alive) == len(m.id_of)
    for w in ("hello", "aaaaaaa", "   ", "antidisestablishmentarianism", "zq" * 300, "éè"):
        got = m.encode_word(w.encode())
        assert b"".join(m.bytes_of[i] for i in got) == w.encode()
        assert got == ids_of(library, w).tolist()


def test_tables_started_anew_give_the_same_ids(library, documents, monkeypatch):
    """Words met, transitions kept and the run of bytes change no id."""
    monkeypatch.setattr(bpe, "TABLE_STEPS", 50)
    m = bpe.MergeAutomaton(bpe.read_spec(PATH))
    texts = [t or "" for _, t, _ in documents[:60]] + ["", "é 中 文<s>x", " " * 9, "a" * 3000]
    for table in (1, 40, 10**6):
        monkeypatch.setattr(bpe, "TABLE_WORDS", table)
        enc = bpe.BatchEncoder(m.encode_words, tuple(m.special))
        for size in (1, 7, len(texts)):
            for a in range(0, len(texts), size):
                raw = [t.encode() for t in texts[a:a + size]]
                off = np.cumsum([0, *map(len, raw)])
                ids, ends = enc.encode(np.frombuffer(b"".join(raw), dtype=np.uint8), off)
                for k, t in enumerate(texts[a:a + size]):
                    assert ids[ends[k]:ends[k + 1]].tolist() == ids_of(library, t).tolist()
        assert len(m.table) <= 50 and (np.diff(enc.known.astype(object)) > 0).all()


def test_roundtrip_equals_library(spark, library, documents):
    rows = queries.QUERIES["op6_bpe_roundtrip"](spark, SMALL).collect()
    want = {i: ids_of(library, t) for i, t, _ in documents}
    assert len(rows) == len(documents)
    for r in rows:
        ids = want[r["doc_id"]]
        text = library.decode(ids.tolist(), skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_roundtrip_odd_rows(odd_docs, odd_rows, no_docs, library):
    out = bpe.decode_documents(bpe.encode_documents(odd_docs, PATH), PATH)
    got = sorted((r["doc_id"] or 0, bytes(r["ids"]), r["decoded"]) for r in out.collect())
    assert got == sorted((i or 0, ids_of(library, t).tobytes(), t or "") for i, t, _ in odd_rows)
    assert bpe.decode_documents(bpe.encode_documents(no_docs, PATH), PATH).count() == 0


def check_files(rows, texts, library):
    """``texts``: (doc_id, text) in file order; equal ids may stand in any order."""
    rows = sorted(rows, key=lambda r: r["start"])
    at, n = 0, 0
    assert [r["doc_id"] for r in rows] == [i for i, _ in texts]
    left = [(i, np.append(ids_of(library, t), [2]).astype("<u4")) for i, t in texts]
    for r in rows:
        assert r["start"] == at
        crc = r["ids_crc32"] if "ids_crc32" in r else zlib.crc32(bytes(r["ids"]))
        match = next(k for k, (i, ids) in enumerate(left)
                     if i == r["doc_id"] and zlib.crc32(ids.tobytes()) == crc)
        ids = left.pop(match)[1]
        assert r["n_tokens"] == len(ids)
        at += len(ids)
        n += 1
    assert not left and n == len(texts)


def test_token_files_equal_library(spark, documents, library):
    rows = queries.QUERIES["op5_token_files"](spark, SMALL).collect()
    check_files([r.asDict() for r in rows], sorted((i, t) for i, t, _ in documents), library)


def test_token_files_odd_rows(spark, odd_docs, odd_rows, no_docs, library):
    folder = tokenfiles.scratch_folder(spark)
    manifest = tokenfiles.write_token_files(odd_docs, folder, PATH, shards=5)
    assert manifest.selectExpr("sum(n_docs) n").first()["n"] == len(odd_rows)
    rows = [r.asDict() for r in tokenfiles.read_token_files(manifest, folder).collect()]
    texts = sorted(((i, t) for i, t, _ in odd_rows), key=lambda x: (x[0] is not None, x[0] or 0))
    check_files(rows, texts, library)
    empty = tokenfiles.write_token_files(no_docs, folder, PATH)
    assert tokenfiles.read_token_files(empty, folder).count() == 0
