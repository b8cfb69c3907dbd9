"""License scans: exact base phrases, and an exact set-similarity join of text blocks with
license templates.

A template is a set of tokens; a block is a run of ``2c`` words of a text that starts at a
multiple of ``c``, ``c`` being the template's number of words rounded up to a power of two, so
a template that stands in a text lies whole in a block. The join finds every pair with
``|T & B| >= share * |T|`` (the containment threshold ``alpha``). Tokens are ordered by their
number of places in all documents, rarest first, tokens of no template before all others
(they match nothing, so they only fill prefixes and are left out):

* length: a block with fewer than ``alpha`` template tokens is out;
* prefix: the first ``|T| - alpha + 1`` tokens of the template and ``|B| - alpha + 1`` of the
  block must share one, found through an index of the templates' prefixes;
* position: the tokens shared so far and those that can still follow must reach ``alpha``;
* what is left is counted in full.

The templates are bounded (``MAX_TEMPLATE_WORDS``, checked), so their index goes to every task
and the documents stay where they are: one pass counts tokens, one pass joins.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketweave.llm import words as wd

SHARE = (9, 10)
LEAST_STEP = 8
MAX_TEMPLATE_WORDS = 100_000
PIECE_BYTES = 1 << 20

PHRASES = (("mit", "under the mit license"), ("apache-2", "apache license version 2"),
           ("cc-by-nc", "cc by nc"))

# Notices that public licenses prescribe or that projects commonly use.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the "
            "Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain "
                 "a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, "
            "are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose "
            "with or without fee is hereby granted"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

# Word characters: 0-9, A-Z (lower-cased), a-z and everything beyond ASCII.
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def text_words(text: str) -> list[bytes]:
    """The words of one text, lower-cased (A-Z only)."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    edge = np.diff(_IS_WORD[raw].astype(np.int8), prepend=0, append=0)
    ends = zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())
    return [raw[a:b].tobytes().lower() for a, b in ends]


def block_step(n_words: int) -> int:
    """Words between the starts of the blocks that a template of ``n_words`` words meets."""
    return max(LEAST_STEP, 1 << max(0, n_words - 1).bit_length())


def _pieces(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A chunk as it is, or one long text in pieces that end at a separator."""
    if len(raw) <= 2 * PIECE_BYTES or len(offsets) != 2:
        yield raw, offsets
        return
    a = 0
    while a < len(raw):
        b = min(a + PIECE_BYTES, len(raw))
        while b < len(raw):
            stop = np.flatnonzero(~_IS_WORD[raw[b:b + PIECE_BYTES]])
            if len(stop):
                b += int(stop[0])
                break
            b = min(b + PIECE_BYTES, len(raw))
        yield raw[a:b], np.array([0, b - a])
        a = b


@dataclass
class Vocabulary:
    """The distinct words of the templates and phrases, by hash."""

    hashes: np.ndarray
    names: list[bytes]

    @classmethod
    def of(cls, found: list[bytes]) -> Vocabulary:
        names = sorted(set(found))
        text = np.frombuffer(b" ".join(names), dtype=np.uint8)
        h = wd.words(text, np.array([0, len(text)]), is_word=_IS_WORD)[0]
        order = np.argsort(h)
        return cls(h[order], [names[i] for i in order.tolist()])

    def places(self, raw: np.ndarray, offsets: np.ndarray):
        """``(row, place, token, n_words)``: where words of the vocabulary stand, in order, and
        the number of words of every row."""
        rows, places, tokens, total = [], [], [], np.zeros(len(offsets) - 1, np.int64)
        for piece, off in _pieces(raw, offsets):
            h, _, _, first = wd.words(piece, off, lower=True, is_word=_IS_WORD)
            at = np.searchsorted(self.hashes, h)
            at[at == len(self.hashes)] = 0
            hit = np.flatnonzero(self.hashes[at] == h) if len(self.hashes) else at[:0]
            row = np.searchsorted(first, hit, "right") - 1
            rows.append(row)
            places.append(hit - first[row] + total[row])
            tokens.append(at[hit])
            total += np.diff(first)
        return np.concatenate(rows), np.concatenate(places), np.concatenate(tokens), total


def token_counts(docs: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """Places of every vocabulary token in all texts: each task adds up its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(vocab.names), np.int64)
        for batch in batches:
            for _, _, raw, off in wd.chunks(batch.column(0)):
                n += np.bincount(vocab.places(raw, off)[2], minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])],
                                         ["token", "n"])

    out = np.zeros(len(vocab.names), np.int64)
    for r in docs.select("text").mapInArrow(run, "token int, n long").groupBy("token").agg(
            F.sum("n").alias("n")).collect():  # one row per vocabulary token at most
        out[r["token"]] = r["n"]
    return out


def _spans(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers ``begin[i] .. begin[i] + length[i] - 1`` of all ``i``, one after another."""
    ends = np.cumsum(length)
    return np.repeat(begin - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)


class TemplateIndex:
    """The templates of one block step: their sorted sets and the index of their prefixes."""

    def __init__(self, step: int, sets: list[tuple[int, np.ndarray]], share, n_tokens: int):
        num, den = share
        self.step, self.n_tokens = step, n_tokens
        self.template = np.array([t for t, _ in sets])
        self.size = np.array([len(s) for _, s in sets])
        self.alpha = -(-num * self.size // den)
        self.known = np.zeros(n_tokens, bool)
        entries = []
        for i, (_, s) in enumerate(sets):
            self.known[s] = True
            entries += [(int(t), i, j) for j, t in enumerate(s[:self.size[i] - self.alpha[i] + 1])]
        entries.sort()
        e = np.array(entries, dtype=np.int64).reshape(-1, 3)
        self.first = np.searchsorted(e[:, 0], np.arange(n_tokens + 1))
        self.owner, self.place = e[:, 1], e[:, 2]
        # every (template, token) pair as one number, for counting
        self.pairs = np.sort(np.concatenate([i * n_tokens + s for i, (_, s) in enumerate(sets)]))

    def join(self, row: np.ndarray, place: np.ndarray, rank: np.ndarray):
        """``(row, block, template, shared)`` of every block that meets the threshold, from the
        places of tokens given by their rank in the global order."""
        own = self.known[rank]
        row, block, rank = (np.concatenate([x[own]] * 2) for x in (row, place // self.step, rank))
        block[len(block) // 2:] -= 1
        at = np.lexsort((rank, block, row))
        at = at[block[at] >= 0]
        row, block, rank = row[at], block[at], rank[at]
        if not len(row):
            return (np.zeros(0, np.int64),) * 4
        new = np.r_[True, (np.diff(row) != 0) | (np.diff(block) != 0)]
        keep = new | np.r_[True, np.diff(rank) != 0]
        row, block, rank, new = row[keep], block[keep], rank[keep], new[keep]
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(row)))
        number = np.cumsum(new) - 1
        pos = np.arange(len(row)) - begin[number]
        # the index gives the templates with the token in their prefix
        fan = self.first[rank + 1] - self.first[rank]
        src = np.repeat(np.arange(len(row)), fan)
        entry = _spans(self.first[rank], fan)
        owner, i, j, b = self.owner[entry], self.place[entry], pos[src], number[src]
        least, left = self.alpha[owner], size[b] - j
        ok = (size[b] >= least) & (left >= least)  # length; the block's own prefix
        owner, i, b, left = owner[ok], i[ok], b[ok], left[ok]
        # position: shared prefix tokens so far, and what can follow the last of them
        at = np.lexsort((i, owner, b))
        owner, i, b, left = owner[at], i[at], b[at], left[at]
        if not len(b):
            return (np.zeros(0, np.int64),) * 4
        head = np.flatnonzero(np.r_[True, (np.diff(b) != 0) | (np.diff(owner) != 0)])
        last = np.append(head[1:], len(b)) - 1
        bound = last - head + np.minimum(self.size[owner[last]] - i[last], left[last])
        pick = last[bound >= self.alpha[owner[last]]]
        owner, b = owner[pick], b[pick]
        # count what is left in full
        length = size[b]
        pair = np.repeat(owner, length) * self.n_tokens + rank[_spans(begin[b], length)]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        hit = (self.pairs[at] == pair).astype(np.int64)
        shared = np.add.reduceat(hit, np.cumsum(length) - length) if len(length) else length
        ok = shared >= self.alpha[owner]
        return row[begin[b[ok]]], block[begin[b[ok]]], owner[ok], shared[ok]


SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, blocks array<struct<label string, first_word long, "
          "n_words long, shared int, size int>>")


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES,
         phrases: Sequence[tuple[str, str]] = PHRASES, share: tuple[int, int] = SHARE) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks)``
    for every row of ``docs(doc_id, text)``.

    ``n_base`` counts the places where the words of a phrase stand consecutively, ``first_word``
    and ``last_word`` are the smallest and largest of them (null: none). ``labels`` has the
    labels of phrases and of templates of which a block holds ``share`` of the words or more;
    ``blocks`` lists those blocks. ``score`` is the largest share found, 1 where a phrase
    stands, 0 where nothing was found.

    Null and empty texts have no words, empty labels and score 0; texts of any length are read
    whole, the longest in pieces; repeated rows and null ids give a row each; other columns are
    ignored; an empty table gives an empty result. Templates without words match nothing. A
    template whose words all stand in another's notice is labelled with it.
    """
    wanted = [(label, text_words(t)) for label, t in templates]
    wanted = [(label, w) for label, w in wanted if w]
    exact = [(label, text_words(t)) for label, t in phrases]
    every = [w for _, found in wanted + exact for w in found]
    if len(every) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words")
    vocab = Vocabulary.of(every)
    counts = token_counts(docs, vocab)
    order = np.lexsort((np.arange(len(counts)), counts))  # rarest first
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    number = {name: i for i, name in enumerate(vocab.names)}
    steps = defaultdict(list)
    for t, (_, found) in enumerate(wanted):
        steps[block_step(len(found))].append((t, np.sort(rank[sorted({number[w] for w in found})])))
    indexes = [TemplateIndex(c, sets, share, len(rank)) for c, sets in sorted(steps.items())]
    runs = [(label, rank[[number[w] for w in found]]) for label, found in exact if found]

    def base(row: np.ndarray, place: np.ndarray, token: np.ndarray):
        """``(row, place, phrase)`` of the phrases' places."""
        out = []
        for k, (_, want) in enumerate(runs):
            m = len(token) - len(want) + 1
            if m <= 0:
                continue
            ok = np.ones(m, bool)
            for j, w in enumerate(want.tolist()):
                ok &= ((token[j:j + m] == w) & (row[j:j + m] == row[:m])
                       & (place[j:j + m] == place[:m] + j))
            at = np.flatnonzero(ok)
            out += zip(row[at].tolist(), place[at].tolist(), [k] * len(at))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, off in wd.chunks(batch.column(1)):
                row, place, token, n_words = vocab.places(raw, off)
                token = rank[token]
                starts, labels, blocks, best = (defaultdict(x) for x in (list, set, list, float))
                for r, p, k in base(row, place, token):
                    starts[r].append(p)
                    labels[r].add(runs[k][0])
                known = {r: ",".join(sorted(x)) for r, x in labels.items()}
                best.update(dict.fromkeys(starts, 1.0))
                for index in indexes:
                    for r, w, o, s in zip(*(x.tolist() for x in index.join(row, place, token))):
                        label, size = wanted[index.template[o]][0], int(index.size[o])
                        labels[r].add(label)
                        best[r] = max(best[r], s / size)
                        end = min(int(n_words[r]), (w + 2) * index.step)
                        blocks[r].append({"label": label, "first_word": w * index.step,
                                          "n_words": end - w * index.step, "shared": s, "size": size})
                own = range(b - a)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(n_words),
                    pa.array([len(starts[r]) if r in starts else 0 for r in own], pa.int64()),
                    pa.array([min(starts[r]) if r in starts else None for r in own], pa.int64()),
                    pa.array([max(starts[r]) if r in starts else None for r in own], pa.int64()),
                    pa.array([known.get(r, "") for r in own], pa.string()),
                    pa.array([",".join(sorted(labels[r])) if r in labels else "" for r in own], pa.string()),
                    pa.array([best[r] if r in best else 0.0 for r in own], pa.float64()),
                    pa.array([blocks[r] if r in blocks else [] for r in own], pa.list_(pa.struct([
                        ("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()),
                        ("shared", pa.int32()), ("size", pa.int32())])))],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                     "labels", "score", "blocks"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {SCHEMA}")
