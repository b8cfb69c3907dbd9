"""Mixing against its SQL form and its laws, sharding against its laws."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from marketweave.llm import mixing, queries, sharding
from tests.conftest import SMALL


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def filled(sizes, weights):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > 3 * sizes[s]]
        if not over:
            return target | {s: left * w[s] / total for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
        free -= set(over)
        left = sum(sizes.values()) - sum(target.values())
    return target


def check_mix(rows, texts):
    sizes = defaultdict(int)
    for _, t, s in texts:
        sizes[s] += words(t)
    want = filled(sizes, (1, 2, 3))
    taken = defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["size"] == 0 or r["taken"] % r["size"] == 0
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    largest = max((words(t) for _, t, _ in texts), default=0)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest / 2 + 1
        epochs = int(want[s] // max(1, sizes[s]))
        assert all(r["taken"] >= epochs * r["size"] for r in rows if r["source"] == s)


def test_mixing_follows_its_laws(spark, documents):
    d = spark.read.parquet(f"{SMALL}/documents.parquet")
    a = mixing.mix_sources(d).collect()
    check_mix(a, documents)
    b = mixing.mix_sources(d.repartition(5), buckets=3).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_mixing_prefers_quality(spark):
    rows = [(i, "good word here", "a") for i in range(300)] + \
           [(1000 + i, "bad ### $$$", "a") for i in range(300)]
    out = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"),
                             share=0.5).collect()
    good = sum(r["taken"] for r in out if r["doc_id"] < 1000)
    assert good > 2 * sum(r["taken"] for r in out if r["doc_id"] >= 1000)


def test_mixing_odd_rows(odd_docs, odd_rows, no_docs):
    out = mixing.mix_sources(odd_docs).collect()
    assert len(out) == len(odd_rows)
    check_mix(out, odd_rows)
    assert mixing.mix_sources(no_docs).count() == 0
    kept = mixing.mixed_rows(odd_docs)
    assert kept.columns == odd_docs.columns
    want = Counter()
    for r in out:
        if r["taken"]:
            want[r["doc_id"]] += r["taken"] // r["size"]
    assert Counter(r["doc_id"] for r in kept.collect()) == want


def test_mixing_oracle_text():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    assert len(con.execute(queries.ORACLE["op8_mixing"]).fetchall()) == 200


def check_shards(rows, texts, shards, tolerance):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in texts)
    slots, load = defaultdict(list), np.zeros((shards, 3))
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += [r["size"], r["n_tokens"], 1]
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    if tolerance:
        assert (load.max(0) <= load.mean(0) * (1 + tolerance)).all()


def test_sharding_laws(spark, documents):
    d = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sharding.shard_documents(d, 6).collect()
    check_shards(rows, documents, 6, 0.05)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, sharding.shard_documents(
        d.repartition(7), 6).collect()))


def test_sharding_splits_a_hot_group_and_keeps_small_ones(spark):
    hot = [(i, "the same text", "a") for i in range(1000)]
    rest = [(1000 + i, f"text number {i % 1000} stands here", "a") for i in range(2000)]
    rows = sharding.shard_documents(
        spark.createDataFrame(hot + rest, "doc_id long, text string, source string"), 8).collect()
    check_shards(rows, hot + rest, 8, 0.05)
    at = {r["doc_id"]: r["shard"] for r in rows}
    assert len({at[i] for i in range(1000)}) == 8
    assert all(at[1000 + i] == at[2000 + i] for i in range(1000))


def test_sharding_odd_rows(odd_docs, odd_rows, no_docs):
    check_shards(sharding.shard_documents(odd_docs, 3).collect(), odd_rows, 3, 0)
    assert sharding.shard_documents(no_docs, 3).count() == 0


def test_packing_uses_the_residual():
    v = np.array([[4.0, 1, 1], [1, 4, 1], [4, 1, 1], [1, 4, 1]])
    where = sharding.pack_vectors(v, 2)
    assert where[0] != where[2] and where[1] != where[3]
    assert len(sharding.pack_vectors(np.zeros((0, 3)), 2)) == 0
