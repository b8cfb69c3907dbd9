"""Toxicity on held-out rows; quality statistics against plain Python, rules against labels."""

import numpy as np
import pytest

from marketweave.llm import quality, queries, toxicity
from tests.conftest import SMALL
from tests.llm import brute

WORDS = [f"word{i}" for i in range(400)]


def made_texts(n, bad_words, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        w = list(rng.choice(WORDS, rng.integers(20, 200)))
        toxic = int(i % 4 == 0)
        if toxic:
            for b in rng.choice(bad_words, 3):
                w.insert(rng.integers(0, len(w)), b + rng.choice(["", ",", "."]))
        rows.append((i, " ".join(w), toxic))
    return rows


@pytest.fixture(scope="module")
def toxic(spark):
    rows = made_texts(1200, ["vile", "rotten", "Nasty", "foul"])
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return rows, d.select("doc_id", "text"), d.select("doc_id", "toxic")


def test_toxicity_learns_held_out_rows(toxic):
    rows, docs, labels = toxic
    model = toxicity.train(docs, labels, keep=~queries.held_out())
    assert 0 < len(model.index) < 2000  # sparse
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).withColumn(
        "held", queries.held_out()).collect()}
    held = [(t, got[i]["score"]) for i, _, t in rows if got[i]["held"]]
    assert sum((s >= 0.5) == bool(t) for t, s in held) >= 0.97 * len(held)


def test_toxicity_is_reproducible_and_ignores_held_out_labels(toxic):
    _, docs, labels = toxic
    from pyspark.sql import functions as F

    a = toxicity.train(docs, labels, keep=~queries.held_out())
    other = labels.withColumn("toxic", F.when(queries.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    b = toxicity.train(docs.repartition(5), other, keep=~queries.held_out())
    assert (a.index == b.index).all() and np.allclose(a.weight, b.weight) and a.bias == b.bias


def test_toxicity_score_equals_plain_sum(toxic):
    _, docs, labels = toxic
    model = toxicity.train(docs, labels)
    table = dict(zip(model.index.tolist(), model.weight.tolist()))
    for r in docs.limit(5).collect():
        raw = np.frombuffer(r["text"].encode(), dtype=np.uint8)
        _, coord = toxicity.features(raw, np.array([0, len(raw)]))
        total = model.bias + sum(table.get(c, 0.0) for c in set(coord.tolist()))
        got = toxicity.score(docs.filter(f"doc_id = {r['doc_id']}"), model).first()["score"]
        assert got == pytest.approx(1 / (1 + np.exp(-total)))


def test_toxicity_odd_rows(spark, odd_docs, odd_rows, no_docs):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(odd_docs, none)
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == len(odd_rows) and all(r["score"] == 0.5 for r in rows)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (6, 0), (4, 1)], "doc_id long, toxic int")
    rows = toxicity.score(odd_docs, toxicity.train(odd_docs, labels)).collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(no_docs, model).count() == 0


def test_toxicity_query_columns(spark):
    r = queries.QUERIES["op1_toxicity"](spark, SMALL)
    assert r.columns == ["doc_id", "held_out", "score", "predicted"]
    assert r.count() == 200
    assert r.filter("predicted <> CAST(score >= 0.5 AS INT)").count() == 0


def plain_statistics(text):
    t = text or ""
    w = brute.words(t)
    lines = [x for x in t.split("\n") if brute.words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
            brute.repeated_window_words(t))


FIVE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_statistics_equal_plain_python(spark, documents):
    rows = queries.QUERIES["op2_quality_rules"](spark, SMALL).collect()
    want = {i: plain_statistics(t) for i, t, _ in documents}
    assert len(rows) == len(documents)
    for r in rows:
        s = want[r["doc_id"]]
        assert tuple(r[c] for c in FIVE) == s
        assert r["base_failed"] == (s[0] < 10 or 100 * s[4] > 20 * s[0])
        assert r["kept"] == (not r["base_failed"] and r["rule"] == 0)


def test_statistics_odd_rows(spark, odd_docs, odd_rows, no_docs):
    more = [(20, "a b c d e " * 40, "x"), (21, "x y z x y z x y z x y z", "x"), (22, "l one\n\nl one\n \nl two", "x"),
            (23, "a b c d e f a b c d e g a b c d e f", "x")]
    extra = spark.createDataFrame([r + ("z",) * 8 for r in more], odd_docs.schema)
    got = quality.text_statistics(odd_docs.unionByName(extra)).collect()
    assert sorted((r["doc_id"] or 0, *[r[c] for c in FIVE]) for r in got) == sorted(
        (i or 0, *plain_statistics(t)) for i, t, _ in odd_rows + more)
    assert quality.text_statistics(no_docs).count() == 0


@pytest.fixture(scope="module")
def judged(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(900):
        w = list(rng.choice(WORDS, rng.integers(15, 120)))
        kind = i % 6
        if kind == 0:
            w = [x + "$$%" for x in w]
        elif kind == 1:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w), "s", int(kind > 1)))
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, quality int")
    return d.select("doc_id", "text", "source"), d.select("doc_id", "quality")


def test_rules_find_the_bad_and_spare_the_good(judged):
    docs, labels = judged
    out = quality.judge(docs, labels).join(labels, "doc_id").collect()
    bad = [r for r in out if r["quality"] == 0]
    good = [r for r in out if r["quality"] == 1]
    assert sum(not r["kept"] for r in bad) >= 0.97 * len(bad)
    assert sum(r["kept"] or r["base_failed"] for r in good) >= 0.99 * len(good)
    assert 2 <= len({r["rule"] for r in bad} - {0}) <= 12
    kept = {r["doc_id"] for r in out if r["kept"]}
    rows = quality.keep_good(docs, labels)
    assert rows.columns == docs.columns
    assert {r["doc_id"] for r in rows.collect()} == kept


def test_rules_without_bad_rows(judged, spark, odd_docs):
    docs, labels = judged
    picked = quality.labelled(labels.filter("quality = 1"))
    assert quality.learn_rules(quality.text_statistics(docs), picked) == []
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality.judge(odd_docs, none).collect()
    assert all(r["rule"] == 0 and r["kept"] == (not r["base_failed"]) for r in out)


def test_quality_plan_has_no_python(spark):
    plan = queries.QUERIES["op2_quality_rules"](spark, SMALL)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
