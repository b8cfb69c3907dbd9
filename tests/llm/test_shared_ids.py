"""Rows that share an id or have none, columns named like the operators' own, empty tables: for
every pipeline stage, the mixture and the shards."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from marketweave.llm import jaccard, mixing, sharding, substrings
from tests.conftest import SMALL

NAMES = ("row", "node", "none", "id", "number", "spans", "cut", "times", "copy", "place", "grp", "first",
         "mix_id", "mix_times", "mix_copy", "_node", "_none", "_id", "_span_doc", "_spans", "shard", "cell",
         "passage", "size", "taken", "with space")


def words(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def stages():
    import corpus_pipeline

    return corpus_pipeline.STAGES


def table(spark, rows):
    """``rows(doc_id, text, source)`` with the other columns of documents and clashing ones."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df = df.withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("int")})
    return df.withColumns({n: F.concat(F.lit(f"{n} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))
                           for n in NAMES})


ODD = [(1, words("a", 80), "x"), (5, words("a", 80) + " " + words("t", 10), "x"), (5, words("b", 120), "x"),
       (None, words("c", 60), "x"), (None, words("d", 60), None), (7, None, "y"), (8, "", "y"), (9, " \n ", None),
       (10, words("e", 70), "y"), (10, words("e", 70), "y"), (11, words("long", 30_000), "z")]


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_rows_and_clashing_names(spark, k):
    name, stage = stages()[k]
    docs = table(spark, ODD)
    out = stage(spark, docs, SMALL)
    rows = out.collect()
    if name != "bpe_encoding":
        assert out.columns == docs.columns
        own = {n: f"{n} of " for n in NAMES}
        for r in rows:
            assert all(r[n] == own[n] + ("none" if r["doc_id"] is None else str(r["doc_id"])) for n in NAMES)
    else:
        assert len(rows) == len(ODD)
    assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_only_the_compared_text_of_an_id_is_cut(spark):
    out = [(r.doc_id, r.text) for r in substrings.without_repeats(table(spark, ODD)).collect()]
    texts = Counter(" ".join(t.split()) if t else t for i, t in out if i == 5)
    assert texts == Counter([words("t", 10), words("b", 120)])
    assert sum(i is None for i, _ in out) == 2 and (1, words("a", 80)) in out
    assert {r.n_chars == (None if r.text is None else len(r.text))
            for r in substrings.without_repeats(table(spark, ODD)).collect()} == {True}


def test_copies_are_told_apart_by_their_text(spark):
    rows = [(None, words("a", 40), "x"), (None, words("b", 40), "x"), (3, words("a", 40), "x"),
            (4, words("c", 40), "x"), (4, words("d", 40), "x"), (4, words("c", 40), "x")]
    out = jaccard.one_of_each(table(spark, rows), jaccard.Similarity(5, 80, 100))
    assert Counter((r.doc_id, r.text[:2]) for r in out.collect()) == Counter(
        [(3, "a0"), (None, "b0"), (4, "c0"), (4, "d0")])


def test_mixture_takes_rows_without_ids_one_by_one(spark):
    """A third of the rows has no id: every source gets the words that were decided for it."""
    rows = [(None if i % 3 == 0 else i, words(f"w{i}x", 10 + i % 17), "abc"[i % 7 % 3]) for i in range(900)]
    docs = table(spark, rows)
    decided, got = defaultdict(int), defaultdict(int)
    mixed = mixing.mix_sources(docs).collect()
    for r in mixed:
        decided[r.source] += r.taken
    for r in mixing.mixed_rows(docs).collect():
        got[r.source] += len(r.text.split())
    assert got == decided
    targets = {r.source: r.target for r in mixed}
    assert all(abs(got[s] - targets[s]) <= 27 for s in targets)
    # their keys differ, so none of them is a hot key
    taken = Counter(r.taken > 0 for r in mixed if r.doc_id is None and r.source == "a")
    assert len(taken) == 2 or targets["a"] >= sum(r.size for r in mixed if r.source == "a")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_small_groups_of_equal_texts_stay_together(spark, sf):
    docs = spark.read.parquet(SMALL.replace("sf0.001", sf) + "/documents.parquet").select("doc_id", "text")
    at = defaultdict(set)
    n = Counter()
    for r in sharding.shard_documents(docs, 24).join(docs, "doc_id").select("text", "shard").collect():
        at[r.text].add(r.shard)
        n[r.text] += 1
    assert max(n.values()) > 1
    assert all(len(s) == 1 for t, s in at.items() if n[t] <= sharding.FEW)


def test_a_hot_group_without_ids_is_dealt_evenly(spark):
    rows = [(None, "the same text", "a")] * 2000 + [(i, f"text number {i} stands here", "a") for i in range(2000)]
    out = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"), 8)
    sizes = [r["n"] for r in out.groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 1.05 * sum(sizes) / 8
