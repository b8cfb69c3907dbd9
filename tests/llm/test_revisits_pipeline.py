"""Revisit resolution against SQL and plain rules; the pipeline against its stages' laws."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketweave.llm import quality, queries, revisits
from tests.conftest import SMALL
from tests.llm import brute
from tests.llm.test_duplicates import check_passages, lure

RECORDS = "record_id long, url string, at long, kind string, headers map<string,string>"


def resolved(spark, rows, slices=4):
    out = revisits.resolve_revisits(spark.createDataFrame(rows, RECORDS), slices).collect()
    return {r["record_id"]: r for r in out}


def test_canonical_urls(spark):
    cases = {
        "HTTP://Example.COM:80/a?b=2&a=1#x": "http://example.com/a?a=1&b=2",
        "https://h:443": "https://h/", "https://h:8443/": "https://h:8443/",
        "http://h/p?utm_source=feed": "http://h/p", "http://h?q": "http://h/?q",
        "http://h/p?": "http://h/p", "http://H/P/Q": "http://h/P/Q",
    }
    d = spark.createDataFrame([(k,) for k in cases], "u string")
    got = {r[0]: r[1] for r in d.select("u", revisits.canonical_url(F.col("u"))).collect()}
    assert got == cases


def test_validators_and_merge(spark):
    full = {"ETag": '"a"', "Last-Modified": "m", "Content-Type": "t", "Date": "d1"}
    rows = [
        (1, "http://h/x", 10, "response", full),
        (2, "http://H/x#f", 20, "revisit", {"etag": 'W/"a"', "date": "d2", "content-type": "no", "Expires": "e"}),
        (3, "http://h/x", 21, "revisit", {"ETag": '"b"'}),
        (4, "http://h/x", 22, "revisit", {"last-modified": "m"}),
        (5, "http://h/x", 23, "revisit", {"last-modified": "other"}),
        (6, "http://h/x", 24, "revisit", {}), (7, "http://h/x", 24, "revisit", None),
        (8, "http://h/x", 10, "revisit", {"etag": '"a"'}),
        (9, "http://h/y", 99, "revisit", {"etag": '"a"'}),
        (10, None, 99, "revisit", {"etag": '"a"'}), (11, "http://h/x", None, "revisit", {"etag": '"a"'}),
        (12, "http://h/z", 1, "response", None), (13, "http://h/z", 2, "revisit", {"etag": "q"}),
        (14, "http://h/x", 50, "response", {"etag": '"n"'}), (15, "http://h/x", 50, "response", {"etag": '"o"'}),
        (16, "http://h/x", 60, "revisit", {"etag": '"o"'}), (16, "http://h/x", 60, "revisit", {"etag": '"o"'}),
        (None, "http://h/x", 60, "revisit", {"etag": '"o"'}),
    ]
    got = resolved(spark, rows)
    assert {k: r["outcome"] for k, r in got.items()} == {
        2: "resolved", 3: "changed", 4: "resolved", 5: "changed", 6: "unvalidated", 7: "unvalidated",
        8: "orphan", 9: "orphan", 10: "invalid", 11: "invalid", 13: "unvalidated", 16: "resolved",
        None: "resolved"}
    assert got[2]["refers_to"] == 1 and got[16]["refers_to"] == 15
    assert got[2]["headers"] == {"etag": 'W/"a"', "last-modified": "m", "content-type": "t",
                                 "date": "d2", "expires": "e"}
    assert got[3]["headers"] is None and got[3]["refers_to"] is None


def test_as_of_equals_plain_search(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        url = "http://hot/" if rng.random() < 0.5 else f"http://h/{rng.randrange(12)}"
        rows.append((i, url, rng.randrange(300), rng.choice(["response", "revisit"]),
                     {"etag": rng.choice("ab")}))
    for slices in (1, 7, 1000):
        got = resolved(spark, rows, slices)
        for i, url, at, kind, head in rows:
            if kind != "revisit":
                continue
            earlier = [(a, j, h["etag"]) for j, u, a, k, h in rows if k == "response" and u == url and a < at]
            want = "orphan" if not earlier else "resolved" if max(earlier)[2] == head["etag"] else "changed"
            assert got[i]["outcome"] == want
            assert got[i]["refers_to"] == (max(earlier)[1] if want == "resolved" else None)


def test_stray_times_and_missing_responses_are_dealt_evenly(spark):
    """A stray time widens the slices of one part only; revisits that find nothing, with a record
    number or without, are all kept and none meets a response whose number is its hash."""
    span = 2**62
    rows = [(i, "http://hot/", i, "response", {"etag": "a"}) for i in range(0, 2000, 2)]
    rows += [(i, "http://hot/", i, "revisit", {"etag": "a"}) for i in range(1, 2000, 2)]
    rows += [(5001, "http://hot/", -span, "response", {}), (5002, "http://hot/", span, "response", {})]
    rows += [(None, "http://none/", 5, "revisit", None)] * 300 + [(6000, "http://none/", 6, "revisit", None)]
    r = spark.createDataFrame(rows, RECORDS)
    sizes = [x["count"] for x in r.groupBy(revisits._slice(r, 4096).alias("s")).count().collect()]
    assert len(sizes) > 500 and max(sizes) < 600  # the hot time 5 stays whole
    out = revisits.resolve_revisits(r).collect()
    assert len(out) == 1000 + 301
    assert sum(x["outcome"] == "orphan" for x in out) == 301
    assert all(x["refers_to"] == x["record_id"] - 1 for x in out if x["outcome"] == "resolved")


def test_repeated_record_numbers_long_urls_and_clashing_columns(spark):
    long = "http://h/" + "p" * 100_000
    rows = [(1, long, 1, "response", {"etag": "a", "x": "1"}), (1, long, 1, "response", {"etag": "a", "x": "1"}),
            (2, long + "#f", 2, "revisit", {"etag": "a"}), (None, long, 3, "response", {"etag": "b"}),
            (3, long, 4, "revisit", {"etag": "b"})]
    d = spark.createDataFrame(rows, RECORDS).selectExpr(
        "*", "1 key", "true known", "2 slice", "3 ref_id", "4 stored", "5 canonical", "6 near", "7 ref")
    got = {r["record_id"]: r for r in revisits.resolve_revisits(d).collect()}
    assert got[2]["refers_to"] == 1 and got[2]["headers"] == {"etag": "a", "x": "1"}
    # the response has no number: it is found, but cannot be named
    assert (got[3]["outcome"], got[3]["refers_to"], got[3]["headers"]) == ("resolved", None, None)


def test_revisits_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SMALL}/pages.parquet')")
    df = queries.QUERIES["op4_revisits"](spark, SMALL)
    cur = con.execute(queries.ORACLE["op4_revisits"])
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    want = [dict(zip([d[0] for d in cur.description], r)) for r in cur.fetchall()]
    key = lambda r: r["record_id"]
    assert sorted((r.asDict() for r in df.collect()), key=key) == sorted(want, key=key)
    assert {"resolved", "changed", "orphan"} >= {r["outcome"] for r in want}


def test_no_records(spark):
    assert revisits.resolve_revisits(spark.createDataFrame([], RECORDS)).count() == 0


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, frames[-1], SMALL).write.parquet(path)
        frames.append(spark.read.parquet(path))
    return frames


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_hand_on_documents(staged):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "jaccard_join", "substring_dedup", "mixing", "bpe_encoding"]
    assert all(f.columns == staged[0].columns for f in staged[:-1])
    assert staged[-1].columns == ["doc_id", "n_tokens", "ids"]


def test_quality_stage_keeps_what_the_query_keeps(spark, staged):
    d = staged[0]
    out = quality.judge(d, spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert sorted(texts(staged[1])) == sorted(r["doc_id"] for r in out.filter("kept").collect())
    assert all(texts(d)[i] == t for i, t in texts(staged[1]).items())


def test_jaccard_stage_keeps_one_of_each(staged):
    before, after = texts(staged[1]), texts(staged[2])
    ids = sorted(before)
    comp = brute.components(range(len(ids)), brute.jaccard_links([before[i] for i in ids], 5, 80, 100))
    assert sorted(after) == sorted({ids[c] for c in comp.values()})


def test_substring_stage_leaves_no_repeat(staged):
    must, _ = check_passages([], {i: t for i, t in texts(staged[3]).items()}, 10**6)
    assert not must
    whole, left = texts(staged[2]), texts(staged[3])
    repeats = set()
    seen = {}
    for i in sorted(whole):
        w = brute.words(brute.lower(whole[i]))
        for s in range(len(w) - 49):
            if seen.setdefault(tuple(w[s:s + 50]), i) != i:
                repeats.add(i)
    assert all(left.get(i) != whole[i] for i in repeats)
    assert all(left[i] == whole[i] for i in whole if i == min(whole))


def test_substring_stage_leaves_no_repeat_of_50_words(staged):
    must, _ = check_passages([], texts(staged[3]), 50)
    assert not must


def test_substring_stage_leaves_no_copy_between_shared_anchors(spark):
    rng = random.Random(18)
    fresh = lambda n: [f"p{rng.randrange(10**6)}" for _ in range(n)]
    passage = fresh(50)
    rows = [lure(rng, passage), fresh(40) + passage + fresh(70), fresh(90) + passage + fresh(9), lure(rng, passage)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string")
    left = texts(corpus_pipeline.substring_stage(spark, docs, SMALL))
    assert left == {i: t for i, t in texts(docs).items() if i != 2} | {2: left[2]}
    assert brute.words(left[2]) == rows[2][:90] + rows[2][140:]
    must, _ = check_passages([], left, 50)
    assert not must


def test_mixing_and_encoding_stages(staged):
    mixed = staged[4].groupBy("doc_id").count().collect()
    assert {r["doc_id"] for r in mixed} <= set(texts(staged[3])) and all(1 <= r["count"] <= 3 for r in mixed)
    assert staged[5].count() == staged[4].count()
    assert staged[5].filter("octet_length(ids) <> 4 * n_tokens").count() == 0


def test_run_equals_the_stages(spark, staged):
    got = corpus_pipeline.run(spark, SMALL)
    key = lambda d: sorted((r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in d.collect())
    assert key(got) == key(staged[-1])
