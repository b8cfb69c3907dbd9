"""Edge cases, one per semantics note: bin edges, null keys, tie-breaks, zero variance,
leading outliers, unparseable dates, Unicode word characters, blank text, empty arrays,
empty inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketweave.functions import dates as D
from marketweave.functions import text as T
from marketweave.functions.formatting import fixed2
from marketweave.functions.stats import corr_strength, safe_corr
from marketweave.operators import analytics as A
from marketweave.operators import news as N
from marketweave.operators import posts as P
from marketweave.operators import sentiment as X
from marketweave.operators import stock as S
from marketweave.operators import tables as TB
from marketweave.operators.dedup import keep_first


def test_valence_bins_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, -0.99, -0.5, 0.1, 0.100001, 0.5, 1.0,
                                               1.01)], "c double")
    got = {r.c: r.b for r in df.select("c", X.bucket("c").alias("b")).collect()}
    assert got[-1.0] is None  # the lowest edge is open
    assert got[-0.99] == "negative" and got[-0.5] == "negative"
    assert got[0.1] == "slightly negative" and got[0.100001] == "neutral"
    assert got[0.5] == "neutral" and got[1.0] == "positive" and got[1.01] is None


def test_polarity_bins(spark):
    df = spark.createDataFrame([(-0.2,), (0.2,), (0.21,)], "c double")
    got = [r.b for r in df.select(X.bucket("c", X.POLARITY_BINS).alias("b")).collect()]
    assert got == ["negative", "neutral", "positive"]


def test_corr_zero_variance_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "x double, y double")
    r = df.agg(safe_corr("x", "y").alias("r")).first().r
    assert r is None
    lab = df.agg(safe_corr("x", "y").alias("r")).select(corr_strength("r").alias("s")).first().s
    assert lab == "No correlation"


def test_corr_strength_strict_edges(spark):
    df = spark.createDataFrame([(0.7,), (0.3,), (-0.3,), (-0.7,)], "r double")
    got = [r.s for r in df.select(corr_strength("r").alias("s")).collect()]
    assert got == ["Moderate positive", "Weak", "Moderate negative", "Strong negative"]


def test_keep_first_nulls_group_together_and_tiebreak(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, "x", "c"), (4, "x", "d")],
                               "id int, k string, v string")
    got = sorted((r.id, r.v) for r in keep_first(df, ["k"], ["id"]).collect())
    assert got == [(1, "a"), (3, "c")]
    kept = keep_first(df, ["k"], ["id"], pass_null_keys=True).collect()
    assert sorted(r.id for r in kept) == [1, 2, 3]


def test_leading_outlier_stays_null_and_fill_is_per_ticker(spark):
    rows = [("A", dt.date(2024, 1, d), 10.0 + d * 0.01) for d in range(1, 30)]
    rows[0] = ("A", dt.date(2024, 1, 1), 1e6)   # leading outlier
    rows[5] = ("A", dt.date(2024, 1, 6), -1e6)  # inner outlier
    rows += [("B", dt.date(2024, 1, d), 10.0 + d * 0.01) for d in range(1, 5)]
    df = spark.createDataFrame(rows, "symbol string, date date, close double")
    out = {(r.symbol, r.date.day): r.close
           for r in S.outlier_ffill(df, cols=("close",)).collect()}
    assert out[("A", 1)] is None
    assert out[("A", 6)] == pytest.approx(10.05)
    assert out[("B", 1)] == pytest.approx(10.01)


def test_daily_return_zero_previous_is_null(spark):
    df = spark.createDataFrame([("A", 1, 0.0), ("A", 2, 5.0), ("A", 3, 10.0)],
                               "symbol string, date int, close double")
    got = [r.daily_return for r in S.daily_return(df).orderBy("date").collect()]
    assert got == [None, None, 1.0]


def test_unparseable_dates(spark):
    df = spark.createDataFrame([("2024-13-01 00:00:00",), ("",), (None,), ("yesterday",),
                                ("2024-02-30T00:00:00Z",), ("Fri, 05 Jan 2024 10:00:00 GMT",)],
                               "x string")
    got = [r.t for r in df.select(D.parse_news_date("x").alias("t")).collect()]
    assert got[:5] == [None] * 5
    assert got[5] == dt.datetime(2024, 1, 5, 10, 0)
    soc = [r.t for r in df.select(D.parse_social_date("x").alias("t")).collect()]
    assert soc == [None] * 6


def test_social_weekday_form(spark):
    df = spark.createDataFrame([("Sun May 11 12:58:38 +0000 2025",)], "x string")
    assert df.select(D.parse_social_date("x").alias("t")).first().t == \
        dt.datetime(2025, 5, 11, 12, 58, 38)


def test_clean_text_unicode_words(spark):
    df = spark.createDataFrame([("hi @né_1 x #été2024 y a@b.com http://x.y/z\n z",)], "t string")
    assert df.select(T.clean_text("t").alias("c")).first().c == "hi x y a.com z"


def test_blank_text_with_tabs_and_newlines(spark):
    df = spark.createDataFrame([(" \t\n ",), ("　",), ("a",), (None,)], "t string")
    got = [r.b for r in df.select(T.is_blank("t").alias("b")).collect()]
    assert got == [True, True, False, True]


def test_to_document_empty_array_and_nan(spark):
    df = spark.createDataFrame([([], float("nan")), ([1.0], 2.0)], "a array<double>, v double")
    got = TB.to_document(df).collect()
    assert got[0].a is None and got[0].v is None
    assert got[1].a == [1.0] and got[1].v == 2.0


def test_default_row_only_when_empty(spark):
    empty = spark.createDataFrame([], "title string, description string")
    out = N.default_row_if_empty(empty).collect()
    assert len(out) == 1 and out[0].title == "No news articles available"
    one = spark.createDataFrame([("t", "d")], "title string, description string")
    assert N.default_row_if_empty(one).count() == 1


def test_combined_text_and_counts(spark):
    schema = ("title string, comments array<struct<pos:int, comment_text:string, "
              "comment_score:int>>")
    df = spark.createDataFrame([("T", [(1, "a", 1), (2, "", 5), (3, None, 5)]), ("U", None)],
                               schema)
    got = df.select(P.combined_text("title", "comments").alias("c"),
                    P.valid_comment_count("comments").alias("n")).collect()
    assert got[0].c == "T a " and got[0].n == 1
    assert got[1].c == "U" and got[1].n == 0


def test_top_comments_stable(spark):
    schema = "comments array<struct<pos:int, comment_score:int>>"
    df = spark.createDataFrame([([(1, 3), (2, 5), (3, 3), (4, 5), (5, 1), (6, 9)],)], schema)
    top = df.select(P.top_comments("comments", 5).alias("t")).first().t
    assert [c.pos for c in top] == [6, 2, 4, 1, 3]


def test_fixed2_half_up(spark):
    df = spark.createDataFrame([(1029.945,), (-0.004,), (None,), (0.125,)], "x double")
    got = [r.s for r in df.select(fixed2("x", prefix="$").alias("s")).collect()]
    assert got[1] == "-$0.00" and got[2] is None and got[3] == "$0.13"


def test_insert_ignore_raises_on_clash(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    n = spark.createDataFrame([(1, "b", 1)], "k int, v string, o int")
    with pytest.raises(ValueError):
        TB.insert_ignore(t, n, ["k"], ["o"], handle_duplicates=False)


def test_upsert_skips_null_keys_and_keeps_fields(spark):
    t = spark.createDataFrame([(1, "a", 1.0)], "k int, name string, x double")
    n = spark.createDataFrame([(1, None, 2.0, 1), (None, "z", 9.0, 2), (2, "b", 3.0, 3)],
                              "k int, name string, x double, o int")
    got = {r.k: r for r in TB.upsert_merge(t, n, ["k"], ["o"], "2024-01-01 00:00:00").collect()}
    assert set(got) == {1, 2}
    assert got[1].name == "a" and got[1].x == 2.0 and got[1].action == "update"
    assert got[2].action == "insert"


def test_ttl_keeps_rows_without_stamp(spark):
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2024, 1, 1)),
                                (3, dt.datetime(2024, 1, 10))], "id int, created_at timestamp")
    got = sorted(r.id for r in TB.ttl_sweep(df, "2024-01-10 12:00:00").collect())
    assert got == [1, 3]


def test_valence_empty_and_null_text(spark):
    lex = spark.createDataFrame([("good", 2.0)], "token string, valence double")
    df = spark.createDataFrame([(1, None), (2, ""), (3, "good good bad")], "id int, text string")
    got = {r.id: r for r in X.lexicon_valence(df, ["id"], lex).collect()}
    assert got[1].text_compound == 0.0 and got[2].text_neu == 0.0
    s = 4.0
    assert got[3].text_compound == pytest.approx(s / (s * s + 15) ** 0.5)
    assert got[3].text_pos == pytest.approx(6.0 / 7.0)


def test_keyword_tag_needs_all_tokens(spark):
    terms = spark.createDataFrame([("t1", "natural"), ("t1", "disaster"), ("t2", "storm")],
                                  "term string, token string")
    df = spark.createDataFrame([(1, "A natural disaster, storm!"), (2, "natural causes")],
                               "id int, text string")
    got = sorted((r.id, r.event_type) for r in X.keyword_tag(df, "id", "text", terms).collect())
    assert got == [(1, "t1"), (1, "t2")]


def test_find_documents_null_equality(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, k string")
    assert [r.id for r in A.find_documents(df, {"k": None}).collect()] == [1]


def test_comment_scores_nested_equal_flat(spark):
    from marketweave.sources import fixtures as fx
    from tests.conftest import SMALL

    posts = fx.posts_raw(spark, SMALL).withColumn(
        "comments", F.when(F.col("conv_id") % 5 != 0, F.col("comments")).otherwise(
            F.filter("comments", lambda c: F.lit(False))))
    for model, lex, names in (
            ("valence", fx.lexicon(spark), ("neg", "neu", "pos", "compound")),
            ("polarity", fx.polarity_lexicon(spark), ("polarity", "subjectivity"))):
        flat = X.comment_sentiment(posts, "conv_id", lex, flat=True, model=model)
        nested = X.comment_sentiment(posts, "conv_id", lex, model=model)
        assert nested.count() == posts.count()
        assert nested.where("conv_id % 5 = 0 AND size(comments) <> 0").count() == 0
        e = nested.select("conv_id", F.posexplode("comments").alias("pos", "c")).select(
            "conv_id", "pos", *[f"c.comment_{n}" for n in names])
        assert sorted(map(tuple, e.collect())) == sorted(map(tuple, flat.collect()))


def test_json_array_files_split_hot_groups(spark, tmp_path):
    from marketweave.sources.json_io import scan_json_records, write_json_arrays

    df = spark.range(0, 2500).select(F.col("id").alias("event_id"),
                                     F.when(F.col("id") < 2000, "hot").otherwise("cold")
                                     .alias("g"))
    path = str(tmp_path / "arrays")
    write_json_arrays(df, path, "g", F.struct("event_id"), max_bytes=5000)
    back = scan_json_records(spark, path, "event_id bigint")
    assert sorted(r.event_id for r in back.collect()) == list(range(2500))
    parts = back.select("g", "_part").distinct().groupBy("g").count().collect()
    assert {r.g: r["count"] for r in parts} == {"hot": 7, "cold": 2}


def test_missing_json_path_is_empty(spark, tmp_path):
    from marketweave.sources.json_io import scan_json_records

    assert scan_json_records(spark, str(tmp_path / "nope"), "a bigint").count() == 0


def test_corrupt_json_file_dropped_or_quarantined(spark, tmp_path):
    from marketweave.sources.json_io import scan_json_records

    good, bad = tmp_path / "a.json", tmp_path / "b.json"
    good.write_text('[{"a": 1}, {"a": 2}]')
    bad.write_text('[{"a": 3}, oops')
    assert sorted(r.a for r in scan_json_records(spark, str(tmp_path), "a bigint").collect()) \
        == [1, 2]
    q = scan_json_records(spark, str(tmp_path), "a bigint", keep_corrupt=True)
    rows = q.collect()  # (a query touching only _corrupt is refused by the JSON source)
    assert len([r for r in rows if r._corrupt is not None]) == 1


def test_json_array_files_are_read_about_once(spark, tmp_path):
    """Numbers taken as text are not fetched from the file one by one."""
    from marketweave.sources.json_io import scan_json_records

    path = tmp_path / "a.json"
    path.write_text(",\n".join(['[{"a": 0, "v": 1.50, "s": "x"}', *(
        f'{{"a": {i}, "v": {i}.50, "s": "\u00e9", "o": {{"b" : [{i}]}}}}' for i in range(1, 3000))]) + "]\n")

    def read_so_far():
        stats = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
        return sum(s.getBytesRead() for s in stats if s.getScheme() == "file")
    before = read_so_far()
    rows = scan_json_records(spark, str(path), "a bigint, v string, s string, o string").collect()
    assert read_so_far() - before < 4 * path.stat().st_size
    assert sorted((r.a, r.v, r.o) for r in rows) == \
        [(0, "1.50", None), *((i, f"{i}.50", f'{{"b" : [{i}]}}') for i in range(1, 3000))]


def test_order_codes_keep_order_and_value(spark):
    import math
    import random
    import struct

    rng = random.Random(4)
    xs = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(20_000)]
    xs += [s * v for e in range(-1074, 1024) for v in (2.0 ** e, math.nextafter(2.0 ** e, math.inf),
                                                       math.nextafter(2.0 ** e, 0.0)) for s in (1, -1)]
    xs += [0.0, -0.0, math.inf, -math.inf, math.nan, 5e-324, -5e-324, 1.7976931348623157e308, 0.1, 1 / 3]
    from marketweave.operators.quantiles import code_value, order_code_sql

    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
    coded = spark.sql(order_code_sql("{t}", "x", "x AS y"), t=df).select("x", F.col("_code").alias("c"))
    rows = coded.withColumn("v", code_value(F.col("c"))).collect()
    assert [(r.c, r.v) for r in rows if r.x is None] == [(None, None)]
    rows = [r for r in rows if r.x is not None]
    for r in rows:
        assert r.v == r.x or (math.isnan(r.v) and math.isnan(r.x)), r
    rows.sort(key=lambda r: (math.isnan(r.x), r.x))
    for a, b in zip(rows, rows[1:]):
        assert a.c < b.c or (a.c == b.c and (a.x == b.x or math.isnan(a.x)))


def test_quantiles_of_odd_groups(spark):
    """Null and hot groups, columns without values, one value, equal values, infinities."""
    from marketweave.operators.quantiles import exact_quantiles

    inf = float("inf")
    rows = [(None, 1.5, None), (None, 2.5, None), ("hot", 7.0, 1.0), ("one", -3.25, None),
            ("inf", -inf, inf), ("inf", inf, inf), ("inf", 0.0, inf)] + [("hot", 7.0, float(i % 3)) for i in range(200)]
    t = spark.createDataFrame(rows, "g string, v double, u double")
    got = {(r.g, r.column, r.p): r.value for r in exact_quantiles(t, ["v", "u"], [0.25, 0.5, 1.0], by=["g"]).collect()}
    assert {k[:2] for k in got} == {(None, "v"), ("hot", "v"), ("hot", "u"), ("one", "v"), ("inf", "v"), ("inf", "u")}
    assert [got[(None, "v", p)] for p in (0.25, 0.5, 1.0)] == [1.75, 2.0, 2.5]
    assert {got[("hot", "v", p)] for p in (0.25, 0.5, 1.0)} == {7.0}
    assert [got[("hot", "u", p)] for p in (0.25, 0.5, 1.0)] == [0.0, 1.0, 2.0]
    assert got[("one", "v", 0.5)] == -3.25 and got[("inf", "v", 0.5)] == 0.0 and got[("inf", "u", 0.5)] == inf
    none = exact_quantiles(t.limit(0), ["v"], [0.5])
    assert none.count() == 0 and none.columns == ["column", "p", "value"]


def test_outlier_fill_computes_its_input_once(spark):
    """The bars are read from their source by one job; the rest reads the stored table."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [("A", dt.date(2024, 1, 1) + dt.timedelta(d), float(d % 7)) for d in range(100)]
    df = spark.createDataFrame(rows, "symbol string, date date, close double").coalesce(1)
    out = S.outlier_ffill(df.mapInArrow(count, df.schema), cols=("close",))
    assert len(out.collect()) == 100 and seen.value == 100


def test_html_as_a_parser_reads_it(spark):
    from marketweave.operators import news as N

    pages = [
        (1, '<h3 title="a>b">T</h3><p>x</p><a href=/rel>y</a>', "T", "x", "https://h.org/rel"),
        (2, "<h1>one <b class='>'>two</b>&amp;&#33;</h1><p>a<p>b</p>", "one two&!", "a", ""),
        (3, "<!-- <h3>no</h3> --><script>'<h3>no</h3>'</script><H3 >Yes</H3\n><P>a < b, 3<4</P>", "Yes", "a < b, 3<4", ""),
        (4, "<h3></h3><h1>x</h1><a>no link</a><a href='/z'>z</a><p>open to the end<br>of it", "x", "open to the endof it", ""),
        (5, "<h3>never closed<h1>next</h1>", "next", N.NO_DESCRIPTION, ""),
        (6, '<a data-href="/n" title="href=/m" HREF = "/a?b=1&amp;c=2">l</a>', N.NO_TITLE, N.NO_DESCRIPTION,
         "https://h.org/a?b=1&c=2"),
        (7, '<h3 title="unpaired>T</h3><p>after</p>', "T", "after", ""),
        (8, "", N.NO_TITLE, N.NO_DESCRIPTION, ""), (9, None, N.NO_TITLE, N.NO_DESCRIPTION, ""),
        (10, "<h3>a&amp;lt;b</h3><p> \u00a0 padded </p><a href=''>e</a>", "a&lt;b", "padded", ""),
        (11, "<p>" + "<i class='x'>w</i> " * 5000 + "</p>" + "<br>" * 20000, N.NO_TITLE, ("w " * 5000).strip(), ""),
    ]
    df = spark.createDataFrame([(i, "https://h.org/p", h) for i, h, *_ in pages], "page_id int, url string, html string")
    got = {r.page_id: (r.title, r.description, r.url) for r in N.html_article_extract(df).collect()}
    for i, _, *want in pages:
        assert got[i] == tuple(want), i


def test_radix_quantiles_equal_percentile(spark):
    from marketweave.operators.quantiles import exact_quantiles

    t = spark.range(0, 50000).select((F.col("id") % 4).alias("g"),
                                     ((F.col("id") * 7919) % 1013 / 7.0).alias("v"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r.g, r.p): r for r in exact_quantiles(t, ["v"], probs, by=["g"]).collect()}
    want = {r.g: r.q for r in t.groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()}
    for g in range(4):
        for i, p in enumerate(probs):
            assert got[(g, p)].value == pytest.approx(want[g][i], abs=1e-12)


def test_radix_quantiles_small_groups(spark):
    from marketweave.operators.quantiles import exact_quantiles

    rows = [(g, float(v)) for g in range(1, 7) for v in range(g)]
    t = spark.createDataFrame(rows, "g int, v double")
    probs = [0.25, 0.5, 0.75]
    got = {(r.g, r.p): r for r in exact_quantiles(t, ["v"], probs, by=["g"]).collect()}
    want = {r.g: r.q for r in t.groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()}
    for g in range(1, 7):
        for i, p in enumerate(probs):
            assert got[(g, p)].value == pytest.approx(want[g][i])


def test_prediction_text_markers(spark):
    df = spark.createDataFrame([(1.234, 0.85), (-0.456, 0.5), (0.0, 1.0)], "v double, c double")
    got = [r.t for r in df.select(A.prediction_text("v", "c").alias("t")).collect()]
    assert got == ["📈 +1.23 (85.0% confidence)", "📉 -0.46 (50.0% confidence)",
                   "📉 0.00 (100.0% confidence)"]


def test_valence_context_rules(spark):
    lex = spark.createDataFrame([("good", 2.0)], "token string, valence double")
    df = spark.createDataFrame([(1, "not good"), (2, "very good"), (3, "not very good")],
                               "id int, text string")
    got = {r.id: r.text_compound for r in X.lexicon_valence(
        df, ["id"], lex, negations=["not"], boosters={"very": 0.293}).collect()}

    def comp(s):
        return s / (s * s + 15) ** 0.5
    assert got[1] == pytest.approx(comp(2.0 * X.N_SCALAR))
    assert got[2] == pytest.approx(comp(2.293))
    assert got[3] == pytest.approx(comp(2.293 * X.N_SCALAR))


def test_upsert_applies_batch_rows_in_order_per_field(spark):
    t = spark.createDataFrame([(1, "old", 0.0, "s")], "k int, name string, x double, seg string")
    n = spark.createDataFrame([(1, "a", None, None, 1), (1, None, 2.0, None, 2),
                               (1, "b", None, None, 3), (7, None, 5.0, "z", 1)],
                              "k int, name string, x double, seg string, o int")
    got = {r.k: r for r in TB.upsert_merge(t, n, ["k"], ["o"], "2024-01-01 00:00:00").collect()}
    assert (got[1].name, got[1].x, got[1].seg) == ("b", 2.0, "s")
    assert (got[7].name, got[7].x, got[7].seg, got[7].action) == (None, 5.0, "z", "insert")


def test_upsert_tells_set_to_null_from_absent(spark):
    """Present fields are named per row: a null that is set replaces, an absent field stays."""
    texts = [(1, '{"k": 1, "x": null}'), (2, '{"k": 1, "name": "a"}'), (3, '{"k": 1, "name": null}'),
             (1, '{"k": 2, "x": 2.5, "name": null}'), (2, '{"k": 2}'), (1, '{"k": 7, "x": null, "new": "n"}')]
    n = spark.createDataFrame(texts, "o int, d string").select(
        "o", F.from_json("d", "k int, name string, x double, new string").alias("r"),
        TB.document_fields(F.col("d")).alias(TB.FIELDS)).select("o", "r.*", TB.FIELDS)
    t = spark.createDataFrame([(1, "old", 1.0, "s"), (2, "old", 1.0, "s"), (3, "old", 1.0, "s")],
                              "k int, name string, x double, seg string")
    got = {r.k: r for r in TB.upsert_merge(t, n, ["k"], ["o"], "2024-01-01 00:00:00").collect()}
    assert [(got[k].name, got[k].x, got[k].seg, got[k].new) for k in (1, 2, 3, 7)] == [
        (None, None, "s", None), (None, 2.5, "s", None), ("old", 1.0, "s", None), (None, None, None, "n")]
    assert got[1][TB.FIELDS] == ["k", "name", "x"] and got[3][TB.FIELDS] == []
    # again, onto the merged table: what was stored keeps its fields
    again = TB.upsert_merge(TB.upsert_merge(t, n, ["k"], ["o"], "2024-01-01 00:00:00", False),
                            n.where("k = 7"), ["k"], ["o"], "2024-01-02 00:00:00")
    assert {r.k: r[TB.FIELDS] for r in again.collect()}[1] == ["k", "name", "x"]
    none = n.withColumn(TB.FIELDS, F.lit(None).cast("array<string>"))
    assert {r.k: r.name for r in TB.upsert_merge(t, none, ["k"], ["o"], "2024-01-01 00:00:00").collect()}[1] == "old"


def test_stored_records_follow_their_arrival(spark):
    """9.0, then 1.0 for one key: the last write wins; a last record without a value sets null."""
    from marketweave.operators.collect import store

    rows = [("i", "US", "2020", 9.0, 1), ("i", "US", "2020", 1.0, 2), ("i", "GB", "2020", 3.0, 1),
            ("i", "GB", "2020", None, 2)]
    df = spark.createDataFrame(rows, "indicator string, country string, date string, value double, loaded int")
    w = store("macro", df, None, "2024-01-01 00:00:00", "doc_id", ["loaded"])
    assert {r.country: r.value for r in w.table.collect()} == {"US": 1.0, "GB": None}
    assert "loaded" not in w.table.columns
    later = store("macro", df.where("loaded = 1"), w.table, "2024-01-02 00:00:00", "doc_id", ["loaded"])
    assert {r.country: r.value for r in later.table.collect()} == {"US": 9.0, "GB": 3.0}
    with pytest.raises(ValueError):
        store("macro", df, None, "2024-01-01 00:00:00", "doc_id")


def test_collect_run_processes_records_once(spark):
    """The new table and the counts are read from the stored records, not made anew."""
    from marketweave.operators.collect import collect_run

    df = spark.createDataFrame(
        [(1, "up we go", "Mon Jan 01 10:00:00 +0000 2024"), (2, "down", "Mon Jan 01 11:00:00 +0000 2024"),
         (3, "up we go", "Mon Jan 01 12:00:00 +0000 2024"), (4, "x", "never")], "doc_id long, text string, created_at string")
    df = df.withColumn("lang", F.lit("en"))
    old, _ = collect_run({"messages": df.where("doc_id = 2")}, {}, "2024-01-02 00:00:00")
    written, failed = collect_run({"messages": df}, {"messages": old["messages"].table}, "2024-01-02 00:00:00")
    assert not failed
    w = written["messages"]
    assert {r.action: r.n for r in w.counts.collect()} == {"insert": 1, "duplicate": 1}
    assert sorted((r.doc_id, r.text) for r in w.table.collect()) == [(1, "up we go"), (2, "down")]
    for made in (w.table, w.counts):
        assert made.inputFiles() and all("records-messages" in f for f in made.inputFiles())


def test_models_scored_are_compared_with_the_spread(spark, monkeypatch):
    """A model whose error is beyond twice the spread of the returns is told apart."""
    from marketweave.plans import feature_queries as Q
    from tests.conftest import SMALL

    monkeypatch.setattr(Q.MO, "train_models", lambda rows, names=("linear", "lasso"): {
        n: Q.LI.LinearModel(("h",), 0.0 if n == "linear" else 1000.0, (0.0,)) for n in ("linear", "lasso")})
    rows = Q.q_train_models_scored(spark, SMALL).collect()
    assert len(rows) == 4
    assert {(r.model, r.beats_noise) for r in rows} == {("linear", True), ("lasso", False)}
