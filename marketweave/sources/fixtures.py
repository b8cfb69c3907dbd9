"""Market-shaped views derived by Spark from the given tables.

The given data set is a TPC-H-like star schema plus text tables; the operators of this
library work on price bars, news, short messages, forum threads and macro series. Each
function below derives one such input from the given tables, so every job's work grows
with the data. Dirty values (outliers, nulls, unparseable dates, blank text) are injected
by ``id % n`` rules because the source tables have none.

The DuckDB text of the same definitions lives in ``marketweave.plans.oracle_views``;
the two must stay equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketweave.functions.text import tokens
from marketweave.sources.tables import read_table

# Fixed values of the fixtures: the four search terms used to tag short messages and
# the small lexicon / term tables (parameters of the sentiment and keyword jobs).
SEARCH_TERMS = ["interest rates", "supply chain", "quarterly earnings", "energy prices"]
LEXICON_ROWS = [("the", 1.9), ("of", -1.5), ("and", 0.8), ("is", -2.2), ("that", 2.5),
                ("was", -3.1), ("de", 0.6), ("la", -1.2)]
POLARITY_ROWS = [("the", 0.3, 0.5), ("of", -0.2, 0.1), ("and", 0.1, 0.9),
                 ("is", -0.4, 0.2), ("et", 0.5, 0.6), ("la", -0.6, 0.4)]
# Fixture parameters of the context rules (frequent words of the invented prose, so the
# rules fire; not a published negation / booster list).
NEGATION_WORDS = ["in", "un", "die"]
BOOSTER_WORDS = {"to": 0.293, "le": -0.293, "for": 0.293}
TERM_ROWS = [("t1", "the"), ("t1", "was"), ("t2", "from"), ("t2", "this"), ("t2", "are")]
BASE_TS = "2024-01-01 00:00:00"


def _base_ts(minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, F.lit(BASE_TS).cast("timestamp_ntz"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars per symbol (= part brand) from lineitem ⋈ part.

    The join is left to the planner: part is a dimension whose size grows with the
    scale factor, so AQE converts it to a broadcast from measured sizes when small and
    keeps a shuffled join otherwise. The group-by is partially aggregated map-side, so a
    hot brand only ships one partial row per (brand, day) per task.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber",
                    "l_quantity", "l_discount", "l_tax", "l_shipdate")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_retailprice")
    j = li.join(part, li.l_partkey == part.p_partkey)
    px = F.col("p_retailprice") * (F.lit(0.9) + F.col("l_discount") + F.col("l_tax"))
    j = j.select(F.col("p_brand").alias("symbol"), F.to_date("l_shipdate").alias("date"),
                 "l_orderkey", "l_linenumber", "l_quantity", px.alias("px"))
    # open / close: price of the first / last line of the day in (order, line, price)
    # order — the min / max of that struct, whose last field is the price itself
    key = F.struct("l_orderkey", "l_linenumber", "px")
    return (j.groupBy("symbol", "date")
             .agg(F.min(key)["px"].alias("open"), F.max("px").alias("high"),
                  F.min("px").alias("low"), F.max(key)["px"].alias("close"),
                  F.sum("l_quantity").cast("bigint").alias("volume")))


def bars_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bars`` with close x50 on every 23rd bar and volume null on every 17th bar."""
    w = Window.partitionBy("symbol").orderBy("date")
    b = bars(spark, sf_dir).withColumn("_rn", F.row_number().over(w))
    return (b.withColumn("close", F.when(F.col("_rn") % 23 == 0, F.col("close") * 50)
                                   .otherwise(F.col("close")))
             .withColumn("volume", F.when(F.col("_rn") % 17 == 0, F.lit(None).cast("bigint"))
                                    .otherwise(F.col("volume")))
             .drop("_rn"))


def sentiment_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sentiment per symbol from orders: score in [-1, 1], message volume."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return (o.groupBy(F.concat(F.lit("Brand#"), (F.col("o_custkey") % 25 + 1).cast("string"))
                       .alias("symbol"),
                      F.to_date("o_orderdate").alias("date"))
             .agg(F.avg((F.col("o_orderkey") % 201 - 100).cast("double") / 100)
                   .alias("sentiment_score"),
                  F.count(F.lit(1)).alias("volume")))


def sent_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars ⋈ daily sentiment on (symbol, date) — the dashboard's correlation input."""
    b = bars(spark, sf_dir).select("symbol", "date", F.col("close").alias("price"),
                                   F.col("volume").alias("price_volume"))
    s = sentiment_daily(spark, sf_dir).select("symbol", "date", "sentiment_score",
                                              F.col("volume").alias("sentiment_volume"))
    return b.join(s, ["symbol", "date"], "inner")


def news_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News articles from documents: title = first line, description = all that follows,
    with missing titles, blank descriptions, null authors and publishedAt written in six
    ways (4 formats, junk, null)."""
    return news_from_documents(read_table(spark, sf_dir, "documents", "doc_id", "text",
                                          "source"))


def news_from_documents(d: DataFrame) -> DataFrame:
    """The row-wise shaping of ``news_raw`` (also usable on a stream of documents)."""
    k = F.col("doc_id")
    ts = _base_ts(k)
    published = (F.when(k % 6 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
                  .when(k % 6 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'.000Z'"))
                  .when(k % 6 == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
                  .when(k % 6 == 3, F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
                  .when(k % 6 == 4, F.lit("not a date")))
    return d.select(
        "doc_id",
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.substring_index("text", "\n", 1)).alias("title"),
        F.when(k % 11 == 0, F.lit(" \t ")).when(F.instr("text", "\n") > 0, F.expr(
            "substring(text, instr(text, '\\n') + 1)")).otherwise(F.lit("")).alias("description"),
        published.alias("publishedAt"),
        F.when(k % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("author"), (k % 37).cast("string"))).alias("author"),
        "source",
        F.concat(F.lit("https://news.example/a/"), k.cast("string")).alias("url"),
        F.lit(None).cast("string").alias("country"))


def tweets_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short messages from documents: URL / mention / hashtag prefixes, blank and null
    texts, created_at in the weekday form (some unparseable), four search terms."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    k = F.col("doc_id")
    prefix = (F.when(k % 4 == 0, F.lit("https://t.co/x1 ")).when(k % 4 == 1, F.lit("@né_1 "))
               .when(k % 4 == 2, F.lit("#été2024 ")).otherwise(F.lit("www.a.b/c ")))
    text = (F.when(k % 37 == 0, F.lit(None).cast("string")).when(k % 31 == 0, F.lit("  \n "))
             .otherwise(F.concat(prefix, F.col("text"))))
    ts = _base_ts(k * 7)
    created = F.when(k % 19 == 0, F.lit("yesterday")).otherwise(
        F.date_format(ts, "EEE MMM dd HH:mm:ss '+0000' yyyy"))
    terms = F.array(*[F.lit(t) for t in SEARCH_TERMS])
    return d.select("doc_id", text.alias("text"), created.alias("created_at"), "lang",
                    F.element_at(terms, (k % 4 + 1).cast("int")).alias("event_type"))


def posts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forum threads from conversations: turn 0 is the post, later turns its comments.

    Every comment stays (``top_comments`` makes the collector's cut); a thread's comments
    are one array ordered by turn, as the threads are delivered.
    """
    rows = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    k = F.col("conv_id")
    score = (F.length("text") % 50).cast("bigint")
    cm = F.struct(F.col("turn").alias("pos"), F.col("text").alias("comment_text"),
                  score.alias("comment_score"))
    g = (rows.groupBy("conv_id")
             .agg(F.max(F.when(F.col("turn") == 0, F.col("text"))).alias("title"),
                  F.array_sort(F.collect_list(F.when(F.col("turn") > 0, cm))).alias("comments")))
    return g.select(
        "conv_id", "title",
        F.when(k % 17 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("sub"), (k % 5).cast("string"))).alias("subreddit"),
        (F.coalesce(F.length("title"), F.lit(0)) % 40).cast("bigint").alias("score"),
        (k % 10 == 0).alias("over_18"),
        (F.lit(1704067200) + F.lit(3600) * k).cast("double").alias("created_at"),
        "comments")


def econ_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro series (indicator x country x year) from orders ⋈ customer ⋈ nation; the
    value is text, ``n/a`` on every 7th count; country is a 2-letter code for regions
    0-3 and the nation name otherwise."""
    o = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus", "o_totalprice",
                   "o_orderdate")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    country = (F.when(F.col("n_regionkey") == 0, F.lit("US"))
                .when(F.col("n_regionkey") == 1, F.lit("GB"))
                .when(F.col("n_regionkey") == 2, F.lit("CN"))
                .when(F.col("n_regionkey") == 3, F.lit("IN")).otherwise(F.col("n_name")))
    # nation is fixed at 25 rows by the schema: a bounded broadcast.
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")))
    g = (j.groupBy(F.col("o_orderstatus").alias("indicator"), country.alias("country"),
                   F.year("o_orderdate").cast("string").alias("date"))
          .agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("_v"),
               F.count(F.lit(1)).alias("_n")))
    return g.select("indicator", "country", "date",
                    F.when(F.col("_n") % 7 == 0, F.lit("n/a"))
                     .otherwise(F.col("_v").cast("string")).alias("value"))


def event_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bars per symbol with the close as price (input of the event page)."""
    return bars(spark, sf_dir).select("symbol", "date", F.col("close").alias("price"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive forecasts to score: predicted price = previous close, predicted return =
    previous return; the first two bars per symbol have no prediction and are dropped."""
    w = Window.partitionBy("symbol").orderBy("date")
    b = bars(spark, sf_dir).select("symbol", "date", F.col("close").alias("actual_price"))
    prev = F.lag("actual_price").over(w)
    b = (b.withColumn("predicted_price", prev)
          .withColumn("actual_return", F.try_divide(F.col("actual_price"), prev) - 1)
          .withColumn("_rn", F.row_number().over(w)))
    b = b.withColumn("predicted_return", F.lag("actual_return").over(w))
    return b.where("_rn > 2").drop("_rn")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON_ROWS, "token string, valence double")


def large_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon from the documents themselves: half of all distinct tokens (by their MD5),
    with valences from -4 to 4; tens of thousands of entries at the smallest scale."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    t = d.select(F.explode(F.array_distinct(tokens("text"))).alias("token")).distinct()
    bits = lambda a, n: F.conv(F.substring(F.md5("token"), a, n), 16, 10).cast("int")
    return t.where(bits(1, 2) < 128).select(
        "token", ((bits(3, 4) % 81 - 40).cast("double") / 10).alias("valence"))


def polarity_lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POLARITY_ROWS,
                                 "token string, polarity double, subjectivity double")


def terms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TERM_ROWS, "term string, token string")
