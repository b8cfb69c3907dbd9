"""Registered per-kind processing queries (clean → score → storage form)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketweave.operators.collect import collect_run
from marketweave.operators.process import process_all, process_kind
from marketweave.plans.catalog import D, R, query, report
from marketweave.plans.market_queries import _CLEAN_SRC, _ffill_sql
from marketweave.plans.sentiment_queries import SCORES, _vader_bucket_sql, valence_sql
from marketweave.plans.text_queries import (_CLEAN_MACRO_SQL, AS_OF, blank_sql, clean_text_sql,
                                            news_date_sql, social_date_sql, strip_sql)
from marketweave.session import scratch_path
from marketweave.sources import fixtures as fx


def iso_sql(ts: str, alias: str) -> str:
    return (f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({ts}, '%f') <> '000000' "
            f"THEN '.' || strftime({ts}, '%f') ELSE '' END AS {alias}")


def _scores_sql(prefix: str) -> str:
    cols = ", ".join(R(f"coalesce(sc.{prefix}_{s}, 0.0)", f"{prefix}_{s}") for s in SCORES)
    return f"{cols}, {_vader_bucket_sql(f'coalesce(sc.{prefix}_compound, 0.0)')} AS sentiment"


_TWEETS = f"""
    SELECT doc_id, text, ts, lang, event_type, coalesce(lang = 'en', false) AS is_english,
           {clean_text_sql('text')} AS cleaned_text, '{AS_OF[:10]}' AS processed_date
    FROM (SELECT *, {social_date_sql('created_at')} AS ts FROM v_tweets_raw)
    WHERE ts IS NOT NULL AND NOT {blank_sql('text')}
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"""

_ROUND = tuple(f"{p}_{s}" for p in ("text", "title") for s in SCORES)


@query("process_tweets", f"""
    SELECT c.doc_id, c.text, {iso_sql('c.ts', 'created_at')}, c.lang, c.event_type,
           c.is_english, c.cleaned_text, c.processed_date, {_scores_sql('text')}
    FROM ({_TWEETS}) c
    LEFT JOIN ({valence_sql(_TWEETS, 'doc_id', 'text', 'text')}) sc ON c.doc_id = sc.doc_id""",
       ("v_tweets_raw", "v_lexicon"))
def q_process_tweets(spark, sf):
    p = process_kind(fx.tweets_raw(spark, sf), "messages", AS_OF, fx.lexicon(spark))
    return report(p, round_cols=_ROUND)


_NEWS = f"""
    SELECT doc_id, coalesce(title, '') AS title, coalesce(description, '') AS description,
           ts, coalesce(author, 'Unknown') AS author, coalesce(source, 'Unknown') AS source,
           coalesce(url, '') AS url, coalesce(country, 'N/A') AS country,
           '{AS_OF[:10]}' AS processed_date, CAST(0.0 AS DOUBLE) AS sentiment_score
    FROM (SELECT *, {news_date_sql('"publishedAt"')} AS ts FROM v_news_raw
          QUALIFY row_number() OVER (PARTITION BY title, description ORDER BY doc_id) = 1)
    WHERE NOT ({strip_sql("coalesce(title, '')")} = '' AND
               {strip_sql("coalesce(description, '')")} = '')"""


@query("process_news", f"""
    SELECT c.doc_id, c.title, c.description, {iso_sql('c.ts', '"publishedAt"')}, c.author,
           c.source, c.url, c.country, c.processed_date, c.sentiment_score, {_scores_sql('title')}
    FROM ({_NEWS}) c
    LEFT JOIN ({valence_sql(_NEWS, 'doc_id', 'title', 'title')}) sc ON c.doc_id = sc.doc_id""",
       ("v_news_raw", "v_lexicon"))
def q_process_news(spark, sf):
    p = process_kind(fx.news_raw(spark, sf), "news", AS_OF, fx.lexicon(spark))
    return report(p, round_cols=_ROUND)


_POSTS = f"""
    SELECT conv_id, title, subreddit, score, over_18,
           make_timestamp(CAST(created_at * 1000000 AS BIGINT)) AS ts,
           CAST(len(list_filter(comments, lambda c: c.comment_text IS NOT NULL
                                          AND c.comment_text <> '')) AS INTEGER)
             AS valid_comments_count,
           concat_ws(' ', title, list_aggregate(list_transform(comments,
                     lambda c: c.comment_text), 'string_agg', ' ')) AS combined_text,
           '{AS_OF[:10]}' AS processed_date
    FROM v_posts_raw WHERE title IS NOT NULL AND subreddit IS NOT NULL"""


@query("process_posts", f"""
    SELECT c.conv_id, c.title, c.subreddit, c.score, c.over_18, {iso_sql('c.ts', 'created_at')},
           c.valid_comments_count, c.combined_text, c.processed_date, {_scores_sql('title')}
    FROM ({_POSTS}) c
    LEFT JOIN ({valence_sql(_POSTS, 'conv_id', 'title', 'title')}) sc
      ON c.conv_id = sc.conv_id""", ("v_posts_raw", "v_lexicon"))
def q_process_posts(spark, sf):
    """Posts processed with their comments scored in place; the report leaves the nested
    comment array out (post-level columns only)."""
    p = process_kind(fx.posts_raw(spark, sf), "posts", AS_OF, fx.lexicon(spark),
                     id_col="conv_id")
    return report(p.drop("comments"), round_cols=_ROUND)


@query("process_stock", f"""
    SELECT symbol, {D('date', 'date')}, open, high, low, close, volume,
           {R('close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1',
              'daily_return')},
           dayname(date) AS day_of_week, monthname(date) AS month
    FROM ({_ffill_sql(_CLEAN_SRC)})""", ("v_bars_dirty",))
def q_process_stock(spark, sf):
    p = process_kind(fx.bars_dirty(spark, sf), "stock", AS_OF)
    return report(p, round_cols=("daily_return",))


@query("process_macro", f"""
    SELECT indicator, country, {iso_sql('d', 'date')}, value, year, country_code, country_name
    FROM ({_CLEAN_MACRO_SQL.replace("strftime(d, '%Y-%m-%d %H:%M:%S.%f') AS date", "d")})
    ORDER BY d DESC NULLS LAST, country""", ("v_econ_raw",))
def q_process_macro(spark, sf):
    return process_kind(fx.econ_raw(spark, sf), "macro", AS_OF)



@query("process_all_kinds", f"""
    SELECT 'stock' AS kind, count(*) AS n_rows FROM ({_ffill_sql(_CLEAN_SRC)})
    UNION ALL SELECT 'news', count(*) FROM ({_NEWS})
    UNION ALL SELECT 'messages', count(*) FROM ({_TWEETS})
    UNION ALL SELECT 'posts', count(*) FROM ({_POSTS})
    UNION ALL SELECT 'macro', count(*) FROM v_econ_raw""",
       ("v_bars_dirty", "v_news_raw", "v_tweets_raw", "v_posts_raw", "v_econ_raw"))
def q_process_all_kinds(spark, sf):
    """All five kinds processed in one run, one table per kind (a failing kind does not
    stop the others); the report counts each written table."""
    root = scratch_path(spark, "processed")
    frames = {"stock": fx.bars_dirty(spark, sf), "news": fx.news_raw(spark, sf),
              "messages": fx.tweets_raw(spark, sf), "posts": fx.posts_raw(spark, sf),
              "macro": fx.econ_raw(spark, sf)}
    status = process_all(frames, root, AS_OF, fx.lexicon(spark), {"posts": "conv_id"})
    failed = [s for s in status if s[2] != "ok"]
    if failed:
        raise RuntimeError(f"kinds failed: {failed}")
    parts = [spark.read.parquet(path).groupBy().count()
             .select(F.lit(kind).alias("kind"), F.col("count").alias("n_rows"))
             for kind, path, _ in status]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("stream_process_news", f"""
    SELECT c.doc_id, c.title, c.description, {iso_sql('c.ts', '"publishedAt"')}, c.author,
           c.source, c.url, c.country, c.processed_date, c.sentiment_score, {_scores_sql('title')}
    FROM ({_NEWS}) c
    LEFT JOIN ({valence_sql(_NEWS, 'doc_id', 'title', 'title')}) sc ON c.doc_id = sc.doc_id""",
       ("v_news_raw", "v_lexicon"))
def q_stream_process_news(spark, sf):
    """The collection loop as a stream: document files (three here, in order of their ids) are
    shaped into articles, and each micro-batch is cleaned, scored and stored; an article whose
    title and description were stored by an earlier batch is dropped, so the table equals
    the batch form."""
    from marketweave.plans.stream_queries import _landed
    from marketweave.streaming import jobs as J

    out = scratch_path(spark, "news-stream")
    lex = fx.lexicon(spark)
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source")
    part = (F.col("doc_id").cast("double") / (d.select(F.max("doc_id")).scalar() + 1) * 3).cast("int")
    raw = _landed(spark, fx.news_from_documents(d).withColumn("part", part), 3)
    store = J.dedup_sink(out, ["raw_title", "raw_description"], ["doc_id"])

    def sink(batch, batch_id):
        # the cleaner compares articles as collected, so the raw pair is the key
        keyed = batch.select("doc_id", F.col("title").alias("raw_title"),
                             F.col("description").alias("raw_description"))
        done = process_kind(batch, "news", AS_OF, lex)
        store(done.join(keyed, "doc_id"), batch_id)

    J.finish(J.start(raw, sink, scratch_path(spark, "stream-ckpt")))
    t = spark.read.parquet(out).drop("batch", "raw_title", "raw_description", "_key_hash", "slot")
    return report(t, round_cols=_ROUND)


# ------------------------------------------------------------ the end-to-end run

def _two_runs(kind: str, first: str, every: str, key: str, upsert: bool) -> str:
    """Write counts of two runs: the first over part of the records, the second over all."""
    if upsert:
        return f"""
    SELECT 1 AS run, '{kind}' AS kind, 'insert' AS action, count(*) AS n FROM ({first})
    UNION ALL SELECT 2, '{kind}', 'update', count(*) FROM ({first})
    UNION ALL SELECT 2, '{kind}', 'insert', (SELECT count(*) FROM ({every})) - count(*) FROM ({first})"""
    return f"""
    SELECT 1 AS run, '{kind}' AS kind, 'insert' AS action, count(DISTINCT {key}) AS n FROM ({first})
    UNION ALL SELECT 1, '{kind}', 'duplicate', count(*) - count(DISTINCT {key}) FROM ({first})
    UNION ALL SELECT 2, '{kind}', 'insert', (SELECT count(DISTINCT {key}) FROM ({every})
                                             WHERE {key} NOT IN (SELECT {key} FROM ({first})))
    UNION ALL SELECT 2, '{kind}', 'duplicate', (SELECT count(*) FROM ({every})) -
      (SELECT count(DISTINCT {key}) FROM ({every}) WHERE {key} NOT IN (SELECT {key} FROM ({first})))"""


_HALF_TWEETS = _TWEETS.replace("FROM v_tweets_raw)", "FROM v_tweets_raw WHERE doc_id % 2 = 0)")
_ECON_KEY = "SELECT DISTINCT indicator, country, date FROM v_econ_raw"
_RUNS_SQL = " UNION ALL ".join((
    _two_runs("messages", _HALF_TWEETS, _TWEETS, "text", False),
    _two_runs("macro", _ECON_KEY + " WHERE indicator <> 'P'", _ECON_KEY, "", True)))


_LAST_MACRO = """
    SELECT indicator, country, date || '-01-01T00:00:00' AS date, TRY_CAST(value AS DOUBLE) AS value
    FROM v_econ_raw"""


def _collection_runs(spark, sf):
    """Two collection runs: the first sees half of the records, the second all of them. Macro
    records arrive twice in every run, first with a far larger value, so a table that kept any
    but the last would show it. Yields ``(run, written, stored)``."""
    lex, stored = fx.lexicon(spark), {}
    tweets, econ = fx.tweets_raw(spark, sf), fx.econ_raw(spark, sf)
    econ = econ.withColumn("loaded", F.explode(F.array(F.lit(1), F.lit(2))))
    econ = econ.withColumn("value", F.when(F.col("loaded") == 1, F.lit("9e15")).otherwise(F.col("value")))
    runs = ({"messages": tweets.where("doc_id % 2 = 0"), "macro": econ.where("indicator <> 'P'")},
            {"messages": tweets, "macro": econ})
    for i, frames in enumerate(runs, 1):
        written, failed = collect_run(frames, stored, AS_OF, lex, arrival={"macro": ["loaded"]})
        if failed:
            raise RuntimeError(f"kinds failed: {failed}")
        for kind, w in written.items():
            path = scratch_path(spark, f"run{i}-{kind}")
            w.table.write.parquet(path)
            stored[kind] = spark.read.parquet(path)
        yield i, written, dict(stored)


@query("collect_run", f"""
    SELECT r.*, v.values_sum FROM ({_RUNS_SQL}) r LEFT JOIN (
      SELECT 1 AS run, 'macro' AS kind, {R('sum(value)', 'values_sum')} FROM ({_LAST_MACRO}) WHERE indicator <> 'P'
      UNION ALL SELECT 2, 'macro', {R('sum(value)', 'values_sum')} FROM ({_LAST_MACRO})) v USING (run, kind)
    WHERE n > 0""", ("v_tweets_raw", "v_econ_raw"))
def q_collect_run(spark, sf):
    """Two collection runs, processed, hashed, deduplicated against what is stored, routed to
    upsert (macro) or insert-ignore (messages), with the write counts of each run and the sum
    of the values that the macro table then holds."""
    out = None
    for i, written, stored in _collection_runs(spark, sf):
        total = stored["macro"].select(F.round(F.sum("value"), 6)).scalar()
        for kind, w in written.items():
            n = w.counts.select(F.lit(i).alias("run"), "kind", "action", F.col("n").cast("bigint").alias("n"),
                                F.when(F.col("kind") == "macro", total).alias("values_sum"))
            out = n if out is None else out.unionByName(n)
    return out.where("n > 0")


@query("collect_run_values", _LAST_MACRO, ("v_econ_raw",))
def q_collect_run_values(spark, sf):
    """The macro table after two runs: per key the value that arrived last, null where the last
    record had none."""
    *_, (_, _, stored) = _collection_runs(spark, sf)
    return stored["macro"].select("indicator", "country", "date", "value")
