"""Registered queries for news, short messages, forum posts and macro series."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketweave.functions.dates import parse_news_date
from marketweave.functions.text import clean_text
from marketweave.operators import macro as M
from marketweave.operators import news as N
from marketweave.operators import posts as P
from marketweave.operators import social as SO
from marketweave.operators.analytics import union_frames
from marketweave.plans.catalog import TS, query, report, tstxt
from marketweave.sources import fixtures as fx
from marketweave.sources.tables import read_table

AS_OF = "2024-06-30 00:00:00"

# DuckDB spellings of the shared text rules
WORD = r"[\p{L}\p{N}_]"


def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def clean_text_sql(x: str) -> str:
    c = rf"regexp_replace({x}, 'http\S+|www\S+', '', 'g')"
    c = f"regexp_replace({c}, '@{WORD}+', '', 'g')"
    c = f"regexp_replace({c}, '#{WORD}+', '', 'g')"
    c = f"replace({c}, chr(10), ' ')"
    c = strip_sql(c)
    return rf"regexp_replace({c}, '\s+', ' ', 'g')"


def news_date_sql(x: str, default: str | None = f"TIMESTAMP '{AS_OF}'") -> str:
    parts = [f"try_strptime({x}, '%Y-%m-%dT%H:%M:%SZ')",
             f"try_strptime({x}, '%Y-%m-%dT%H:%M:%S.%fZ')",
             f"try_strptime({x}, '%Y-%m-%d %H:%M:%S')",
             f"CASE WHEN regexp_matches({x}, '^[A-Z][a-z]{{2}}, ') THEN "
             f"try_strptime(substr({x}, 6), '%d %b %Y %H:%M:%S GMT') END"]
    if default:
        parts.append(default)
    return "coalesce(" + ", ".join(parts) + ")"


def social_date_sql(x: str) -> str:
    return (f"coalesce(CASE WHEN regexp_matches({x}, '^[A-Z][a-z]{{2}} [A-Z][a-z]{{2}} ') THEN "
            f"try_strptime(substr({x}, 5), '%b %d %H:%M:%S +0000 %Y') END, "
            f"try_strptime({x}, '%Y-%m-%dT%H:%M:%S.%fZ'), "
            f"try_strptime({x}, '%Y-%m-%dT%H:%M:%SZ'), try_strptime({x}, '%Y-%m-%d %H:%M:%S'))")


def blank_sql(x: str) -> str:
    return f"({x} IS NULL OR {strip_sql(x)} = '')"


# ------------------------------------------------------------ news

@query("ensure_columns", """
    SELECT doc_id, title, description, "publishedAt", 'No source available' AS source,
           'No url available' AS url FROM v_news_raw""", ("v_news_raw",))
def q_ensure_columns(spark, sf):
    n = fx.news_raw(spark, sf).select("doc_id", "title", "description", "publishedAt")
    return N.ensure_columns(n)


@query("parse_dates_news", f"""
    SELECT doc_id, "publishedAt" AS raw, {TS(news_date_sql('"publishedAt"'), 'published_ts')}
    FROM v_news_raw""", ("v_news_raw",))
def q_parse_dates_news(spark, sf):
    n = fx.news_raw(spark, sf)
    return n.select("doc_id", F.col("publishedAt").alias("raw"),
                    tstxt(parse_news_date("publishedAt", F.lit(AS_OF).cast("timestamp")))
                    .alias("published_ts"))


@query("dedup_title_desc", """
    SELECT doc_id, title, description FROM v_news_raw
    QUALIFY row_number() OVER (PARTITION BY title, description ORDER BY doc_id) = 1""",
       ("v_news_raw",))
def q_dedup_title_desc(spark, sf):
    n = fx.news_raw(spark, sf).select("doc_id", "title", "description")
    return N.dedup_title_desc(n, ["doc_id"])


@query("drop_blank_articles", f"""
    SELECT doc_id, coalesce(title, '') AS title, coalesce(description, '') AS description
    FROM v_news_raw
    WHERE NOT ({strip_sql("coalesce(title, '')")} = '' AND
               {strip_sql("coalesce(description, '')")} = '')""", ("v_news_raw",))
def q_drop_blank_articles(spark, sf):
    n = fx.news_raw(spark, sf).select("doc_id", "title", "description")
    return N.drop_blank_articles(n)


@query("fill_defaults", """
    SELECT doc_id, coalesce(author, 'Unknown') AS author, coalesce(source, 'Unknown') AS source,
           coalesce(url, '') AS url, coalesce(country, 'N/A') AS country,
           CAST(0.0 AS DOUBLE) AS sentiment_score
    FROM v_news_raw""", ("v_news_raw",))
def q_fill_defaults(spark, sf):
    n = fx.news_raw(spark, sf).select("doc_id", "author", "source", "url", "country")
    return N.fill_defaults(n)


_CLEAN_NEWS_SQL = f"""
    SELECT doc_id, coalesce(title, '') AS title, coalesce(description, '') AS description,
           {TS('ts', '"publishedAt"')}, coalesce(author, 'Unknown') AS author,
           coalesce(source, 'Unknown') AS source, coalesce(url, '') AS url,
           coalesce(country, 'N/A') AS country, '{AS_OF[:10]}' AS processed_date,
           CAST(0.0 AS DOUBLE) AS sentiment_score
    FROM (SELECT *, {news_date_sql('"publishedAt"')} AS ts FROM v_news_raw
          QUALIFY row_number() OVER (PARTITION BY title, description ORDER BY doc_id) = 1)
    WHERE NOT ({strip_sql("coalesce(title, '')")} = '' AND
               {strip_sql("coalesce(description, '')")} = '')"""


@query("clean_news", _CLEAN_NEWS_SQL, ("v_news_raw",))
def q_clean_news(spark, sf):
    c = N.clean_news(fx.news_raw(spark, sf), AS_OF)
    return report(c, ts_cols=("publishedAt",))


@query("default_row_if_empty", """
    SELECT 'No Title' AS title, 'No Description' AS description WHERE NOT EXISTS
      (SELECT 1 FROM v_news_raw WHERE doc_id < 0)""", ("v_news_raw",))
def q_default_row_if_empty(spark, sf):
    """Cleaned news of an id range that holds none: the placeholder row alone."""
    c = N.clean_news(fx.news_raw(spark, sf).where("doc_id < 0"), AS_OF)
    return N.default_row_if_empty(c.select("title", "description"),
                                  {"title": "No Title", "description": "No Description"})


@query("unnest_articles", """
    SELECT coalesce(title, '') AS title, coalesce(description, '') AS description,
           coalesce("publishedAt", '') AS "publishedAt", coalesce(author, '') AS author,
           coalesce(source, 'Unknown') AS source, coalesce(url, '') AS url,
           coalesce(country, 'N/A') AS country
    FROM v_news_raw""", ("v_news_raw",))
def q_unnest_articles(spark, sf):
    """Articles packed as API payloads (``{"articles": [...]}``, 50 per payload) and
    unnested back."""
    n = fx.news_raw(spark, sf)
    art = F.struct("title", "description", "publishedAt", "author",
                   F.struct(F.col("source").alias("name")).alias("source"), "url", "country")
    payloads = (n.groupBy("source", (F.col("doc_id") / 50).cast("bigint").alias("page"))
                 .agg(F.to_json(F.struct(F.collect_list(art).alias("articles")))
                      .alias("payload")))
    return N.unnest_articles(payloads)


_ENT = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "),
        ("&amp;", "&")]


def html_text_sql(x: str) -> str:
    t = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for e, ch in _ENT:
        t = f"replace({t}, '{e}', '{ch}')"
    return strip_sql(t)


_BODY = (r"regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->',"
         r" '', 'g')")
_ORIGIN = r"regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1)"


def abs_url_sql(link: str, origin: str = _ORIGIN) -> str:
    return (f"CASE WHEN {link} IS NULL OR {link} = '' THEN '' "
            f"WHEN regexp_matches({link}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {link} "
            f"ELSE {origin} || {link} END")


_PAGES_SQL = f"""
    SELECT page_id, url, html, body,
           nullif(regexp_extract(body, '(?is)<h3(?:\\s[^>]*)?>(.*?)</h3>', 1), '') AS h3,
           nullif(regexp_extract(body, '(?is)<h1(?:\\s[^>]*)?>(.*?)</h1>', 1), '') AS h1,
           regexp_extract(body, '(?is)<a\\s[^>]*?href="([^"]*)"', 1) AS link,
           regexp_extract(body, '(?is)<p(?:\\s[^>]*)?>(.*?)(?:</p>|<p[\\s>]|$)', 0) AS para,
           html IS NOT NULL AND regexp_matches(body, '(?is)<p(?:\\s[^>]*)?>') AS has_p
    FROM (SELECT *, {_BODY} AS body FROM pages)"""


_ARTICLES_SQL = f"""
    SELECT page_id, coalesce({html_text_sql('coalesce(h3, h1)')}, 'No title available') AS title,
           CASE WHEN has_p THEN {html_text_sql(
               "regexp_replace(regexp_replace(para, '(?is)^<p(?:\\s[^>]*)?>', ''), "
               "'(?is)(?:</p>|<p[\\s>])$', '')")}
                ELSE 'No description available' END AS description,
           {abs_url_sql('link')} AS url, 'web' AS source
    FROM ({_PAGES_SQL})"""


@query("html_article_extract", _ARTICLES_SQL)
def q_html_article_extract(spark, sf):
    return N.html_article_extract(read_table(spark, sf, "pages", "page_id", "url", "html"))


@query("html_article_markup", _ARTICLES_SQL)
def q_html_article_markup(spark, sf):
    """All pages written in another way that a parser reads alike: ``>`` and ``href`` inside
    quoted attributes, values in single quotes and without quotes, inline tags in headings,
    upper-case names, white space in end tags. The articles are those of the pages as given."""
    p = read_table(spark, sf, "pages", "page_id", "url", "html")
    h, k = F.col("html"), F.col("page_id") % 3

    def put(c, *pairs):
        for a, b in pairs:
            c = F.replace(c, F.lit(a), F.lit(b))
        return c

    quoted = put(h, ("<h1>", '<h1 title="a>b" data-x=\'</h1>c>d\'>'), ("<p>", '<p class="x>y">'),
                 ('<a href="', '<a title="no href=/x" data-href="/no" href="'))
    bare = F.regexp_replace(put(h, ("<h1>", "<H1\n>"), ("</h1>", "</H1 >")),
                            '<a href="([^"]*)">', "<A class=nav href=$1 >")
    nested = F.regexp_replace(put(h, ("<h1>", '<h1><b id="q>"><i>'), ("</h1>", "</i></b></h1>")),
                              '<a href="([^"]*)">', "<a rel='x>y' HREF = '$1'>")
    return N.html_article_extract(p.withColumn("html", F.when(k == 0, quoted).when(k == 1, bare).otherwise(nested)))


@query("abs_url", f"""
    SELECT page_id, link, {abs_url_sql('link')} AS abs_url FROM ({_PAGES_SQL})""")
def q_abs_url(spark, sf):
    p = read_table(spark, sf, "pages", "page_id", "url", "html")
    body = F.regexp_replace("html", N._DROP_BLOCKS, "")
    link = F.regexp_extract(body, r"(?is)<a\s[^>]*?href=\"([^\"]*)\"", 1)
    return p.select("page_id", link.alias("link"),
                    N.abs_url(link, F.col("url")).alias("abs_url"))


@query("union_sources", f"""
    SELECT doc_id, NULL::BIGINT AS page_id, title, description, url, source, author
    FROM v_news_raw
    UNION ALL
    SELECT NULL::BIGINT AS doc_id, page_id,
           coalesce({html_text_sql('coalesce(h3, h1)')}, 'No title available') AS title,
           CASE WHEN has_p THEN {html_text_sql(
               "regexp_replace(regexp_replace(para, '(?is)^<p(?:\\s[^>]*)?>', ''), "
               "'(?is)(?:</p>|<p[\\s>])$', '')")}
                ELSE 'No description available' END AS description,
           {abs_url_sql('link')} AS url, 'web' AS source, NULL AS author
    FROM ({_PAGES_SQL})""", ("v_news_raw",))
def q_union_sources(spark, sf):
    """API articles and articles scraped from pages appended by column name."""
    api = fx.news_raw(spark, sf).select("doc_id", "title", "description", "url", "source",
                                        "author")
    web = N.html_article_extract(read_table(spark, sf, "pages", "page_id", "url", "html"))
    u = union_frames([api, web])
    return u.select("doc_id", "page_id", "title", "description", "url", "source", "author")


# ------------------------------------------------------------ short messages

@query("social_defaults", """
    SELECT doc_id, coalesce(text, '') AS text, 'Unknown' AS author_name,
           'Unknown' AS author_username, coalesce(lang, 'unknown') AS lang,
           CAST(NULL AS DOUBLE) AS sentiment
    FROM v_tweets_raw""", ("v_tweets_raw",))
def q_social_defaults(spark, sf):
    t = fx.tweets_raw(spark, sf).select("doc_id", "text", "lang")
    return SO.social_defaults(t).select("doc_id", "text", "author_name", "author_username",
                                        "lang", "sentiment")


@query("parse_dates_social", f"""
    SELECT doc_id, {TS('ts', 'created_at')}
    FROM (SELECT doc_id, {social_date_sql('created_at')} AS ts FROM v_tweets_raw)
    WHERE ts IS NOT NULL""", ("v_tweets_raw",))
def q_parse_dates_social(spark, sf):
    t = SO.parse_created(fx.tweets_raw(spark, sf).select("doc_id", "created_at"))
    return report(t, ts_cols=("created_at",))


@query("parse_stats", f"""
    SELECT count(*) FILTER (WHERE ts IS NOT NULL) AS parsed,
           count(*) FILTER (WHERE ts IS NULL) AS failed
    FROM (SELECT {social_date_sql('created_at')} AS ts FROM v_tweets_raw)""",
       ("v_tweets_raw",))
def q_parse_stats(spark, sf):
    return SO.parse_stats(fx.tweets_raw(spark, sf))


@query("parse_failures", f"""
    SELECT doc_id, created_at FROM v_tweets_raw
    WHERE {social_date_sql('created_at')} IS NULL ORDER BY doc_id LIMIT 5""",
       ("v_tweets_raw",))
def q_parse_failures(spark, sf):
    t = fx.tweets_raw(spark, sf).select("doc_id", "created_at")
    return SO.parse_failures(t, ["doc_id"])


@query("drop_blank_text", f"""
    SELECT doc_id, text FROM v_tweets_raw WHERE NOT {blank_sql('text')}""", ("v_tweets_raw",))
def q_drop_blank_text(spark, sf):
    return SO.drop_blank_text(fx.tweets_raw(spark, sf).select("doc_id", "text"))


@query("dedup_text", """
    SELECT doc_id, text FROM v_tweets_raw
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""", ("v_tweets_raw",))
def q_dedup_text(spark, sf):
    return SO.dedup_text(fx.tweets_raw(spark, sf).select("doc_id", "text"), ["doc_id"])


@query("language_flag", """
    SELECT doc_id, lang, coalesce(lang = 'en', false) AS is_english FROM documents""")
def q_language_flag(spark, sf):
    return SO.language_flag(read_table(spark, sf, "documents", "doc_id", "lang"))


@query("language_counts", """
    SELECT coalesce(lang = 'en', false) AS is_english, count(*) AS n FROM documents
    GROUP BY 1""")
def q_language_counts(spark, sf):
    return SO.language_counts(read_table(spark, sf, "documents", "doc_id", "lang"))


@query("clean_text", f"""
    SELECT doc_id, {clean_text_sql('text')} AS cleaned_text FROM v_tweets_raw""",
       ("v_tweets_raw",))
def q_clean_text(spark, sf):
    t = fx.tweets_raw(spark, sf)
    return t.select("doc_id", clean_text("text").alias("cleaned_text"))


@query("clean_text_documents", f"""
    SELECT doc_id, {clean_text_sql('text')} AS cleaned_text FROM documents""")
def q_clean_text_documents(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return d.select("doc_id", clean_text("text").alias("cleaned_text"))


@query("clean_tweets", f"""
    SELECT doc_id, text, {TS('ts', 'created_at')}, lang, event_type,
           coalesce(lang = 'en', false) AS is_english,
           {clean_text_sql('text')} AS cleaned_text, '{AS_OF[:10]}' AS processed_date
    FROM (SELECT *, {social_date_sql('created_at')} AS ts FROM v_tweets_raw)
    WHERE ts IS NOT NULL AND NOT {blank_sql('text')}
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""", ("v_tweets_raw",))
def q_clean_tweets(spark, sf):
    c = SO.clean_tweets(fx.tweets_raw(spark, sf), AS_OF)
    return report(c, ts_cols=("created_at",))


@query("per_term_cap", """
    SELECT doc_id, event_type FROM v_tweets_raw
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY doc_id DESC) <= 10""",
       ("v_tweets_raw",))
def q_per_term_cap(spark, sf):
    return SO.per_term_cap(fx.tweets_raw(spark, sf).select("doc_id", "event_type"), 10)


@query("tweet_totals", """
    SELECT event_type, count(*) AS n FROM v_tweets_raw GROUP BY ROLLUP (event_type)""",
       ("v_tweets_raw",))
def q_tweet_totals(spark, sf):
    return SO.term_totals(fx.tweets_raw(spark, sf))


@query("dup_counts", """
    SELECT count(*) AS rows_before, count(DISTINCT text) AS rows_after,
           count(*) - count(DISTINCT text) AS duplicates FROM documents""")
def q_dup_counts(spark, sf):
    from marketweave.operators.tables import dup_counts
    return dup_counts(read_table(spark, sf, "documents", "text"), ["text"])


# ------------------------------------------------------------ forum posts

@query("quality_filter_posts", """
    SELECT conv_id, score, over_18 FROM v_posts_raw WHERE score > 10 AND NOT over_18""",
       ("v_posts_raw",))
def q_quality_filter_posts(spark, sf):
    return P.quality_filter_posts(fx.posts_raw(spark, sf)).select("conv_id", "score", "over_18")


@query("top_comments", """
    SELECT conv_id, CAST(rk AS BIGINT) AS rank, pos, comment_score FROM (
      SELECT conv_id, c.pos AS pos, c.comment_score AS comment_score,
             row_number() OVER (PARTITION BY conv_id ORDER BY c.comment_score DESC, c.pos) AS rk
      FROM (SELECT conv_id, unnest(comments) AS c FROM v_posts_raw))
    WHERE rk <= 5""", ("v_posts_raw",))
def q_top_comments(spark, sf):
    p = fx.posts_raw(spark, sf).select("conv_id", P.top_comments("comments", 5).alias("top"))
    e = p.select("conv_id", F.posexplode("top").alias("i", "c"))
    return e.select("conv_id", (F.col("i") + 1).cast("bigint").alias("rank"),
                    F.col("c.pos").alias("pos"), F.col("c.comment_score").alias("comment_score"))


@query("require_fields", """
    SELECT conv_id, title, subreddit FROM v_posts_raw
    WHERE title IS NOT NULL AND subreddit IS NOT NULL""", ("v_posts_raw",))
def q_require_fields(spark, sf):
    return P.require_fields(fx.posts_raw(spark, sf)).select("conv_id", "title", "subreddit")


@query("valid_comment_count", """
    SELECT conv_id, CAST(len(list_filter(comments, lambda c: c.comment_text IS NOT NULL
                                                   AND c.comment_text <> '')) AS BIGINT)
             AS valid_comments_count
    FROM v_posts_raw""", ("v_posts_raw",))
def q_valid_comment_count(spark, sf):
    p = fx.posts_raw(spark, sf)
    return p.select("conv_id", P.valid_comment_count("comments").cast("bigint")
                    .alias("valid_comments_count"))


_COMBINED_SQL = """concat_ws(' ', title, list_aggregate(list_transform(comments,
                                lambda c: c.comment_text), 'string_agg', ' '))"""


@query("combined_text", f"""
    SELECT conv_id, {_COMBINED_SQL} AS combined_text FROM v_posts_raw""", ("v_posts_raw",))
def q_combined_text(spark, sf):
    p = fx.posts_raw(spark, sf)
    return p.select("conv_id", P.combined_text("title", "comments").alias("combined_text"))


@query("epoch_to_ts", f"""
    SELECT conv_id, {TS('make_timestamp(CAST(created_at * 1000000 AS BIGINT))', 'created_at')}
    FROM v_posts_raw""", ("v_posts_raw",))
def q_epoch_to_ts(spark, sf):
    from marketweave.functions.dates import epoch_to_ts
    p = fx.posts_raw(spark, sf)
    return p.select("conv_id", tstxt(epoch_to_ts("created_at")).alias("created_at"))


@query("clean_posts", f"""
    SELECT conv_id, title, subreddit,
           {TS('make_timestamp(CAST(created_at * 1000000 AS BIGINT))', 'created_at')},
           CAST(len(list_filter(comments, lambda c: c.comment_text IS NOT NULL
                                          AND c.comment_text <> '')) AS BIGINT)
             AS valid_comments_count,
           {_COMBINED_SQL} AS combined_text, '{AS_OF[:10]}' AS processed_date
    FROM v_posts_raw WHERE title IS NOT NULL AND subreddit IS NOT NULL""", ("v_posts_raw",))
def q_clean_posts(spark, sf):
    c = P.clean_posts(fx.posts_raw(spark, sf), AS_OF)
    c = c.select("conv_id", "title", "subreddit", "created_at",
                 F.col("valid_comments_count").cast("bigint").alias("valid_comments_count"),
                 "combined_text", "processed_date")
    return report(c, ts_cols=("created_at",))


# ------------------------------------------------------------ macro series

@query("unnest_indicator_payload", """
    SELECT indicator, country, date, value FROM v_econ_raw""", ("v_econ_raw",))
def q_unnest_indicator_payload(spark, sf):
    """Series packed as API envelopes ``[meta, [entries]]`` (one per indicator x country)
    and unnested back."""
    e = fx.econ_raw(spark, sf)
    entries = F.to_json(F.collect_list(F.struct("date", "value")))
    payload = F.concat(F.lit('[{"page": 1, "indicator": '), F.to_json(F.array("indicator")),
                       F.lit("}, "), entries, F.lit("]"))
    packed = e.groupBy("indicator", "country").agg(payload.alias("payload"))
    return M.unnest_indicator_payload(packed)


@query("numeric_coerce", """
    SELECT indicator, country, date, TRY_CAST(value AS DOUBLE) AS value FROM v_econ_raw""",
       ("v_econ_raw",))
def q_numeric_coerce(spark, sf):
    return M.numeric_coerce(fx.econ_raw(spark, sf))


@query("parse_dates_generic", f"""
    SELECT indicator, country, {TS("try_strptime(date, '%Y')", 'date')} FROM v_econ_raw""",
       ("v_econ_raw",))
def q_parse_dates_generic(spark, sf):
    e = M.parse_dates_generic(fx.econ_raw(spark, sf).select("indicator", "country", "date"))
    return report(e, ts_cols=("date",))


_NAMES_SQL = ("CASE country WHEN 'US' THEN 'United States' WHEN 'GB' THEN 'United Kingdom' "
              "WHEN 'CN' THEN 'China' WHEN 'IN' THEN 'India' END")


@query("country_code_name", f"""
    SELECT indicator, country, date, country AS country_code, {_NAMES_SQL} AS country_name
    FROM v_econ_raw""", ("v_econ_raw",))
def q_country_code_name(spark, sf):
    return M.country_code_name(fx.econ_raw(spark, sf).select("indicator", "country", "date"))


@query("key_lookup", """
    SELECT e.indicator, e.country, e.date, d.r_name
    FROM v_econ_raw e LEFT JOIN (SELECT n_name, r_name FROM nation
                                 JOIN region ON n_regionkey = r_regionkey) d
      ON e.country = d.n_name""", ("v_econ_raw",))
def q_key_lookup(spark, sf):
    dim = read_table(spark, sf, "nation", "n_name", "n_regionkey").join(
        read_table(spark, sf, "region", "r_regionkey", "r_name"),
        F.col("n_regionkey") == F.col("r_regionkey"))
    e = fx.econ_raw(spark, sf).select("indicator", "country", "date")
    return M.key_lookup(e, dim, "country", "n_name", ["r_name"])


_CLEAN_MACRO_SQL = f"""
    SELECT indicator, country, {TS('d', 'date')}, TRY_CAST(value AS DOUBLE) AS value,
           CAST(year(d) AS INTEGER) AS year, country AS country_code,
           {_NAMES_SQL} AS country_name
    FROM (SELECT *, try_strptime(date, '%Y') AS d FROM v_econ_raw)"""


@query("clean_macro", _CLEAN_MACRO_SQL, ("v_econ_raw",))
def q_clean_macro(spark, sf):
    return report(M.clean_macro(fx.econ_raw(spark, sf)), ts_cols=("date",))


@query("sort_macro", f"""
    SELECT *, row_number() OVER (ORDER BY date DESC NULLS LAST, country NULLS LAST, indicator NULLS LAST)
                AS row_number
    FROM ({_CLEAN_MACRO_SQL})""", ("v_econ_raw",))
def q_sort_macro(spark, sf):
    """The macro table in its order, numbered: one number per row of a small aggregate."""
    return M.number_macro(report(M.clean_macro(fx.econ_raw(spark, sf)), ts_cols=("date",)))


@query("year_range", f"""
    SELECT * FROM ({_CLEAN_MACRO_SQL}) WHERE year BETWEEN 1996 AND 1999""", ("v_econ_raw",))
def q_year_range(spark, sf):
    from marketweave.operators.analytics import year_range
    return report(year_range(M.clean_macro(fx.econ_raw(spark, sf)), 1996, 1999),
                  ts_cols=("date",))

