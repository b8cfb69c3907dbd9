"""DuckDB text of the derived views of ``marketweave.sources.fixtures``.

Used only to build the independent SQL oracle for each registered query. Each view is a
CTE; ``with_views(sql, names)`` prepends the CTEs a query needs (dependencies first).
"""

from __future__ import annotations

from marketweave.sources.fixtures import (BASE_TS, LEXICON_ROWS, POLARITY_ROWS,
                                          SEARCH_TERMS, TERM_ROWS)


def _values(rows, cols):
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"CAST({v!r} AS DOUBLE)"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(cols)})"


_TERMS_SQL = "[" + ", ".join(f"'{t}'" for t in SEARCH_TERMS) + "]"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_bars": ((), """
        SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS date,
               arg_min(px, row(l_orderkey, l_linenumber, px)) AS open,
               max(px) AS high, min(px) AS low,
               arg_max(px, row(l_orderkey, l_linenumber, px)) AS close,
               CAST(sum(l_quantity) AS BIGINT) AS volume
        FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, p_brand,
                     p_retailprice * (CAST(0.9 AS DOUBLE) + l_discount + l_tax) AS px
              FROM lineitem JOIN part ON l_partkey = p_partkey)
        GROUP BY 1, 2"""),
    "v_bars_dirty": (("v_bars",), """
        SELECT symbol, date, open, high, low,
               CASE WHEN rn % 23 = 0 THEN close * 50 ELSE close END AS close,
               CASE WHEN rn % 17 = 0 THEN NULL ELSE volume END AS volume
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn
              FROM v_bars)"""),
    "v_sent": ((), """
        SELECT 'Brand#' || CAST(o_custkey % 25 + 1 AS VARCHAR) AS symbol,
               CAST(o_orderdate AS DATE) AS date,
               avg(CAST(o_orderkey % 201 - 100 AS DOUBLE) / 100) AS sentiment_score,
               count(*) AS volume
        FROM orders GROUP BY 1, 2"""),
    "v_sent_price": (("v_bars", "v_sent"), """
        SELECT b.symbol, b.date, b.close AS price, b.volume AS price_volume,
               s.sentiment_score, s.volume AS sentiment_volume
        FROM v_bars b JOIN v_sent s ON b.symbol = s.symbol AND b.date = s.date"""),
    "v_news_raw": ((), f"""
        SELECT doc_id,
               CASE WHEN doc_id % 13 = 0 THEN NULL ELSE split_part(text, chr(10), 1) END AS title,
               CASE WHEN doc_id % 11 = 0 THEN ' ' || chr(9) || ' '
                    WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1)
                    ELSE '' END AS description,
               CASE doc_id % 6
                 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                 WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z')
                 WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                 WHEN 3 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S GMT')
                 WHEN 4 THEN 'not a date' END AS "publishedAt",
               CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'author' || CAST(doc_id % 37 AS VARCHAR) END
                 AS author,
               source,
               'https://news.example/a/' || CAST(doc_id AS VARCHAR) AS url,
               CAST(NULL AS VARCHAR) AS country
        FROM (SELECT *, TIMESTAMP '{BASE_TS}' + to_minutes(doc_id) AS ts FROM documents)"""),
    "v_tweets_raw": ((), f"""
        SELECT doc_id,
               CASE WHEN doc_id % 37 = 0 THEN NULL
                    WHEN doc_id % 31 = 0 THEN '  ' || chr(10) || ' '
                    ELSE (CASE doc_id % 4 WHEN 0 THEN 'https://t.co/x1 ' WHEN 1 THEN '@né_1 '
                                          WHEN 2 THEN '#été2024 ' ELSE 'www.a.b/c ' END)
                         || text END AS text,
               CASE WHEN doc_id % 19 = 0 THEN 'yesterday'
                    ELSE strftime(TIMESTAMP '{BASE_TS}' + to_minutes(doc_id * 7),
                                  '%a %b %d %H:%M:%S +0000 %Y') END AS created_at,
               lang,
               {_TERMS_SQL}[CAST(doc_id % 4 + 1 AS INTEGER)] AS event_type
        FROM documents"""),
    "v_posts_raw": ((), """
        SELECT conv_id, title,
               CASE WHEN conv_id % 17 = 0 THEN NULL ELSE 'sub' || CAST(conv_id % 5 AS VARCHAR) END
                 AS subreddit,
               CAST(coalesce(length(title), 0) % 40 AS BIGINT) AS score,
               conv_id % 10 = 0 AS over_18,
               CAST(1704067200 + 3600 * conv_id AS DOUBLE) AS created_at,
               comments
        FROM (SELECT conv_id,
                     max(CASE WHEN turn = 0 THEN text END) AS title,
                     coalesce(list(struct_pack(pos := turn, comment_text := text,
                                               comment_score := CAST(length(text) % 50 AS BIGINT))
                                   ORDER BY turn) FILTER (WHERE turn > 0), []) AS comments
              FROM conversations GROUP BY conv_id)"""),
    "v_econ_raw": ((), """
        SELECT indicator, country, date,
               CASE WHEN n % 7 = 0 THEN 'n/a' ELSE CAST(v AS VARCHAR) END AS value
        FROM (SELECT o_orderstatus AS indicator,
                     CASE n_regionkey WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'CN'
                                      WHEN 3 THEN 'IN' ELSE n_name END AS country,
                     CAST(year(o_orderdate) AS VARCHAR) AS date,
                     sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS v, count(*) AS n
              FROM orders JOIN customer ON o_custkey = c_custkey
                          JOIN nation ON c_nationkey = n_nationkey
              GROUP BY 1, 2, 3)"""),
    "v_event_prices": (("v_bars",), """
        SELECT symbol, date, close AS price FROM v_bars"""),
    "v_preds": (("v_bars",), """
        SELECT symbol, date, actual_price, predicted_price, actual_return, predicted_return
        FROM (SELECT *, lag(actual_return) OVER (PARTITION BY symbol ORDER BY date)
                          AS predicted_return
              FROM (SELECT symbol, date, close AS actual_price,
                           lag(close) OVER (PARTITION BY symbol ORDER BY date) AS predicted_price,
                           close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0)
                             - 1 AS actual_return,
                           row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn
                    FROM v_bars))
        WHERE rn > 2"""),
    "v_lexicon": ((), _values(LEXICON_ROWS, ["token", "valence"])),
    "v_polarity": ((), _values(POLARITY_ROWS, ["token", "polarity", "subjectivity"])),
    "v_terms": ((), _values(TERM_ROWS, ["term", "token"])),
}


def with_views(sql: str, *names: str) -> str:
    """``WITH <views and their dependencies> <sql>``."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order)
    body = sql.lstrip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{sql}"
