"""Registered queries for lexicon sentiment, labels and keyword tagging."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketweave.operators import sentiment as X
from marketweave.operators import social as SO
from marketweave.plans.catalog import D, R, query, report
from marketweave.plans.text_queries import AS_OF, blank_sql, social_date_sql
from marketweave.sources import fixtures as fx
from marketweave.sources.tables import read_table

SPLIT = r"[^\p{L}\p{N}_]+"
SCORES = ("neg", "neu", "pos", "compound")


def _z(x: str) -> str:
    return f"CASE WHEN {x} = 0 THEN 0.0 ELSE {x} END"


def tokens_sql(text: str) -> str:
    return (f"list_filter(regexp_split_to_array(lower({text}), '{SPLIT}'), "
            f"lambda t: t <> '')")


def valence_sql(src: str, ids: str, text: str, prefix: str) -> str:
    """Per-id valence scores of ``text`` in ``src`` (ids without tokens absent)."""
    tok = f"SELECT {ids}, unnest({tokens_sql(text)}) AS token FROM ({src})"
    agg = f"""
      SELECT {ids}, round(sum(coalesce(v, 0.0)), 6) AS s,
             round(sum(CASE WHEN v > 0 THEN v + 1 ELSE 0.0 END), 6) AS p,
             round(sum(CASE WHEN v < 0 THEN v - 1 ELSE 0.0 END), 6) AS n,
             count(*) FILTER (WHERE v IS NULL OR v = 0) AS zc
      FROM (SELECT tok.*, l.valence AS v FROM ({tok}) tok LEFT JOIN v_lexicon l
            ON tok.token = l.token)
      GROUP BY {ids}"""
    tot = "(p + abs(n) + zc)"
    s = _z("s")
    return f"""
      SELECT {ids}, {_z(f'abs(n) / nullif({tot}, 0)')} AS {prefix}_neg,
             {_z(f'zc / nullif({tot}, 0)')} AS {prefix}_neu,
             {_z(f'p / nullif({tot}, 0)')} AS {prefix}_pos,
             {_z(f'({s}) / sqrt(({s}) * ({s}) + 15.0)')} AS {prefix}_compound
      FROM ({agg})"""


def polarity_sql(src: str, ids: str, text: str, prefix: str) -> str:
    tok = f"SELECT {ids}, unnest({tokens_sql(text)}) AS token FROM ({src})"
    return f"""
      SELECT {ids}, {_z('ps / k')} AS {prefix}_polarity, {_z('ss / k')} AS {prefix}_subjectivity
      FROM (SELECT {ids}, round(sum(l.polarity), 6) AS ps, round(sum(l.subjectivity), 6) AS ss,
                   count(*) AS k
            FROM ({tok}) tok JOIN v_polarity l ON tok.token = l.token GROUP BY {ids})"""


def _filled(col: str) -> str:
    return R(f"coalesce({col}, 0.0)", col.split(".")[-1])


@query("lexicon_valence", f"""
    SELECT d.doc_id, {", ".join(_filled(f"sc.text_{s}") for s in SCORES)}
    FROM documents d LEFT JOIN ({valence_sql('SELECT doc_id, text FROM documents', 'doc_id',
                                             'text', 'text')}) sc
      ON d.doc_id = sc.doc_id""", ("v_lexicon",))
def q_lexicon_valence(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    v = X.lexicon_valence(d, ["doc_id"], fx.lexicon(spark))
    return report(v.select("doc_id", *[f"text_{s}" for s in SCORES]),
                  round_cols=tuple(f"text_{s}" for s in SCORES))


_LARGE = f"""
    WITH tok AS (SELECT DISTINCT unnest({tokens_sql('text')}) AS token FROM documents),
         v_lexicon AS (
      SELECT token, (('0x' || substr(md5(token), 3, 4))::INT % 81 - 40)::DOUBLE / 10 AS valence
      FROM tok WHERE ('0x' || substr(md5(token), 1, 2))::INT < 128)"""


@query("lexicon_valence_large", f"""
    {_LARGE}
    SELECT d.doc_id, {", ".join(_filled(f"sc.text_{s}") for s in SCORES)}
    FROM documents d LEFT JOIN ({valence_sql('SELECT doc_id, text FROM documents', 'doc_id',
                                             'text', 'text')}) sc
      ON d.doc_id = sc.doc_id""")
def q_lexicon_valence_large(spark, sf):
    """The same with a lexicon of tens of thousands of entries."""
    d = read_table(spark, sf, "documents", "doc_id", "text")
    v = X.lexicon_valence(d, ["doc_id"], fx.large_lexicon(spark, sf))
    return report(v.select("doc_id", *[f"text_{s}" for s in SCORES]),
                  round_cols=tuple(f"text_{s}" for s in SCORES))


@query("lexicon_polarity", f"""
    SELECT d.doc_id, {_filled('sc.text_polarity')}, {_filled('sc.text_subjectivity')}
    FROM documents d LEFT JOIN ({polarity_sql('SELECT doc_id, text FROM documents', 'doc_id',
                                              'text', 'text')}) sc
      ON d.doc_id = sc.doc_id""", ("v_polarity",))
def q_lexicon_polarity(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    v = X.lexicon_polarity(d, ["doc_id"], fx.polarity_lexicon(spark))
    return report(v.select("doc_id", "text_polarity", "text_subjectivity"),
                  round_cols=("text_polarity", "text_subjectivity"))


def _vader_bucket_sql(x: str) -> str:
    return (f"CASE WHEN {x} > -1 AND {x} <= -0.5 THEN 'negative' "
            f"WHEN {x} > -0.5 AND {x} <= 0.1 THEN 'slightly negative' "
            f"WHEN {x} > 0.1 AND {x} <= 0.5 THEN 'neutral' "
            f"WHEN {x} > 0.5 AND {x} <= 1 THEN 'positive' END")


def _polarity_bucket_sql(x: str) -> str:
    return (f"CASE WHEN {x} > -1 AND {x} <= -0.2 THEN 'negative' "
            f"WHEN {x} > -0.2 AND {x} <= 0.2 THEN 'neutral' "
            f"WHEN {x} > 0.2 AND {x} <= 1 THEN 'positive' END")


@query("sentiment_bucket_vader", f"""
    SELECT doc_id, {R('c', 'text_compound')}, {_vader_bucket_sql('c')} AS sentiment
    FROM (SELECT d.doc_id, coalesce(sc.text_compound, 0.0) AS c
          FROM documents d LEFT JOIN ({valence_sql('SELECT doc_id, text FROM documents',
                                                   'doc_id', 'text', 'text')}) sc
            ON d.doc_id = sc.doc_id)""", ("v_lexicon",))
def q_sentiment_bucket_vader(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    v = X.post_sentiment(X.lexicon_valence(d, ["doc_id"], fx.lexicon(spark)))
    return report(v.select("doc_id", "text_compound", "sentiment"),
                  round_cols=("text_compound",))


@query("sentiment_bucket_polarity", f"""
    SELECT doc_id, {R('c', 'text_polarity')}, {_polarity_bucket_sql('c')} AS sentiment
    FROM (SELECT d.doc_id, coalesce(sc.text_polarity, 0.0) AS c
          FROM documents d LEFT JOIN ({polarity_sql('SELECT doc_id, text FROM documents',
                                                    'doc_id', 'text', 'text')}) sc
            ON d.doc_id = sc.doc_id)""", ("v_polarity",))
def q_sentiment_bucket_polarity(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    v = X.post_sentiment(X.lexicon_polarity(d, ["doc_id"], fx.polarity_lexicon(spark)),
                         model="polarity")
    return report(v.select("doc_id", "text_polarity", "sentiment"),
                  round_cols=("text_polarity",))


@query("pick_text_column", f"""
    SELECT n.doc_id, {_filled('sc.title_compound')}
    FROM v_news_raw n LEFT JOIN ({valence_sql('SELECT doc_id, title FROM v_news_raw', 'doc_id',
                                              'title', 'title')}) sc
      ON n.doc_id = sc.doc_id""", ("v_news_raw", "v_lexicon"))
def q_pick_text_column(spark, sf):
    """News rows have no ``text`` column: the scorer picks ``title``."""
    n = fx.news_raw(spark, sf).select("doc_id", "title", "description")
    v = X.lexicon_valence(n, ["doc_id"], fx.lexicon(spark))
    return report(v.select("doc_id", "title_compound"), round_cols=("title_compound",))


@query("post_sentiment", f"""
    SELECT conv_id, {R('c', 'title_compound')}, {_vader_bucket_sql('c')} AS sentiment
    FROM (SELECT p.conv_id, coalesce(sc.title_compound, 0.0) AS c
          FROM v_posts_raw p LEFT JOIN ({valence_sql('SELECT conv_id, title FROM v_posts_raw',
                                                     'conv_id', 'title', 'title')}) sc
            ON p.conv_id = sc.conv_id)""", ("v_posts_raw", "v_lexicon"))
def q_post_sentiment(spark, sf):
    p = fx.posts_raw(spark, sf)
    v = X.post_sentiment(X.lexicon_valence(p, ["conv_id"], fx.lexicon(spark)))
    return report(v.select("conv_id", "title_compound", "sentiment"),
                  round_cols=("title_compound",))


_COMMENTS_SRC = """SELECT conv_id, generate_subscripts(comments, 1) - 1 AS i,
                          unnest(comments).comment_text AS comment_text FROM v_posts_raw"""


@query("comment_sentiment", f"""
    SELECT c.conv_id, c.i AS pos, {", ".join(_filled(f"sc.comment_{s}") for s in SCORES)}
    FROM ({_COMMENTS_SRC}) c LEFT JOIN ({valence_sql(_COMMENTS_SRC, 'conv_id, i',
                                                     'comment_text', 'comment')}) sc
      ON c.conv_id = sc.conv_id AND c.i = sc.i""", ("v_posts_raw", "v_lexicon"))
def q_comment_sentiment(spark, sf):
    c = X.comment_sentiment(fx.posts_raw(spark, sf), "conv_id", fx.lexicon(spark), flat=True)
    cols = tuple(f"comment_{s}" for s in SCORES)
    return report(c.withColumn("pos", F.col("pos").cast("bigint")), round_cols=cols)


@query("comment_polarity", f"""
    SELECT c.conv_id, c.i AS pos, {_filled('sc.comment_polarity')}, {_filled('sc.comment_subjectivity')}
    FROM ({_COMMENTS_SRC}) c LEFT JOIN ({polarity_sql(_COMMENTS_SRC, 'conv_id, i',
                                                      'comment_text', 'comment')}) sc
      ON c.conv_id = sc.conv_id AND c.i = sc.i""", ("v_posts_raw", "v_polarity"))
def q_comment_polarity(spark, sf):
    c = X.comment_sentiment(fx.posts_raw(spark, sf), "conv_id", fx.polarity_lexicon(spark), flat=True,
                            model="polarity")
    return report(c.withColumn("pos", F.col("pos").cast("bigint")),
                  round_cols=("comment_polarity", "comment_subjectivity"))


_TWEETS_CLEAN = f"""
    SELECT doc_id, text, ts AS created_at, event_type FROM (
      SELECT *, {social_date_sql('created_at')} AS ts FROM v_tweets_raw)
    WHERE ts IS NOT NULL AND NOT {blank_sql('text')}
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"""


@query("daily_sentiment", f"""
    SELECT event_type, {D('CAST(created_at AS DATE)', 'date')},
           {R('avg(coalesce(sc.text_compound, 0.0))', 'sentiment_score')}, count(*) AS volume
    FROM ({_TWEETS_CLEAN}) t LEFT JOIN ({valence_sql(_TWEETS_CLEAN, 'doc_id', 'text', 'text')}) sc
      ON t.doc_id = sc.doc_id
    GROUP BY event_type, CAST(created_at AS DATE)""", ("v_tweets_raw", "v_lexicon"))
def q_daily_sentiment(spark, sf):
    t = SO.clean_tweets(fx.tweets_raw(spark, sf), AS_OF)
    v = X.lexicon_valence(t, ["doc_id"], fx.lexicon(spark))
    d = X.daily_sentiment(v, "created_at", "text_compound", ["event_type"])
    return report(d, round_cols=("sentiment_score",), date_cols=("date",))


@query("keyword_tag", f"""
    WITH dt AS (SELECT DISTINCT doc_id, unnest({tokens_sql('text')}) AS token FROM documents),
         sz AS (SELECT term, count(DISTINCT token) AS k FROM v_terms GROUP BY term)
    SELECT doc_id, t.term AS event_type
    FROM dt JOIN (SELECT DISTINCT term, token FROM v_terms) t ON dt.token = t.token
    GROUP BY doc_id, t.term
    HAVING count(*) = (SELECT k FROM sz WHERE sz.term = t.term)""", ("v_terms",))
def q_keyword_tag(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return X.keyword_tag(d, "doc_id", "text", fx.terms(spark))


@query("keyword_tag_messages", f"""
    WITH dt AS (SELECT DISTINCT doc_id, unnest({tokens_sql('text')}) AS token
                FROM v_tweets_raw),
         sz AS (SELECT term, count(DISTINCT token) AS k FROM v_terms GROUP BY term)
    SELECT doc_id, t.term AS event_type
    FROM dt JOIN (SELECT DISTINCT term, token FROM v_terms) t ON dt.token = t.token
    GROUP BY doc_id, t.term
    HAVING count(*) = (SELECT k FROM sz WHERE sz.term = t.term)""", ("v_tweets_raw", "v_terms"))
def q_keyword_tag_messages(spark, sf):
    """Short messages tagged with the search terms they match (the collectors' search
    re-aimed as a join over the stored messages)."""
    t = fx.tweets_raw(spark, sf).select("doc_id", "text")
    return X.keyword_tag(t, "doc_id", "text", fx.terms(spark))


def _dmap(d: dict[str, float]) -> str:
    keys = ", ".join(f"'{k}'" for k in sorted(d))
    vals = ", ".join(f"CAST({d[k]!r} AS DOUBLE)" for k in sorted(d))
    return f"MAP([{keys}], [{vals}])"


def valence_rules_sql(src: str, ids: str, text: str, prefix: str) -> str:
    """DuckDB text of valence scoring with negation / booster context (in-row form)."""
    from marketweave.operators.sentiment import BOOSTER_DECAY, N_SCALAR
    lex = _dmap(dict(fx.LEXICON_ROWS))
    boo = _dmap(fx.BOOSTER_WORDS)
    negs = "[" + ", ".join(f"'{w}'" for w in fx.NEGATION_WORDS) + "]"
    v = f"map_extract_value({lex}, t)"
    prev = [f"(CASE WHEN i - {k} >= 1 THEN toks[i - {k}] END)" for k in (1, 2, 3)]
    for k, p in enumerate(prev):
        b = (f"(CASE WHEN map_extract_value({lex}, {p}) IS NULL "
             f"THEN coalesce(map_extract_value({boo}, {p}), 0.0) * {BOOSTER_DECAY[k]} "
             f"ELSE 0.0 END)")
        v = f"(CASE WHEN {v} IS NULL OR {v} = 0 THEN {v} ELSE {v} + (CASE WHEN {v} < 0 THEN -{b} ELSE {b} END) END)"
    neg = " OR ".join(f"coalesce(list_contains({negs}, {p}), false)" for p in prev)
    v = f"(CASE WHEN {neg} THEN {v} * ({N_SCALAR}) ELSE {v} END)"
    vals = f"list_transform(toks, lambda t, i: {v})"
    agg = f"""
      SELECT {ids}, round(coalesce(list_sum(list_transform(vals, lambda x: coalesce(x, 0.0))), 0.0), 6) AS s,
             round(coalesce(list_sum(list_transform(vals, lambda x: CASE WHEN x > 0 THEN x + 1 ELSE 0.0 END)), 0.0), 6) AS p,
             round(coalesce(list_sum(list_transform(vals, lambda x: CASE WHEN x < 0 THEN x - 1 ELSE 0.0 END)), 0.0), 6) AS n,
             len(list_filter(vals, lambda x: x IS NULL OR x = 0)) AS zc
      FROM (SELECT {ids}, {vals} AS vals
            FROM (SELECT {ids}, {tokens_sql(text)} AS toks FROM ({src})))"""
    tot = "(p + abs(n) + zc)"
    sz = _z("s")
    return f"""
      SELECT {ids},
             CASE WHEN {tot} > 0 THEN {_z(f'abs(n) / {tot}')} ELSE 0.0 END AS {prefix}_neg,
             CASE WHEN {tot} > 0 THEN {_z(f'zc / {tot}')} ELSE 0.0 END AS {prefix}_neu,
             CASE WHEN {tot} > 0 THEN {_z(f'p / {tot}')} ELSE 0.0 END AS {prefix}_pos,
             CASE WHEN {tot} > 0 THEN {_z(f'({sz}) / sqrt(({sz}) * ({sz}) + 15.0)')} ELSE 0.0 END
               AS {prefix}_compound
      FROM ({agg})"""


@query("lexicon_valence_rules", f"""
    SELECT doc_id, {", ".join(R(f"text_{s}", f"text_{s}") for s in SCORES)}
    FROM ({valence_rules_sql('SELECT doc_id, text FROM documents', 'doc_id', 'text', 'text')})""")
def q_lexicon_valence_rules(spark, sf):
    """Valence with the context rules: a negation within three tokens flips and damps a
    valence, a booster word before it strengthens it (look-back by index, in place)."""
    d = read_table(spark, sf, "documents", "doc_id", "text")
    v = X.lexicon_valence(d, ["doc_id"], fx.lexicon(spark), negations=fx.NEGATION_WORDS,
                          boosters=fx.BOOSTER_WORDS)
    return report(v.select("doc_id", *[f"text_{s}" for s in SCORES]),
                  round_cols=tuple(f"text_{s}" for s in SCORES))
