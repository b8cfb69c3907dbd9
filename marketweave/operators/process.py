"""Per-kind processing (the reference's ``process_raw_data``): clean the kind with its
own rules, score its text with the lexicon (news, short messages, posts), normalise
for storage. One lazy plan per kind; nothing is materialised between the steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from marketweave.operators import macro, news, posts, sentiment, social, stock, tables

KINDS = ("stock", "news", "messages", "posts", "macro")
# The data-type names used by the collectors, mapped to the kinds above.
KIND_ALIASES = {"twitter": "messages", "reddit": "posts", "economic": "macro"}


def process_kind(df: DataFrame, kind: str, as_of: str, lexicon: DataFrame | None = None,
                 id_col: str = "doc_id", sentiment_model: str = "valence") -> DataFrame:
    """Clean → (score) → storage form for one kind of record. ``sentiment_model`` picks the
    scorer of news, messages and posts with their comments: ``valence`` (lexicon of token,
    valence) or ``polarity`` (lexicon of token, polarity, subjectivity)."""
    kind = KIND_ALIASES.get(kind, kind)
    cleaners: dict[str, Callable[[DataFrame], DataFrame]] = {
        "stock": stock.clean_bars,
        "news": lambda d: news.clean_news(d, as_of, order_by=(id_col,)),
        "messages": lambda d: social.clean_tweets(d, as_of, order_by=(id_col,)),
        "posts": lambda d: posts.clean_posts(d, as_of),
        "macro": lambda d: macro.sort_macro(macro.clean_macro(d)),
    }
    if kind not in cleaners:
        raise ValueError(f"unknown kind {kind!r}; expected one of {KINDS}")
    out = cleaners[kind](df)
    if kind in ("news", "messages", "posts") and lexicon is not None:
        score = sentiment.lexicon_valence if sentiment_model == "valence" else sentiment.lexicon_polarity
        out = sentiment.post_sentiment(score(out, [id_col], lexicon), sentiment_model)
        if kind == "posts" and "comments" in out.columns:
            out = sentiment.comment_sentiment(out, id_col, lexicon, model=sentiment_model)
    return tables.to_document(out)


def process_all(frames: dict[str, DataFrame], out_root: str, as_of: str,
                lexicon: DataFrame | None = None, id_cols: dict[str, str] | None = None,
                sentiment_model: str = "valence") -> list[tuple[str, str, str]]:
    """Process every kind into ``<out_root>/<kind>`` (one job per kind, each writing its
    own table). A failing kind is reported and the others still run; returns
    ``(kind, path, status)`` per kind."""
    status = []
    for kind, df in frames.items():
        path = f"{out_root.rstrip('/')}/{KIND_ALIASES.get(kind, kind)}"
        try:
            out = process_kind(df, kind, as_of, lexicon, (id_cols or {}).get(kind, "doc_id"),
                               sentiment_model)
            out.write.mode("overwrite").parquet(path)
            status.append((kind, path, "ok"))
        except Exception as e:  # noqa: BLE001 - isolate one kind's failure
            status.append((kind, path, f"failed: {type(e).__name__}: {str(e)[:500]}"))
    return status
