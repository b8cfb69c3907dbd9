"""Short messages (tweets): shaping, date parsing, cleaning, per-term caps and totals.

Cleaner order as in the reference: parse ``created_at`` and drop unparseable rows →
drop blank text → keep the first row per text → language flag → cleaned text → stamp.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketweave.functions.dates import parse_social_date
from marketweave.functions.text import clean_text, is_blank
from marketweave.operators.dedup import keep_first

# Defaults of the message shaper.
SOCIAL_DEFAULTS = {"text": "", "author_name": "Unknown", "author_username": "Unknown",
                   "lang": "unknown"}


def social_defaults(df: DataFrame) -> DataFrame:
    """Missing text → '', author name/handle → Unknown, lang → unknown, a null
    ``sentiment`` placeholder, author cast to text."""
    out = df
    for c, v in SOCIAL_DEFAULTS.items():
        out = out.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(v))) \
            if c in out.columns else out.withColumn(c, F.lit(v))
    if "author" in out.columns:
        out = out.withColumn("author", F.col("author").cast("string"))
    return out.withColumn("sentiment", F.lit(None).cast("double"))


def parse_created(df: DataFrame, col: str = "created_at") -> DataFrame:
    """Parse ``created_at`` over the message formats; rows no format matches are dropped."""
    return df.withColumn(col, parse_social_date(col)).where(F.col(col).isNotNull())


def parse_stats(df: DataFrame, col: str = "created_at") -> DataFrame:
    """Parsed / failed counts of ``created_at`` in one aggregate."""
    ok = parse_social_date(col).isNotNull()
    return df.agg(F.count_if(ok).alias("parsed"), F.count_if(~ok).alias("failed"))


def parse_failures(df: DataFrame, order_by: Sequence[str], col: str = "created_at",
                   n: int = 5) -> DataFrame:
    """Up to ``n`` examples of unparseable values (first in ``order_by``)."""
    bad = df.where(parse_social_date(col).isNull())
    return bad.orderBy(*order_by).limit(n)


def drop_blank_text(df: DataFrame, col: str = "text") -> DataFrame:
    return df.where(~is_blank(col))


def dedup_text(df: DataFrame, order_by: Sequence[str], col: str = "text") -> DataFrame:
    """Keep the first message per text (skew-safe aggregate, see ``dedup``)."""
    return keep_first(df, [col], order_by)


def language_flag(df: DataFrame, col: str = "lang") -> DataFrame:
    """``is_english = lang == 'en'`` (null lang → False)."""
    return df.withColumn("is_english", F.coalesce(F.col(col) == "en", F.lit(False)))


def language_counts(df: DataFrame, col: str = "lang") -> DataFrame:
    return (language_flag(df, col).groupBy("is_english")
            .agg(F.count(F.lit(1)).alias("n")))


def add_clean_text(df: DataFrame, col: str = "text", out: str = "cleaned_text") -> DataFrame:
    return df.withColumn(out, clean_text(col))


def clean_tweets(df: DataFrame, as_of: str, order_by: Sequence[str] = ("doc_id",)
                 ) -> DataFrame:
    out = parse_created(df)
    out = drop_blank_text(out)
    out = dedup_text(out, order_by)
    out = language_flag(out)
    out = add_clean_text(out)
    return out.withColumn("processed_date", F.lit(as_of[:10]))


def per_term_cap(df: DataFrame, n: int, term: str = "event_type",
                 order_by: Sequence | None = None) -> DataFrame:
    """At most ``n`` rows per search term, latest first. The rank filter is planned as a
    WindowGroupLimit before the shuffle, so each task forwards at most ``n`` rows per
    term however hot the term is."""
    w = Window.partitionBy(term).orderBy(*(order_by or [F.desc("doc_id")]))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def term_totals(df: DataFrame, term: str = "event_type") -> DataFrame:
    """Rows per search term plus a grand-total row (``term`` null) via ROLLUP."""
    return df.rollup(term).agg(F.count(F.lit(1)).alias("n"))
