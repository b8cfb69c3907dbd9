"""Forum posts with nested comment arrays: source-side quality filter, top comments,
required fields, comment counts and combined text — all with higher-order functions on
the nested array (no explode/regroup, no per-row Python)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketweave.functions.dates import epoch_to_ts


def quality_filter_posts(df: DataFrame, min_score: int = 10) -> DataFrame:
    """``score > 10 AND NOT over_18``."""
    return df.where((F.col("score") > min_score) & ~F.col("over_18"))


def top_comments(comments: str | Column, n: int = 5, score: str = "comment_score",
                 pos: str = "pos") -> Column:
    """The ``n`` highest-scored comments, descending, stable (equal scores keep their
    original order via the position field)."""
    c = F.col(comments) if isinstance(comments, str) else comments

    def cmp(a, b):
        return (F.when(a[score] > b[score], F.lit(-1)).when(a[score] < b[score], F.lit(1))
                 .when(a[pos] < b[pos], F.lit(-1)).when(a[pos] > b[pos], F.lit(1))
                 .otherwise(F.lit(0)))
    return F.slice(F.array_sort(c, cmp), 1, n)


def require_fields(df: DataFrame, cols: Sequence[str] = ("title", "subreddit")) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.na.drop(subset=present) if present else df


def valid_comment_count(comments: str | Column, text: str = "comment_text") -> Column:
    """Comments with a non-empty text; a null array counts 0."""
    c = F.col(comments) if isinstance(comments, str) else comments
    return F.coalesce(F.size(F.filter(c, lambda x: x[text].isNotNull() & (x[text] != ""))),
                      F.lit(0))


def combined_text(title: str | Column, comments: str | Column, text: str = "comment_text"
                  ) -> Column:
    """``title + ' ' + comment_1 + ' ' + ...`` in array order; empty comments add one
    space, null ones are skipped."""
    t = F.col(title) if isinstance(title, str) else title
    c = F.col(comments) if isinstance(comments, str) else comments
    parts = F.when(c.isNull(), F.array(t)).otherwise(
        F.concat(F.array(t), F.transform(c, lambda x: x[text])))
    return F.concat_ws(" ", parts)


def clean_posts(df: DataFrame, as_of: str) -> DataFrame:
    """Epoch → timestamp, drop posts without title/subreddit, comment count, combined
    text, processed date."""
    out = df.withColumn("created_at", epoch_to_ts("created_at"))
    out = require_fields(out)
    out = out.withColumns({"valid_comments_count": valid_comment_count("comments"),
                           "combined_text": combined_text("title", "comments")})
    return out.withColumn("processed_date", F.lit(as_of[:10]))
