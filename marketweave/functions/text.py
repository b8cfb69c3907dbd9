"""Column expressions for text: Unicode-aware strip, the message cleaner, blank tests,
tokenising and the content hash. All JVM-side (regexp_replace/split/md5), no UDFs.

Regex parity: Java's ``\\w`` is ASCII-only while Python's is Unicode, so word characters
are spelled ``[\\p{L}\\p{N}_]``; ``(?U)`` makes ``\\s`` Unicode-aware like Python's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
# The message-cleaning patterns, applied in this order.
URL_PATTERN = r"http\S+|www\S+"
MENTION_PATTERN = r"@" + WORD + "+"
HASHTAG_PATTERN = r"#" + WORD + "+"
# The fields of a record that identify its content, in hash order.
HASH_FIELDS = ("id", "title", "url", "text", "content", "tweet_id", "post_id", "symbol",
               "timestamp")


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ustrip(x: str | Column) -> Column:
    """Strip leading/trailing Unicode whitespace (``trim`` only removes spaces)."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def is_blank(x: str | Column) -> Column:
    """True for null or whitespace-only text (same as ``strip(x) == ''``; the search
    stops at the first non-space character instead of rewriting the whole text)."""
    c = _c(x)
    return c.isNull() | ~c.rlike(r"(?U)\S")


def clean_text(x: str | Column) -> Column:
    """Remove URLs, @mentions and #hashtags, newlines → space, strip, collapse runs of
    whitespace to one space. Not anchored: ``a@b.com`` loses ``@b``, as in the reference."""
    c = _c(x)
    c = F.regexp_replace(c, URL_PATTERN, "")
    c = F.regexp_replace(c, MENTION_PATTERN, "")
    c = F.regexp_replace(c, HASHTAG_PATTERN, "")
    c = F.regexp_replace(c, "\n", " ")
    c = ustrip(c)
    return F.regexp_replace(c, r"(?U)\s+", " ")


def tokens(x: str | Column) -> Column:
    """Lower-cased word tokens (maximal runs of word characters), empties removed."""
    parts = F.split(F.lower(_c(x)), r"[^\p{L}\p{N}_]+")
    return F.filter(parts, lambda t: t != "")


def _truthy(c: Column, dtype: str) -> Column:
    """Python truthiness of a field: not null, not empty text, not 0, not false."""
    if dtype == "string":
        return c.isNotNull() & (c != "")
    if dtype == "boolean":
        return c.isNotNull() & c
    if dtype in ("int", "bigint", "smallint", "tinyint", "double", "float") or \
            dtype.startswith("decimal"):
        return c.isNotNull() & (c != 0)
    return c.isNotNull()


def content_hash(df_columns: Sequence[tuple[str, str]], fields: Sequence[str] = HASH_FIELDS
                 ) -> Column:
    """md5 hex of ``field:value`` for the truthy identifying fields (in ``fields`` order)
    joined by ``||``; when no identifying field is present in the schema or all are
    falsy, md5 of the whole record as key-sorted JSON.

    ``df_columns`` is ``df.dtypes``. Bit-equal to the reference for string fields;
    numbers and timestamps are rendered by Spark's cast to string.
    """
    types = dict(df_columns)
    present = [f for f in fields if f in types]
    parts = [F.when(_truthy(F.col(f), types[f]),
                    F.concat(F.lit(f + ":"), F.col(f).cast("string"))) for f in present]
    whole = F.md5(F.to_json(F.struct(*[F.col(c) for c in sorted(types)])))
    if not parts:
        return whole
    keyed = F.concat_ws("||", *parts)
    return F.when(keyed != "", F.md5(keyed)).otherwise(whole)
