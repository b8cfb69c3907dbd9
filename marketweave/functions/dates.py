"""Multi-format timestamp parsing under ANSI mode.

Every parse goes through ``try_to_timestamp`` (a bad *value* gives null instead of an
error). Spark 4 rejects the weekday letter ``EEE`` in parse patterns, so a leading
weekday is cut off first — only where a regex shows one is there. Results are
``timestamp`` values; jobs run with the session time zone set to UTC.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date formats tried for news articles, in order (ISO with Z, ISO with
# fraction and Z, plain, RFC-822 with the weekday removed).
NEWS_FORMATS = ("yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX",
                "yyyy-MM-dd HH:mm:ss")
RFC822_FORMAT = "d MMM yyyy HH:mm:ss z"
# The formats tried for short messages, in order (two weekday forms with
# the weekday removed, ISO with fraction and Z, ISO with Z, plain).
SOCIAL_WEEKDAY_FORMATS = ("MMM d HH:mm:ss Z yyyy",)
SOCIAL_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSSX", "yyyy-MM-dd'T'HH:mm:ssX",
                  "yyyy-MM-dd HH:mm:ss")

_WEEKDAY_COMMA = r"^[A-Z][a-z]{2}, "
_WEEKDAY_SPACE = r"^[A-Z][a-z]{2} [A-Z][a-z]{2} "


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _try(x: Column, fmt: str) -> Column:
    return F.try_to_timestamp(x, F.lit(fmt))


def parse_with_formats(x: str | Column, formats: Sequence[str]) -> Column:
    c = _c(x)
    return F.coalesce(*[_try(c, f) for f in formats])


def parse_news_date(x: str | Column, default: Column | None = None) -> Column:
    """The documented intent of the news cleaner: try every format on the original text;
    what none parses takes ``default`` (an explicit ``as_of`` instead of ``now()``)."""
    c = _c(x)
    rfc = F.when(c.rlike(_WEEKDAY_COMMA), _try(F.substring(c, 6, 1 << 20), RFC822_FORMAT))
    parsed = F.coalesce(parse_with_formats(c, NEWS_FORMATS), rfc)
    return parsed if default is None else F.coalesce(parsed, default)


def parse_social_date(x: str | Column) -> Column:
    """Short-message ``created_at`` ('Sun May 11 12:58:38 +0000 2025' and ISO forms);
    null when no format matches (the cleaner drops those rows)."""
    c = _c(x)
    wk = F.when(c.rlike(_WEEKDAY_SPACE),
                parse_with_formats(F.substring(c, 5, 1 << 20), SOCIAL_WEEKDAY_FORMATS))
    return F.coalesce(wk, parse_with_formats(c, SOCIAL_FORMATS))


def parse_generic(x: str | Column) -> Column:
    """Coercing parse of ISO-like text, including a bare year ('2015' → 2015-01-01)."""
    return F.try_to_timestamp(_c(x))


def epoch_to_ts(x: str | Column) -> Column:
    """Epoch seconds (number or text) → timestamp; bad values → null."""
    return F.timestamp_seconds(_c(x).cast("string").try_cast("double"))
