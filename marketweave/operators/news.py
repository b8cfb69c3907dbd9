"""News articles: unnest API payloads, extract articles from HTML pages, clean.

The cleaner follows the reference's order of steps: ensure required columns → parse
``publishedAt`` → drop duplicate (title, description) keeping the first → drop articles
whose title and description are both blank → stamp → fill defaults.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketweave.functions.dates import parse_news_date
from marketweave.functions.text import is_blank, ustrip
from marketweave.operators.dedup import keep_first

# Required article columns and the defaults of the news cleaner.
REQUIRED_COLUMNS = ("title", "description", "publishedAt", "source", "url")
FILL_DEFAULTS = {"author": "Unknown", "source": "Unknown", "url": "", "country": "N/A"}
PLACEHOLDER = {"title": "No news articles available", "description": "No description available",
               "source": "System", "sentiment_score": 0.0}
NO_TITLE = "No title available"
NO_DESCRIPTION = "No description available"

ARTICLE_SCHEMA = ("array<struct<title:string, description:string, publishedAt:string, "
                  "author:string, source:struct<name:string>, url:string, country:string>>")


def ensure_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Add each missing required column as the text ``No <col> available`` (plan-time)."""
    missing = [c for c in required if c not in df.columns]
    return df.withColumns({c: F.lit(f"No {c} available") for c in missing}) if missing else df


def unnest_articles(payloads: DataFrame, col: str = "payload",
                    keep: Sequence[str] = ()) -> DataFrame:
    """``{"articles": [...]}`` JSON text → one row per non-null article, with
    ``source.name`` lifted and per-field defaults ('' / Unknown / N/A). A JSON null and a
    missing key are treated alike (both take the default)."""
    arts = F.from_json(F.get_json_object(F.col(col), "$.articles"), ARTICLE_SCHEMA)
    e = payloads.select(*keep, F.explode(arts).alias("a")).where(F.col("a").isNotNull())
    a = F.col("a")
    return e.select(
        *keep,
        F.coalesce(a["title"], F.lit("")).alias("title"),
        F.coalesce(a["description"], F.lit("")).alias("description"),
        F.coalesce(a["publishedAt"], F.lit("")).alias("publishedAt"),
        F.coalesce(a["author"], F.lit("")).alias("author"),
        F.coalesce(a["source"]["name"], F.lit("Unknown")).alias("source"),
        F.coalesce(a["url"], F.lit("")).alias("url"),
        F.coalesce(a["country"], F.lit("N/A")).alias("country"))


# ---------------------------------------------------------------- HTML pages

_DROP_BLOCKS = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
_TAG = r"<[^>]*>"
_QUOTED = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
# A page as a sequence of comments, scripts and styles, tags (quoted values may hold '>'),
# declarations, and text. The tag without quotes is for tags whose quotes do not pair up.
_TOKENS = (r"(?is)<!--.*?(?:-->|\z)"
           rf"|<script\b{_QUOTED}>.*?</script\s*>|<style\b{_QUOTED}>.*?</style\s*>"
           rf"|</?[a-z]{_QUOTED}>|</?[a-z][^>]*>|<[!?][^>]*>|[^<]+|<")
_ATTRIBUTES = r"""(?s)[^\s"'>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?"""
# HTML entities decoded in extracted text (``&amp;`` last).
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&"))


def _numeric_entities(t: Column) -> Column:
    """``&#8217;`` and ``&#x2019;`` decoded: the text is cut at each and the pieces joined by
    the characters they name."""
    pattern = r"&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"
    codes = F.transform(F.regexp_extract_all(t, F.lit(pattern), 1), lambda c: F.when(
        c.rlike("^[xX]"), F.conv(F.substr(c, F.lit(2)), 16, 10)).otherwise(c).cast("int"))
    # code points beyond one byte are assembled from their UTF-16 units
    def unit(n):
        return F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE")

    def pair(n):
        hi, lo = F.lit(0xD800) + F.floor((n - 0x10000) / 0x400), F.lit(0xDC00) + (n - 0x10000) % 0x400
        return F.decode(F.unhex(F.concat(F.hex(hi.cast("int")), F.hex(lo.cast("int")))), "UTF-16BE")

    chars = F.transform(codes, lambda n: F.when((n <= 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF),
                                                F.lit("\ufffd"))
                        .when(n < 0x10000, unit(n)).otherwise(pair(n)))
    pieces = F.split(t, pattern, -1)
    return F.when(t.rlike(pattern), F.array_join(F.transform(pieces, lambda p, i: F.concat(
        p, F.coalesce(F.get(chars, i), F.lit("")))), "")).otherwise(t)


def _decoded(t: Column) -> Column:
    """Named and numeric entities decoded. ``t`` is named often: pass a column, not a formula."""
    t = _numeric_entities(t)
    for ent, ch in ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return t


def html_text(fragment: Column) -> Column:
    """Tags removed, named and numeric entities decoded, outer whitespace stripped."""
    return ustrip(_decoded(F.regexp_replace(fragment, _TAG, "")))


def once(df: DataFrame, keep: Sequence[str], **cols: Column) -> DataFrame:
    """``keep`` and ``cols``, each of which is computed once a row however often later
    expressions name it (a generator stands between the two)."""
    row = F.struct(*[c.alias(n) for n, c in cols.items()])
    return df.select(*keep, F.explode(F.array(row)).alias("_row")).select(*keep, "_row.*")


def html_tokens(pages: DataFrame, html: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` and, per page, its tags and texts in order: ``_token`` holds them as written,
    ``_name`` the lower-case names of the tags (``/name`` of an end tag, '' of a text).
    Comments, scripts, styles and declarations are left out."""
    tokens = F.filter(F.regexp_extract_all(F.col(html), F.lit(_TOKENS), 0), lambda t: ~t.rlike(
        r"(?i)^<(?:!|\?|script\b|style\b)"))
    df = once(pages, keep, _token=tokens)
    return once(df, [*keep, "_token"], _name=F.transform("_token", lambda t: F.lower(
        F.regexp_extract(t, "^<(/?[a-zA-Z][a-zA-Z0-9]*)", 1))))


def element_text(tag: str, ends: Sequence[str], must_end: bool = True) -> Column:
    """The raw text inside the first ``tag`` of a token stream, nested tags left out: up to the
    first of the names ``ends``, or to the end of the page where the element need not end.
    Null: no such element."""
    at = F.array_position("_name", tag)
    size = F.size("_name")
    after = F.slice("_name", at + 1, size)
    end = [F.nullif(F.array_position(after, e), F.lit(0)) for e in ends]
    end = F.least(*end) if len(end) > 1 else end[0]
    inside = F.slice("_token", at + 1, (end if must_end else F.coalesce(end, size + 1)) - 1)
    text = F.array_join(F.filter(inside, lambda t: ~t.rlike(r"^</?[a-zA-Z]")), "")
    return F.when((at > 0) & (end.isNotNull() if must_end else F.lit(True)), text)


def first_attribute(tag: str, attribute: str) -> Column:
    """The value of an attribute of the first ``tag`` as written, quotes removed (null: none).
    Attributes are read one after another, so a quoted value is never taken for one."""
    first = F.get("_token", (F.nullif(F.array_position("_name", tag), F.lit(0)) - 1).cast("int"))
    found = F.get(F.filter(F.regexp_extract_all(first, F.lit(_ATTRIBUTES), 0), lambda x: x.rlike(
        rf"(?i)^{attribute}\s*=")), 0)
    return F.regexp_replace(F.regexp_replace(found, r"(?s)^[^=]*=\s*", ""), r"""(?s)^(["'])(.*)\1$""", "$2")


def html_article_extract(pages: DataFrame, html: str = "html", url: str = "url",
                         title_tags: Sequence[str] = ("h3", "h1"), source_name: str = "web",
                         keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Per page: title = text of the first heading among ``title_tags`` (tried in order, an
    empty one counting as none), link = ``href`` of the first ``<a>``, description = text of the
    first ``<p>`` (up to its end or the next ``<p>``, which ends it), with the reference's
    fallbacks; the link is made absolute with the page's origin.

    One regex pass makes the page a stream of tags and texts, which array functions walk:
    attributes may hold ``>`` in quotes or have no quotes, tags inside an element are left
    out, comments, scripts and styles never count. JVM-side; no per-row Python."""
    stream = html_tokens(pages.select(*keep, F.col(url).alias("_page_url"), html), html, [*keep, "_page_url"])
    found = once(stream, [*keep, "_page_url"],
                 _title=F.coalesce(*[F.nullif(element_text(t, [f"/{t}"]), F.lit("")) for t in title_tags]),
                 _para=element_text("p", ["/p", "p"], must_end=False),
                 _link=first_attribute("a", "href"))
    out = once(found, [*keep, "_page_url"], title=ustrip(_decoded(F.col("_title"))),
               description=ustrip(_decoded(F.col("_para"))), _link=_decoded(F.col("_link")))
    return out.select(
        *keep, F.coalesce("title", F.lit(NO_TITLE)).alias("title"),
        F.coalesce("description", F.lit(NO_DESCRIPTION)).alias("description"),
        abs_url(F.col("_link"), F.col("_page_url")).alias("url"), F.lit(source_name).alias("source"))


def abs_url(link: Column, page_url: Column | None = None, prefix: str | None = None
            ) -> Column:
    """Relative link → absolute (``prefix`` or the page's scheme://host); empty stays
    empty; links that already carry a scheme are kept."""
    origin = F.lit(prefix) if prefix is not None else \
        F.regexp_extract(page_url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    return (F.when(link.isNull() | (link == ""), F.lit(""))
             .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
             .otherwise(F.concat(origin, link)))


# ---------------------------------------------------------------- cleaning steps

def parse_published(df: DataFrame, as_of: str, col: str = "publishedAt") -> DataFrame:
    return df.withColumn(col, parse_news_date(col, F.lit(as_of).cast("timestamp")))


def dedup_title_desc(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Keep the first article per (title, description) — nulls equal each other; falls
    back to one column when the other is absent."""
    keys = [c for c in ("title", "description") if c in df.columns]
    return keep_first(df, keys, order_by) if keys else df


def drop_blank_articles(df: DataFrame) -> DataFrame:
    """null → '' in title/description, then drop rows where both are blank after a
    Unicode strip (only the title when there is no description column)."""
    if "title" not in df.columns:
        return df
    out = df.withColumn("title", F.coalesce("title", F.lit("")))
    if "description" in df.columns:
        out = out.withColumn("description", F.coalesce("description", F.lit("")))
        return out.where(~(is_blank("title") & is_blank("description")))
    return out.where(~is_blank("title"))


def fill_defaults(df: DataFrame, defaults: dict[str, str] = FILL_DEFAULTS) -> DataFrame:
    out = df if "sentiment_score" in df.columns else \
        df.withColumn("sentiment_score", F.lit(0.0))
    present = {k: v for k, v in defaults.items() if k in out.columns}
    return out.na.fill(present) if present else out


def stamp_processed(df: DataFrame, as_of: str, col: str = "processed_date") -> DataFrame:
    return df.withColumn(col, F.lit(as_of[:10]))


def default_row_if_empty(df: DataFrame, placeholder: dict | None = None) -> DataFrame:
    """Empty input → exactly one placeholder row; non-empty input unchanged. Decided
    inside the plan by an uncorrelated ``NOT EXISTS`` subquery (it stops at the first
    row), no driver-side count."""
    spark = df.sparkSession
    values = dict(PLACEHOLDER if placeholder is None else placeholder)
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.unionByName(row.where(~df.exists()), allowMissingColumns=True)


def clean_news(df: DataFrame, as_of: str, order_by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The news cleaner (see module doc); ``as_of`` replaces ``now()`` for unparseable
    dates and the processed date."""
    out = ensure_columns(df)
    out = parse_published(out, as_of)
    out = dedup_title_desc(out, order_by)
    out = drop_blank_articles(out)
    out = stamp_processed(out, as_of)
    return fill_defaults(out)
