"""WARC revisits: resolving not-modified records to the full response they stand for.

A revisit is joined as of its time to the latest earlier full response of the same canonical
URL; its validators must agree with that response (strong or weak entity tag, else the
modification date), and the headers a not-modified answer may renew replace the stored ones.

The as-of join never sorts all captures of one URL together. Time is cut into ``SLICES``
slices (``PARTS`` of about as many rows each, cut into equal slices, so a stray time widens
those of one part only): the last response of a (URL, slice) is a pre-aggregated maximum, a running
maximum over the at most ``SLICES`` slices of a URL carries it forward, and only the records
of one slice are ordered among themselves. Payloads do not travel, only record numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketweave.session import cut_lineage

SLICES = 4096
PARTS = 64
# The fields a 304 answer renews in a stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, default port, fragment and ``utm_`` parameters dropped,
    the other parameters sorted, an empty path as ``/``."""
    bare = F.regexp_replace(url, "#.*$", "")
    origin = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", 0)
    rest = F.substr(bare, F.length(origin) + 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(origin), r"^(http://.*):80$", "$1"),
                            r"^(https://.*):443$", "$1")
    path = F.regexp_extract(rest, r"^[^?]*", 0)
    params = F.array_sort(F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"),
                                   lambda p: (p != "") & ~p.rlike("^utm_[a-z]+=")))
    return F.concat(host, F.when(path == "", "/").otherwise(path),
                    F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&")))
                    .otherwise(""))


def _slice(records: DataFrame, slices: int) -> Column:
    """The slice of a row's ``at``, which grows with it; null for a null time."""
    parts = max(1, min(PARTS, slices))
    near = records.agg(F.percentile_approx("at", [i / parts for i in range(parts + 1)])).first()[0]
    cuts = sorted(set(near or [0]))
    each = max(1, slices // parts)
    at = F.col("at").cast("double")
    out = F.when(F.col("at") < cuts[0], -1)
    for k, lo in reversed(list(enumerate(cuts))):
        width = (cuts[k + 1] - lo if k + 1 < len(cuts) else 1) / each
        own = F.least(F.floor((at - F.lit(float(lo))) / F.lit(width)), F.lit(each - 1))
        out = out.when(F.col("at") >= lo, F.lit(k * each) + F.greatest(own, F.lit(0)))
    return out


def resolve_revisits(records: DataFrame, slices: int = SLICES) -> DataFrame:
    """``(record_id, canonical, outcome, refers_to, headers)`` for every ``revisit`` of
    ``records(record_id long, url, at long, kind, headers map)``.

    ``outcome`` is ``resolved``, ``changed`` (the response's validators differ),
    ``unvalidated`` (the revisit has none, or the response lacks the one it has), ``orphan``
    (no earlier response of the URL) or ``invalid`` (null URL or time). ``refers_to`` and the
    merged headers are null unless resolved. Header names are compared in lower case; null
    headers are none. Of responses at one time the largest record number counts; a response
    at the revisit's own time is not earlier. Repeated rows are resolved each; of responses that
    repeat a record number any one's headers are merged; other columns are ignored; no rows
    give no rows.
    """
    head = F.coalesce("headers", F.create_map().cast("map<string,string>"))
    r = cut_lineage(records.select(
        "record_id", canonical_url(F.col("url")).alias("canonical"), "at", "kind",
        F.transform_keys(head, lambda k, v: F.lower(k)).alias("headers")))
    r = r.withColumn("slice", _slice(r, slices))
    full = (F.col("kind") == "response") & F.col("canonical").isNotNull() & F.col("at").isNotNull()
    ref = F.struct("at", "record_id", F.col("headers")["etag"].alias("etag"),
                   F.col("headers")["last-modified"].alias("modified"))
    # what happens inside one slice of one URL
    earlier = (W.partitionBy("canonical", "slice").orderBy("at")
               .rangeBetween(W.unboundedPreceding, -1))
    near = (r.withColumn("near", F.max(F.when(full, ref)).over(earlier))
            .filter("kind = 'revisit'"))
    # what earlier slices hand on
    last = r.filter(full).groupBy("canonical", "slice").agg(F.max(ref).alias("top"))
    wanted = near.select("canonical", "slice").distinct().withColumn(
        "top", F.lit(None).cast(last.schema["top"].dataType))
    before = (W.partitionBy("canonical").orderBy("slice")
              .rangeBetween(W.unboundedPreceding, -1))
    carried = (last.withColumn("ask", F.lit(False)).unionByName(wanted.withColumn("ask", F.lit(True)))
               .withColumn("carried", F.max("top").over(before)).filter("ask")
               .select(F.col("canonical").alias("c"), F.col("slice").alias("s"), "carried"))
    found = (near.join(carried, near["canonical"].eqNullSafe(F.col("c"))
                       & near["slice"].eqNullSafe(F.col("s")), "left")
             .withColumn("ref", F.coalesce("near", "carried")))
    strong = lambda c: F.regexp_replace(c, "^W/", "")
    etag, modified = F.col("headers")["etag"], F.col("headers")["last-modified"]
    outcome = (F.when(F.col("canonical").isNull() | F.col("at").isNull(), "invalid")
               .when(F.col("ref").isNull(), "orphan")
               .when(etag.isNotNull(), F.when(F.col("ref.etag").isNull(), "unvalidated")
                     .when(strong(etag) == strong(F.col("ref.etag")), "resolved").otherwise("changed"))
               .when(modified.isNotNull(), F.when(F.col("ref.modified").isNull(), "unvalidated")
                     .when(modified == F.col("ref.modified"), "resolved").otherwise("changed"))
               .otherwise("unvalidated"))
    found = found.select("record_id", "canonical", "headers", outcome.alias("outcome"),
                         F.col("ref.record_id").alias("ref_id"))
    # a revisit that finds no response joins nothing: it goes where the hash of its own names sends it
    done = F.col("outcome") == "resolved"
    found = found.select("*", F.coalesce(F.when(done, F.col("ref_id")),
                                         F.xxhash64("record_id", "canonical")).alias("key"),
                         (done & F.col("ref_id").isNotNull()).alias("known"))
    stored = (r.filter(full & F.col("record_id").isNotNull())
              .select(F.col("record_id").alias("key"), F.lit(True).alias("known"),
                      F.col("headers").alias("stored"))
              .dropDuplicates(["key"]))
    renewed = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(
        F.map_filter("stored", lambda k, v: ~F.array_contains(F.map_keys(F.col("renewed")), k)),
        F.col("renewed"))
    return (found.withColumn("renewed", renewed).join(stored, ["key", "known"], "left")
            .select("record_id", "canonical", "outcome",
                    F.when(done, F.col("ref_id")).alias("refers_to"),
                    F.when(done, merged).alias("headers")))


def captures(pages: DataFrame) -> DataFrame:
    """Capture records of ``pages(page_id, url, html)``: per page a full response, a later
    not-modified answer to a differently spelled URL (every fourth with a stale tag), and an
    answer from before the page's own response that carries a date only."""
    day = lambda s: F.concat(F.lit("day "), s.cast("string"))
    pid = F.col("page_id")
    tag = F.md5("html")
    full = pages.select(
        (pid * 3).alias("record_id"), "url", (pid * 60).alias("at"), F.lit("response").alias("kind"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"),
                     F.lit("ETag"), F.concat(F.lit('"'), tag, F.lit('"')),
                     F.lit("Last-Modified"), day(pid % 7), F.lit("Date"), day(pid),
                     F.lit("Content-Length"), F.octet_length("html").cast("string")).alias("headers"))
    later = pages.select(
        (pid * 3 + 1).alias("record_id"), F.concat("url", F.lit("#again")).alias("url"),
        (pid * 60 + 86400 * (1 + pid % 3)).alias("at"), F.lit("revisit").alias("kind"),
        F.create_map(F.lit("content-type"), F.lit("none"), F.lit("date"), day(pid + 1),
                     F.lit("expires"), day(pid + 2),
                     F.lit("etag"), F.when(pid % 4 == 0, F.lit('"stale"'))
                     .otherwise(F.concat(F.lit('W/"'), tag, F.lit('"')))).alias("headers"))
    before = pages.select(
        (pid * 3 + 2).alias("record_id"), "url", (pid * 60 - 30).alias("at"),
        F.lit("revisit").alias("kind"),
        F.create_map(F.lit("Last-Modified"), day(pid % 7)).alias("headers"))
    return full.unionByName(later).unionByName(before)
