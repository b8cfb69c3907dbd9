"""Registered queries for table maintenance, content hashing, JSON sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketweave.operators import tables as TB
from marketweave.plans.catalog import R, TS, query, report
from marketweave.session import scratch_path
from marketweave.sources import fixtures as fx
from marketweave.sources.json_io import (malformed_roots, normalise_root, scan_json_records,
                                         write_json_arrays)
from marketweave.sources.json_split import scan_json_splits
from marketweave.sources.tables import read_table

AS_OF = "2024-01-15 00:00:00"
CUST_COLS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def _customer_batches(spark, sf):
    """Stored table and an incoming batch of customers (two arrivals per key), from the
    customer table split three ways by key: stored only, both, incoming only. Every tenth
    key of the batch is null, and the batch has a column the stored table lacks."""
    c = read_table(spark, sf, "customer", *CUST_COLS)
    target = c.where(F.col("c_custkey") % 3 != 0)
    inc = c.where(F.col("c_custkey") % 3 != 1)
    seg = F.when(F.col("c_custkey") % 5 == 0, F.lit(None).cast("string")) \
        .otherwise(F.col("c_mktsegment"))
    key = F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey"))
    a1 = inc.withColumns({"c_acctbal": F.col("c_acctbal") + 100, "c_mktsegment": seg,
                          "c_tier": F.lit("basic"), "arrival": F.lit(1),
                          "seq": F.col("c_custkey"), "c_custkey": key})
    a2 = inc.withColumns({"c_acctbal": F.col("c_acctbal") + 200, "c_mktsegment": seg,
                          "c_name": F.lit(None).cast("string"),
                          "c_tier": F.when(F.col("c_custkey") % 2 == 0, F.lit("plus")),
                          "arrival": F.lit(2), "seq": F.col("c_custkey"), "c_custkey": key})
    return target, a1.unionByName(a2)


_BATCH_SQL = """
    t AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
          WHERE c_custkey % 3 <> 0),
    arrivals AS (
            SELECT c_custkey AS seq, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal,
                   c_mktsegment, 'basic' AS c_tier, 1 AS arrival
            FROM customer WHERE c_custkey % 3 <> 1
            UNION ALL
            SELECT c_custkey, NULL, c_nationkey, c_acctbal + 200, c_mktsegment,
                   CASE WHEN c_custkey % 2 = 0 THEN 'plus' END, 2
            FROM customer WHERE c_custkey % 3 <> 1),
    inc AS (SELECT CASE WHEN seq % 10 <> 0 THEN seq END AS c_custkey, c_name, c_nationkey, c_acctbal,
                   CASE WHEN seq % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
                   c_tier, arrival, seq
            FROM arrivals),
    firsts AS (SELECT * FROM inc
               QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY arrival, seq) = 1),
    fresh AS (SELECT * FROM firsts WHERE NOT EXISTS
              (SELECT 1 FROM t WHERE t.c_custkey IS NOT DISTINCT FROM firsts.c_custkey))"""


@query("insert_ignore", f"""
    WITH {_BATCH_SQL}
    SELECT *, NULL::VARCHAR AS c_tier FROM t
    UNION ALL
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_tier FROM fresh""")
def q_insert_ignore(spark, sf):
    target, incoming = _customer_batches(spark, sf)
    return TB.insert_ignore(target, incoming, ["c_custkey"], ["arrival", "seq"]).drop("arrival", "seq")


@query("insert_counts", f"""
    WITH {_BATCH_SQL}
    SELECT (SELECT count(*) FROM fresh) AS inserted,
           (SELECT count(*) FROM inc) - (SELECT count(*) FROM fresh) AS duplicates""")
def q_insert_counts(spark, sf):
    target, incoming = _customer_batches(spark, sf)
    return TB.insert_counts(target, incoming, ["c_custkey"], ["arrival", "seq"])


_MERGE_SQL = f"""
    WITH {_BATCH_SQL},
    b AS (SELECT c_custkey,
                 arg_max(c_name, arrival) FILTER (WHERE c_name IS NOT NULL) AS c_name,
                 arg_max(c_nationkey, arrival) FILTER (WHERE c_nationkey IS NOT NULL)
                   AS c_nationkey,
                 arg_max(c_acctbal, arrival) FILTER (WHERE c_acctbal IS NOT NULL) AS c_acctbal,
                 arg_max(c_mktsegment, arrival) FILTER (WHERE c_mktsegment IS NOT NULL)
                   AS c_mktsegment,
                 arg_max(c_tier, arrival) FILTER (WHERE c_tier IS NOT NULL) AS c_tier
          FROM inc WHERE c_custkey IS NOT NULL GROUP BY c_custkey)
    SELECT coalesce(t.c_custkey, b.c_custkey) AS c_custkey,
           coalesce(b.c_name, t.c_name) AS c_name,
           coalesce(b.c_nationkey, t.c_nationkey) AS c_nationkey,
           coalesce(b.c_acctbal, t.c_acctbal) AS c_acctbal,
           coalesce(b.c_mktsegment, t.c_mktsegment) AS c_mktsegment, b.c_tier,
           {TS(f"TIMESTAMP '{AS_OF}'", 'created_at')},
           CASE WHEN b.c_custkey IS NOT NULL THEN {TS(f"TIMESTAMP '{AS_OF}'")} END AS updated_at,
           CASE WHEN b.c_custkey IS NOT NULL AND t.c_custkey IS NULL THEN 'insert'
                WHEN b.c_custkey IS NOT NULL THEN 'update' ELSE 'keep' END AS action
    FROM t FULL OUTER JOIN b ON t.c_custkey = b.c_custkey"""


def _merged(spark, sf):
    target, incoming = _customer_batches(spark, sf)
    return TB.upsert_merge(target, incoming, ["c_custkey"], ["arrival", "seq"], AS_OF)


@query("upsert_merge", _MERGE_SQL)
def q_upsert_merge(spark, sf):
    return report(_merged(spark, sf), ts_cols=("created_at", "updated_at"))


@query("upsert_fields", f"""
    WITH t AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0),
    b AS (SELECT c_custkey,
                 c_custkey % 4 <> 3 AS has_name, CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE 'renamed' END AS c_name,
                 CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal + 200 END AS c_acctbal,
                 CASE WHEN c_custkey % 2 = 0 THEN 'vip' END AS c_tier
          FROM customer WHERE c_custkey % 3 <> 1)
    SELECT coalesce(t.c_custkey, b.c_custkey) AS c_custkey,
           CASE WHEN b.has_name THEN b.c_name ELSE t.c_name END AS c_name,
           CASE WHEN b.c_custkey IS NOT NULL THEN b.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
           t.c_mktsegment, b.c_tier,
           array_to_string(list_sort(list_distinct(list_concat(
             CASE WHEN t.c_custkey IS NOT NULL THEN ['c_custkey', 'c_name', 'c_acctbal', 'c_mktsegment'] ELSE [] END,
             CASE WHEN b.c_custkey IS NOT NULL THEN ['c_custkey', 'c_acctbal'] ELSE [] END,
             CASE WHEN b.has_name THEN ['c_name'] ELSE [] END,
             CASE WHEN b.c_custkey % 2 = 0 THEN ['c_tier'] ELSE [] END))), ',') AS fields,
           CASE WHEN b.c_custkey IS NULL THEN 'keep' WHEN t.c_custkey IS NULL THEN 'insert' ELSE 'update' END AS action
    FROM t FULL OUTER JOIN b ON t.c_custkey = b.c_custkey""")
def q_upsert_fields(spark, sf):
    """Customer documents upserted as JSON: of two arrivals per key the second sets the balance,
    on every fifth key to null; the name is set, set to null on every fourth key and
    absent on another fourth; the tier is absent on odd keys. A null that is set replaces the
    stored value, an absent field leaves it."""
    c = read_table(spark, sf, "customer", *CUST_COLS)
    k = F.col("c_custkey")
    schema = "c_custkey bigint, c_name string, c_acctbal double, c_tier string"

    def documents(doc):
        """Documents as they come, a null value written as such, with their fields."""
        text = c.where(k % 3 != 1).select(doc.alias("_d"))
        return text.select(F.from_json("_d", schema).alias("_r"), TB.document_fields(F.col("_d")).alias(TB.FIELDS)) \
            .select("_r.*", TB.FIELDS)

    def member(name, value, when=F.lit(True), null=F.lit(False)):
        v = F.when(null, F.lit("null")).otherwise(value)
        return F.when(when, F.concat(F.lit(f'"{name}":'), v))

    def document(*members):
        return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))

    key = member("c_custkey", k.cast("string"))
    first = documents(document(key, member("c_acctbal", (F.col("c_acctbal") + 100).cast("string")),
                               member("c_tier", F.lit('"vip"'), k % 2 == 0)))
    second = documents(document(
        key, member("c_acctbal", (F.col("c_acctbal") + 200).cast("string"), null=k % 5 == 0),
        member("c_name", F.lit('"renamed"'), k % 4 != 3, k % 4 == 1)))
    target = c.where(k % 3 != 0).select("c_custkey", "c_name", "c_acctbal", "c_mktsegment").withColumn(
        TB.FIELDS, F.array(*[F.lit(x) for x in ("c_custkey", "c_name", "c_acctbal", "c_mktsegment")]))
    batch = first.withColumn("arrival", F.lit(1)).unionByName(second.withColumn("arrival", F.lit(2)))
    m = TB.upsert_merge(target, batch, ["c_custkey"], ["arrival"], AS_OF)
    return m.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_tier",
                    F.array_join(TB.FIELDS, ",").alias("fields"), "action")


@query("write_counts", f"SELECT action, count(*) AS n FROM ({_MERGE_SQL}) GROUP BY action")
def q_write_counts(spark, sf):
    return TB.write_counts(_merged(spark, sf))


@query("stamp_columns", f"""
    SELECT c_custkey, {TS(f"TIMESTAMP '{AS_OF}'", 'created_at')},
           {TS(f"TIMESTAMP '{AS_OF}'", 'updated_at')}, '{AS_OF[:10]}' AS processed_date
    FROM customer""")
def q_stamp_columns(spark, sf):
    c = TB.stamp_columns(read_table(spark, sf, "customer", "c_custkey"), AS_OF)
    return report(c, ts_cols=("created_at", "updated_at"))


@query("ttl_sweep", f"""
    SELECT event_id, {TS('ts', 'created_at')} FROM events
    WHERE ts IS NULL OR ts > TIMESTAMP '{AS_OF}' - INTERVAL 86400 SECOND""")
def q_ttl_sweep(spark, sf):
    e = read_table(spark, sf, "events", "event_id", "ts").withColumnRenamed("ts", "created_at")
    return report(TB.ttl_sweep(e, AS_OF), ts_cols=("created_at",))


@query("mark_expiring", f"""
    SELECT event_id, {TS('c', 'created_at')},
           CASE WHEN event_type = 'error' THEN {TS("c + INTERVAL 24 HOUR")} END AS expires_at
    FROM (SELECT event_id, event_type,
                 CASE WHEN event_type = 'error' THEN TIMESTAMP '{AS_OF}' ELSE ts END AS c
          FROM events)""")
def q_mark_expiring(spark, sf):
    e = read_table(spark, sf, "events", "event_id", "ts", "event_type")
    ids = e.where(F.col("event_type") == "error").select("event_id")
    m = TB.mark_expiring(e.select("event_id", F.col("ts").alias("created_at")), ids,
                         "event_id", AS_OF)
    return report(m, ts_cols=("created_at", "expires_at"))


@query("dedup_keep_newest", """
    SELECT doc_id, n_chars FROM documents
    QUALIFY text IS NULL OR row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) = 1""")
def q_dedup_keep_newest(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text", "n_chars")
    d = d.withColumn("created_at", F.timestamp_add("MINUTE", F.col("doc_id"),
                                                   F.lit(fx.BASE_TS).cast("timestamp")))
    return TB.dedup_keep_newest(d, "text", "created_at", "doc_id").select("doc_id", "n_chars")


@query("removed_count", """
    SELECT count(*) - count(DISTINCT text) AS removed FROM documents""")
def q_removed_count(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    after = TB.dedup_keep_newest(d.withColumn("created_at", F.lit(None).cast("timestamp")),
                                 "text", "created_at", "doc_id")
    return TB.removed_count(d, after)


def _some_null_texts(spark, sf):
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return d.withColumn("text", F.when(F.col("doc_id") % 50 != 7, F.col("text")))


@query("duplicate_groups", """
    SELECT md5(t) AS key_hash, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id
    FROM (SELECT doc_id, CASE WHEN doc_id % 50 <> 7 THEN text END AS t FROM documents)
    GROUP BY t HAVING count(*) > 1""")
def q_duplicate_groups(spark, sf):
    """Equal texts; every fiftieth text is null here, and null is one group."""
    g = TB.duplicate_groups(_some_null_texts(spark, sf), "text", "doc_id")
    return g.select(F.md5("text").alias("key_hash"), "n", "first_id", "last_id")


@query("duplicate_members", """
    SELECT md5(t) AS key_hash, doc_id
    FROM (SELECT doc_id, CASE WHEN doc_id % 50 <> 7 THEN text END AS t FROM documents)
    QUALIFY count(*) OVER (PARTITION BY t) > 1""")
def q_duplicate_members(spark, sf):
    m = TB.duplicate_members(_some_null_texts(spark, sf), "text", "doc_id")
    return m.select(F.md5("text").alias("key_hash"), "doc_id")


@query("uniqueness_check", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_uniqueness_check(spark, sf):
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber")
    return TB.uniqueness_check(li, ["l_orderkey", "l_linenumber"])


_JUNK_PROPS = """CASE WHEN event_id % 13 = 0 THEN 'not json' WHEN event_id % 17 = 0 THEN '[1, 2]'
                      WHEN event_id % 19 = 0 THEN '42'
                      WHEN event_id % 23 = 0 THEN props || ' trailing'
                      WHEN event_id % 29 = 0 THEN '{''k'': 1}' ELSE props END"""


def _junk_props(e):
    k = F.col("event_id")
    return e.withColumn("props", F.when(k % 13 == 0, F.lit("not json"))
                        .when(k % 17 == 0, F.lit("[1, 2]")).when(k % 19 == 0, F.lit("42"))
                        .when(k % 23 == 0, F.concat("props", F.lit(" trailing")))
                        .when(k % 29 == 0, F.lit("{'k': 1}"))
                        .otherwise(F.col("props")))


@query("valid_docs", f"""
    SELECT event_id, coalesce(json_valid(p) AND starts_with(ltrim(p), '{{'), false) AS is_valid,
           CASE WHEN json_valid(p) AND starts_with(ltrim(p), '{{')
                THEN json_extract_string(p, '$.k') END AS k
    FROM (SELECT event_id, {_JUNK_PROPS} AS p FROM events)""")
def q_valid_docs(spark, sf):
    e = _junk_props(read_table(spark, sf, "events", "event_id", "props"))
    v = TB.valid_docs(e, "props")
    return v.select("event_id", "is_valid",
                    F.when(F.col("is_valid"), F.get_json_object("props", "$.k")).alias("k"))


@query("to_document", """
    SELECT event_id,
           strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
             CASE WHEN strftime(ts, '%f') <> '000000' THEN '.' || strftime(ts, '%f') ELSE '' END
             AS ts,
           value, props FROM events""")
def q_to_document(spark, sf):
    e = read_table(spark, sf, "events", "event_id", "ts", "value", "props")
    return TB.to_document(e)


@query("to_document_arrays", """
    SELECT vec_id, CASE WHEN len(embedding) = 0 THEN NULL ELSE CAST(len(embedding) AS BIGINT) END
             AS n_dims,
           label FROM embeddings""")
def q_to_document_arrays(spark, sf):
    e = TB.to_document(read_table(spark, sf, "embeddings", "vec_id", "embedding", "label"))
    return e.select("vec_id", F.size("embedding").cast("bigint").alias("n_dims"), "label") \
        .withColumn("n_dims", F.when(F.col("n_dims") >= 0, F.col("n_dims")))


@query("content_hash", """
    SELECT doc_id, md5('text:' || text) AS content_hash FROM documents""")
def q_content_hash(spark, sf):
    d = read_table(spark, sf, "documents")
    return TB.with_content_hash(d).select("doc_id", "content_hash")


@query("content_hash_pages", """
    SELECT page_id, md5('url:' || url) AS content_hash FROM pages""")
def q_content_hash_pages(spark, sf):
    p = read_table(spark, sf, "pages")
    return TB.with_content_hash(p).select("page_id", "content_hash")


@query("dedup_hash_batch", """
    SELECT doc_id, md5('text:' || text) AS content_hash FROM documents
    QUALIFY row_number() OVER (PARTITION BY md5('text:' || text) ORDER BY doc_id) = 1""")
def q_dedup_hash_batch(spark, sf):
    d = TB.with_content_hash(read_table(spark, sf, "documents", "doc_id", "text"))
    return TB.dedup_hash_batch(d, ["doc_id"]).select("doc_id", "content_hash")


@query("cross_run_dedup", """
    SELECT doc_id, md5('text:' || text) AS content_hash FROM documents
    WHERE doc_id % 2 = 1 AND md5('text:' || text) NOT IN
          (SELECT md5('text:' || text) FROM documents WHERE doc_id % 2 = 0)""")
def q_cross_run_dedup(spark, sf):
    """Run 2 (odd ids) against the hash state of run 1 (even ids)."""
    d = TB.with_content_hash(read_table(spark, sf, "documents", "doc_id", "text"))
    history = d.where(F.col("doc_id") % 2 == 0)
    batch = d.where(F.col("doc_id") % 2 == 1)
    return TB.cross_run_dedup(batch, history).select("doc_id", "content_hash")


# ------------------------------------------------------------ JSON sources and sinks

@query("write_json", f"""
    SELECT symbol, strftime(date, '%Y-%m-%d') AS date, {R('close', 'close')}, volume
    FROM v_bars""", ("v_bars",))
def q_write_json(spark, sf):
    """Bars written as JSON partitioned by symbol, read back with a fixed schema."""
    path = scratch_path(spark, "bars-json")
    b = fx.bars(spark, sf).select("symbol", "date", "close", "volume")
    TB.write_json(b, path, partition_by=["symbol"])
    back = spark.read.schema("date date, close double, volume bigint, symbol string").json(path)
    return back.select("symbol", F.date_format("date", "yyyy-MM-dd").alias("date"),
                       F.round("close", 6).alias("close"), "volume")


@query("write_csv", """
    SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""")
def q_write_csv(spark, sf):
    path = scratch_path(spark, "customer-csv")
    c = read_table(spark, sf, "customer", "c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    TB.write_csv(c, path)
    return (spark.read.option("header", True)
            .schema("c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string")
            .csv(path))


@query("scan_json_records", """
    SELECT event_id, event_type, CASE WHEN event_id % 11 <> 0 THEN value END AS value FROM events""")
def q_scan_json_records(spark, sf):
    """Events landed as JSON-array files (one per type and day) and scanned back; every
    eleventh value was landed as the text ``n/a`` and comes back null, alone."""
    path = scratch_path(spark, "events-json")
    e = read_table(spark, sf, "events", "event_id", "ts", "event_type", "value")
    e = e.withColumn("part", F.concat_ws("_", "event_type", F.date_format("ts", "yyyyMMdd")))
    mixed = F.when(F.col("event_id") % 11 == 0, F.parse_json(F.lit('"n/a"'))) \
        .otherwise(F.col("value").cast("variant"))
    write_json_arrays(e, path, "part", F.struct("event_id", "event_type", mixed.alias("value")))
    r = scan_json_records(spark, path, "event_id bigint, event_type string, value double")
    return r.select("event_id", "event_type", "value")


@query("scan_json_splits", """
    SELECT event_id, event_type, CASE WHEN event_id % 11 <> 0 THEN value END AS value, props FROM events""")
def q_scan_json_splits(spark, sf):
    """Events landed as one JSON-array file per type, payloads with their quotes and brackets
    inside strings, and read in ranges of 32 kB, each by a task of its own."""
    path = scratch_path(spark, "events-json")
    e = read_table(spark, sf, "events", "event_id", "event_type", "value", "props")
    mixed = F.when(F.col("event_id") % 11 == 0, F.parse_json(F.lit('"n/a"'))) \
        .otherwise(F.col("value").cast("variant"))
    write_json_arrays(e, path, "event_type", F.struct("event_id", "props", mixed.alias("value")), 1 << 30)
    r = scan_json_splits(spark, path, "event_id bigint, value double, props string", block_bytes=1 << 15)
    return r.select("event_id", "event_type", "value", "props")


@query("malformed_roots", """
    SELECT event_id FROM events
    WHERE event_id % 7 IN (1, 2) AND props IS NOT NULL""")
def q_malformed_roots(spark, sf):
    """Event payloads of which two in seven are cut short (an object without its end, an
    array without its end): the ones to quarantine."""
    e = read_table(spark, sf, "events", "event_id", "props")
    k = F.col("event_id") % 7
    cut = F.when(k == 1, F.expr("left(props, length(props) - 1)")) \
        .when(k == 2, F.concat(F.lit("["), "props")).when(k == 3, F.concat(F.lit("["), "props", F.lit("]"))) \
        .otherwise(F.col("props"))
    return malformed_roots(e.withColumn("props", cut), "props").select("event_id")


@query("normalise_root", """
    SELECT event_id, json_extract_string(props, '$.k') AS k FROM events""")
def q_normalise_root(spark, sf):
    """Per user, day and input split, events packed as an object root (even users) or an
    array root (odd users), normalised to records and exploded. Packing per input split
    bounds every document by one split's rows, however active a user is."""
    e = read_table(spark, sf, "events", "event_id", "ts", "user_id", "props")
    rec = F.to_json(F.struct("event_id", F.get_json_object("props", "$.k").alias("k")))
    g = e.groupBy("user_id", F.to_date("ts").alias("d"), F.spark_partition_id()).agg(
        F.collect_list(F.struct(F.col("event_id").cast("string").alias("id"), rec.alias("r")))
         .alias("recs"))
    as_obj = F.to_json(F.map_from_entries(F.transform("recs", lambda x: F.struct(
        x["id"], F.parse_json(x["r"])))))
    as_arr = F.concat(F.lit("["), F.array_join(F.transform("recs", lambda x: x["r"]), ","),
                      F.lit("]"))
    roots = g.select(F.when(F.col("user_id") % 2 == 0, as_obj).otherwise(as_arr).alias("root"))
    recs = roots.select(F.explode(normalise_root("root")).alias("rec"))
    return recs.select(F.get_json_object("rec", "$.event_id").cast("bigint").alias("event_id"),
                       F.get_json_object("rec", "$.k").alias("k"))
