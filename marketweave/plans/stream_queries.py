"""Registered streaming queries: each drains a file-source stream over the given tables
(``availableNow``) into a table under the shared checkpoint folder and returns that
table; the oracle is the batch form of the same computation (stream = batch)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from marketweave.operators import tables as TB
from marketweave.plans.catalog import R, TS, query, report
from marketweave.plans.table_queries import AS_OF, _JUNK_PROPS, _junk_props
from marketweave.session import scratch_path
from marketweave.sources import folders
from marketweave.streaming import jobs as J
from marketweave.streaming.keyed import KeyedTable, upsert_sink


@query("stream_ingest", """
    SELECT event_id,
           strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
             CASE WHEN strftime(ts, '%f') <> '000000' THEN '.' || strftime(ts, '%f') ELSE '' END
             AS ts,
           value, props FROM events""")
def q_stream_ingest(spark, sf):
    out = scratch_path(spark, "ingest")
    s = J.read_table_stream(spark, sf, "events").select("event_id", "ts", "value", "props")
    J.run_to_table(J.stream_ingest(s), out, scratch_path(spark, "stream-ckpt"))
    return spark.read.parquet(out).drop("batch")


FILE_BYTES = 32 << 20


def _landed(spark, df, parts, newest_first=False):
    """``df(.., part)`` landed part by part in a fresh folder, and a stream that reads one part per
    micro-batch. The rows are made once; a part has a file for every ``FILE_BYTES`` of the largest
    one, so the number of micro-batches does not follow the splits of the input."""
    made, folder = scratch_path(spark, "parts"), scratch_path(spark, "landing")
    df.write.partitionBy("part").parquet(made)
    sizes = [sum(n for f, n in folders.files(spark, made) if f"/part={i}/" in f) for i in range(parts)]
    dealt = max(1, -(-max(sizes) // FILE_BYTES))
    rows, landed = spark.read.schema(df.schema).parquet(made), [0]
    for i in sorted(range(parts), reverse=newest_first):
        rows.where(F.col("part") == i).drop("part").repartition(dealt).write.mode("append").parquet(folder)
        landed.append(sum(f.endswith(".parquet") for f, _ in folders.files(spark, folder)))
    # a part of a few rows may have fewer files: no micro-batch takes files of two parts
    each = math.gcd(*(b - a for a, b in zip(landed, landed[1:])))
    return (spark.readStream.schema(df.drop("part").schema).option("maxFilesPerTrigger", each)
            .parquet(folder))


@query("stream_dedup", """
    SELECT a.arrival, h.content_hash
    FROM (SELECT DISTINCT md5('text:' || text) AS content_hash FROM documents) h,
         (VALUES ('newest first'), ('oldest first')) a(arrival)""")
def q_stream_dedup(spark, sf):
    """Collected documents landed as four files, in both orders of arrival, deduplicated by
    content hash across micro-batches: every text is stored once and none is lost."""
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    d = TB.with_content_hash(d).select("doc_id", "content_hash", (
        F.col("doc_id").cast("double") / (d.select(F.max("doc_id")).scalar() + 1) * 4).cast("int")
        .alias("part"))
    out = None
    for label, newest in (("newest first", True), ("oldest first", False)):
        table = scratch_path(spark, "dedup")
        s = _landed(spark, d, 4, newest)
        J.finish(J.start(s, J.dedup_sink(table, ["content_hash"], ["doc_id"]),
                         scratch_path(spark, "stream-ckpt")))
        t = spark.read.parquet(table).select(F.lit(label).alias("arrival"), "content_hash")
        out = t if out is None else out.unionByName(t)
    return out


@query("stream_upsert", f"""
    WITH t AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
               WHERE c_custkey % 3 <> 0),
         b AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment
               FROM customer WHERE c_custkey % 3 <> 1)
    SELECT coalesce(t.c_custkey, b.c_custkey) AS c_custkey,
           coalesce(b.c_name, t.c_name) AS c_name,
           coalesce(b.c_nationkey, t.c_nationkey) AS c_nationkey,
           coalesce(b.c_acctbal, t.c_acctbal) AS c_acctbal,
           coalesce(b.c_mktsegment, t.c_mktsegment) AS c_mktsegment,
           {TS(f"TIMESTAMP '{AS_OF}'", 'created_at')},
           CASE WHEN b.c_custkey IS NOT NULL THEN {TS(f"TIMESTAMP '{AS_OF}'")} END AS updated_at
    FROM t FULL OUTER JOIN b ON t.c_custkey = b.c_custkey""")
def q_stream_upsert(spark, sf):
    """Stored customers (one third of keys new to the stream) upserted by a stream of
    changed customer rows landed as three files: each micro-batch rewrites the key-hash buckets
    that it touches, and no other."""
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    c = spark.read.parquet(f"{sf}/customer.parquet").select(*cols)
    initial, table = scratch_path(spark, "cust"), scratch_path(spark, "cust-keyed")
    stamp = F.lit(AS_OF).cast("timestamp")
    c.where(F.col("c_custkey") % 3 != 0).withColumns(
        {"created_at": stamp, "updated_at": F.lit(None).cast("timestamp")}).write.parquet(initial)
    changed = (c.where(F.col("c_custkey") % 3 != 1)
               .withColumns({"c_acctbal": F.col("c_acctbal") + 100,
                             "part": (F.col("c_custkey") % 7 % 3).cast("int")}))
    J.finish(J.start(_landed(spark, changed, 3),
                     upsert_sink(table, ["c_custkey"], ["c_acctbal"], AS_OF, initial, buckets=8),
                     scratch_path(spark, "stream-ckpt")))
    t = KeyedTable(spark, table, ("c_custkey",), 8).read()
    return report(t.select(*cols, "created_at", "updated_at"), ts_cols=("created_at", "updated_at"))


@query("stream_upsert_log", """
    WITH t AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
               WHERE c_custkey % 3 <> 0),
         b AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment
               FROM customer WHERE c_custkey % 3 <> 1)
    SELECT coalesce(t.c_custkey, b.c_custkey) AS c_custkey,
           coalesce(b.c_name, t.c_name) AS c_name,
           coalesce(b.c_nationkey, t.c_nationkey) AS c_nationkey,
           coalesce(b.c_acctbal, t.c_acctbal) AS c_acctbal,
           coalesce(b.c_mktsegment, t.c_mktsegment) AS c_mktsegment
    FROM t FULL OUTER JOIN b ON t.c_custkey = b.c_custkey""")
def q_stream_upsert_log(spark, sf):
    """The same upsert kept as an append-only log (the stored customers as the base
    version -1, each micro-batch one version) and resolved at read time."""
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    table = scratch_path(spark, "cust-log")
    (spark.read.parquet(f"{sf}/customer.parquet").select(*cols)
     .where(F.col("c_custkey") % 3 != 0)
     .write.parquet(f"{table}/batch=-1"))
    s = (J.read_table_stream(spark, sf, "customer").select(*cols)
         .where(F.col("c_custkey") % 3 != 1)
         .withColumn("c_acctbal", F.col("c_acctbal") + 100))
    q = J.start(s, J.upsert_log_sink(table), scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return J.resolve_upserts(spark.read.parquet(table), ["c_custkey"], ["batch"]).select(*cols)


@query("stream_ttl", f"""
    SELECT event_id, {TS('ts', 'created_at')} FROM events
    WHERE ts IS NULL OR ts > TIMESTAMP '{AS_OF}' - INTERVAL 86400 SECOND""")
def q_stream_ttl(spark, sf):
    """All events are stored as they arrive, by the day on which they expire; the sweep lets
    whole days go unread, and only the border day is filtered."""
    out = scratch_path(spark, "ttl")
    s = J.read_table_stream(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("created_at"))
    J.finish(J.start(s, J.expiry_sink(out), scratch_path(spark, "stream-ckpt")))
    J.sweep_table(spark, out, AS_OF)
    return report(J.live_rows(spark, out, AS_OF), ts_cols=("created_at",))


def _windowed(spark, agg):
    """Window aggregates in update mode, upserted into the key-hash buckets of their windows."""
    keys = ["window_start", "event_type"]
    initial, table = scratch_path(spark, "no-windows"), scratch_path(spark, "windows")
    spark.createDataFrame([], agg.schema).write.parquet(initial)
    J.finish(J.start(agg, upsert_sink(table, keys, ["volume"], AS_OF, initial, buckets=8),
                     scratch_path(spark, "stream-ckpt"), output_mode="update"))
    t = KeyedTable(spark, table, tuple(keys), 8).read()
    return report(t.select("window_start", "event_type", "sentiment_score", "volume"),
                  round_cols=("sentiment_score",), ts_cols=("window_start",))


@query("stream_daily_sentiment", f"""
    SELECT {TS("date_trunc('day', ts)", 'window_start')}, event_type,
           {R('avg(value)', 'sentiment_score')}, count(*) AS volume
    FROM events GROUP BY date_trunc('day', ts), event_type""")
def q_stream_daily_sentiment(spark, sf):
    """Per event type and day: mean value and volume, maintained in update mode and
    upserted per micro-batch (late rows past the 1 h watermark are dropped)."""
    return _windowed(spark, J.stream_window_sentiment(
        J.read_table_stream(spark, sf, "events"), "value", ["event_type"]))


_QUARTER = "date_trunc('hour', ts) + CAST(floor(minute(ts) / 15) * 15 AS INTEGER) * INTERVAL 1 MINUTE"


@query("stream_sliding_sentiment", f"""
    SELECT {TS('ws', 'window_start')}, event_type, {R('avg(value)', 'sentiment_score')},
           count(*) AS volume
    FROM (SELECT event_type, value, {_QUARTER} - k * INTERVAL 15 MINUTE AS ws
          FROM events, (SELECT unnest(range(4)) AS k))
    GROUP BY ws, event_type""")
def q_stream_sliding_sentiment(spark, sf):
    """1-hour windows sliding every 15 minutes, per event type."""
    return _windowed(spark, J.stream_window_sentiment(
        J.read_table_stream(spark, sf, "events"), "value", ["event_type"], window="1 hour", slide="15 minutes"))


@query("fault_isolation", f"""
    SELECT event_id,
           CASE WHEN coalesce(json_valid(p) AND starts_with(ltrim(p), '{{'), false)
                THEN 'table' ELSE 'quarantine' END AS sink
    FROM (SELECT event_id, {_JUNK_PROPS} AS p FROM events)""")
def q_fault_isolation(spark, sf):
    """Records that cannot be documents go to a quarantine table; the batch carries on."""
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "quarantine")
    s = _junk_props(J.read_table_stream(spark, sf, "events").select("event_id", "props"))
    s = TB.valid_docs(s, "props")
    q = J.start(s, J.fault_isolated_sink(good, bad, "is_valid"),
                scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    g = spark.read.parquet(good).select("event_id", F.lit("table").alias("sink"))
    b = spark.read.parquet(bad).select("event_id", F.lit("quarantine").alias("sink"))
    return g.unionByName(b)
