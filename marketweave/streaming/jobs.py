"""Structured Streaming versions of the collection loop: incremental ingest, stateful
content-hash dedup, upsert / insert-ignore per micro-batch, retention, rolling sentiment
windows and per-kind fault isolation.

Production runs use ``trigger(processingTime='15 minutes')`` (the reference's poll
cadence); tests and the registered queries use ``availableNow`` to drain what is there
and stop. The checkpoint folder is an argument (on shared storage), so a restarted query
resumes where it stopped and micro-batches are replayed idempotently.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from marketweave.operators import tables as TB
from marketweave.operators.dedup import keep_first
from marketweave.sources import folders

POLL_INTERVAL = "15 minutes"  # fixed value: the collection cadence
DEDUP_HORIZON = "24 hours"    # state kept for cross-run dedup (reference: 24 h retention)


def read_table_stream(spark: SparkSession, folder: str, name: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream over the parquet files ``<name>.parquet`` (and new files
    matching it) in ``folder``; the schema is taken from the files once."""
    schema = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); the session runs in UTC."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def start(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
          output_mode: str = "append", available_now: bool = True,
          processing_time: str = POLL_INTERVAL, name: str | None = None):
    """Start ``df`` with a ``foreachBatch`` sink. ``available_now`` drains and stops."""
    w = (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
         .foreachBatch(sink))
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=processing_time)
    return w.start()


def finish(query) -> None:
    """Wait for a draining query and raise what stopped it, if anything did."""
    query.awaitTermination()
    ex = query.exception()
    if ex is not None:
        raise RuntimeError(str(ex))


def run_to_table(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                 transform: Callable[[DataFrame, int], DataFrame] | None = None) -> None:
    """Drain ``df`` into a parquet table at ``path``. Each micro-batch is written to its
    own ``batch=<id>`` folder with overwrite, so a replayed batch replaces itself
    (idempotent by batch id). A later call with the same ``checkpoint`` goes on where this
    one stopped."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch, batch_id) if transform else batch
        out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    finish(start(df, sink, checkpoint, output_mode))


def stream_ingest(events: DataFrame) -> DataFrame:
    """T01: storage normalisation of each new record (batch operator applied to the
    stream)."""
    return TB.to_document(events)


def stream_dedup(df: DataFrame, keys: Sequence[str], ts: str = "ts",
                 horizon: str = DEDUP_HORIZON) -> DataFrame:
    """T02 with bounded state: drop a record whose keys were seen within ``horizon`` of event
    time. The watermark also drops records that arrive later than ``horizon``; where none may
    be lost, use ``dedup_sink``. ``late_rows`` counts what a finished query dropped."""
    return event_time(df, ts).withWatermark(ts, horizon).dropDuplicatesWithinWatermark(
        list(keys))


def late_rows(query) -> int:
    """Rows that a query's watermark has dropped so far, from its progress reports."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress
               for op in p["stateOperators"])


SLOTS = 32


def dedup_sink(table_path: str, keys: Sequence[str], order_by: Sequence[str],
               slots: int = SLOTS) -> Callable[[DataFrame, int], None]:
    """T02 without a time bound: a ``foreachBatch`` sink that stores the first record of every
    key (nulls equal each other), whatever the order and delay of arrival.

    A stored row carries a 64-bit hash of its key and lies in a partition of that hash
    (``batch=<id>/slot=<s>``). A micro-batch is reduced to one row per key and anti-joined with
    the earlier batches' keys in its own slots: the join is on the hash, the whole key is
    compared on a hit. A replay reads only earlier batches and rewrites its own."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = keep_first(batch, keys, order_by).withColumn("_key_hash", F.xxhash64(*keys))
        fresh = fresh.withColumn("slot", F.pmod("_key_hash", F.lit(slots)).cast("int"))
        fresh.persist()  # read for its slots and for the join; recomputed if lost
        try:
            new = fresh
            if folders.exists(spark, table_path):
                own = [r["slot"] for r in fresh.select("slot").distinct().collect()]
                new = _unseen(fresh, stored_keys(spark, table_path, fresh.schema, own, batch_id), keys)
            (new.repartition(slots, "slot").sortWithinPartitions("slot", "_key_hash")
             .write.mode("overwrite").partitionBy("slot").parquet(f"{table_path}/batch={batch_id}"))
        finally:
            fresh.unpersist()
    return sink


def stored_keys(spark: SparkSession, table_path: str, schema: StructType, own: Sequence[int],
                batch_id: int) -> DataFrame:
    """The rows that batches before ``batch_id`` stored in the slots ``own``: both conditions
    are on partition columns, so no other folder is read."""
    t = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(table_path)
    return t.where((F.col("batch") < batch_id) & F.col("slot").isin(list(own)))


def _unseen(fresh: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    seen = stored.select(F.col("_key_hash").alias("_s_hash"), *[F.col(k).alias(f"_s_{k}") for k in keys])
    same = F.col("_key_hash") == F.col("_s_hash")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
    return fresh.join(seen, same, "left_anti")


def upsert_log_sink(table_path: str, batch_col: str = "batch"
                    ) -> Callable[[DataFrame, int], None]:
    """T03 at scale (merge-on-read): each micro-batch is appended as its own
    ``batch=<id>`` folder (overwrite: a replay rewrites only itself) — no rewrite of the
    stored table per batch. ``resolve_upserts`` gives the current table at read time;
    a periodic compaction writes that result as a new base."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/{batch_col}={batch_id}")
    return sink


def resolve_upserts(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current state of an upsert log: per key, each field takes its latest non-null
    value (``$set`` of present fields) by ``order`` (e.g. batch id, then arrival).
    One aggregate with map-side partial aggregation: a hot key costs one partial row
    per task."""
    ordc = F.struct(*[F.col(c) for c in order])
    fields = [c for c in log.columns if c not in keys and c not in order]
    return log.groupBy(*keys).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordc)).alias(c) for c in fields])


def compact_log(spark: SparkSession, table_path: str, out_path: str, keys: Sequence[str],
                as_of: str | None = None, ttl_col: str = "created_at") -> DataFrame:
    """Write the current state of an upsert log as a new base under ``out_path`` (as its
    ``batch=-1``) and return it; with ``as_of``, rows past the retention are left out, so a
    stored row that has aged goes at the next compaction. The caller publishes the new path."""
    state = resolve_upserts(spark.read.parquet(table_path), keys, ["batch"])
    if as_of is not None:
        state = TB.ttl_sweep(state, as_of, ttl_col)
    state.write.mode("overwrite").parquet(f"{out_path}/batch=-1")
    return spark.read.parquet(out_path).drop("batch")


def run_kinds(starters: dict[str, Callable[[], object]]) -> list[tuple[str, str]]:
    """Start one query per kind, side by side, and wait for all: ``(kind, status)`` each. A
    kind that fails, at its start or later, leaves the others running."""
    running, status = {}, {}
    for kind, go in starters.items():
        try:
            running[kind] = go()
        except Exception as e:  # noqa: BLE001 - isolate one kind's failure
            status[kind] = f"failed: {type(e).__name__}: {str(e)[:5000]}"
    for kind, q in running.items():
        try:
            finish(q)
            status[kind] = "ok"
        except Exception as e:  # noqa: BLE001
            status[kind] = f"failed: {type(e).__name__}: {str(e)[:5000]}"
    return [(k, status[k]) for k in starters]


def expiry_sink(table_path: str, col: str = "created_at", ttl_seconds: int = TB.TTL_SECONDS
                ) -> Callable[[DataFrame, int], None]:
    """T04, storing: rows go to partitions of the day on which they expire
    (``expires_day=<day>/batch=<id>``; without ``col``: the null day, which never does). A replay
    replaces its own folders only."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        day = F.to_date(F.col(col).cast("timestamp") + F.make_dt_interval(secs=F.lit(ttl_seconds)))
        (batch.withColumns({"expires_day": day, "batch": F.lit(batch_id).cast("long")})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("expires_day", "batch").parquet(table_path))
    return sink


def live_rows(spark: SparkSession, table_path: str, as_of: str, col: str = "created_at",
              ttl_seconds: int = TB.TTL_SECONDS) -> DataFrame:
    """The rows of an ``expiry_sink`` table that have not expired: days before ``as_of`` are not
    read, and only its own day has rows on either side of the border."""
    t = spark.read.parquet(table_path)
    t = t.where(F.col("expires_day").isNull() | (F.col("expires_day") >= F.lit(as_of[:10]).cast("date")))
    return TB.ttl_sweep(t, as_of, col, ttl_seconds).drop("expires_day", "batch")


def sweep_table(spark: SparkSession, table_path: str, as_of: str) -> list[str]:
    """T04, letting go: the folders of all days before ``as_of`` are deleted unread, all other
    files stay as they are; returns the days that went. The rows of the border day go with
    the next day's sweep, ``live_rows`` leaves them out at once."""
    gone = [d for d in folders.partitions(spark, table_path, "expires_day")
            if d[:4].isdigit() and d < as_of[:10]]
    for d in gone:
        folders.remove(spark, f"{table_path}/expires_day={d}")
    return gone


def stream_window_sentiment(df: DataFrame, value: str, by: Sequence[str], ts: str = "ts",
                            window: str = "1 day", slide: str | None = None,
                            watermark: str = "1 hour") -> DataFrame:
    """T05: mean score and volume per (window, group); late rows beyond the watermark
    are dropped and their state released. Run in ``update`` mode into an upsert sink."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    return (event_time(df, ts).withWatermark(ts, watermark)
            .groupBy(w.alias("w"), *by)
            .agg(F.avg(value).alias("sentiment_score"), F.count(F.lit(1)).alias("volume"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *by, "sentiment_score", "volume"))


def fault_isolated_sink(good_path: str, bad_path: str, is_valid: str
                        ) -> Callable[[DataFrame, int], None]:
    """T06: valid rows to the table, the rest to a quarantine table — a bad record never
    fails the batch. Run one query per kind so one kind's failure leaves the others."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read once, written twice; recomputed if lost
        try:
            batch.where(F.col(is_valid)).drop(is_valid).write.mode("overwrite").parquet(
                f"{good_path}/batch={batch_id}")
            batch.where(~F.col(is_valid)).drop(is_valid).write.mode("overwrite").parquet(
                f"{bad_path}/batch={batch_id}")
        finally:
            batch.unpersist()
    return sink
