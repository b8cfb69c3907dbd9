"""Streaming jobs across several micro-batches and restarts: per-batch upserts chain
correctly, the merge-on-read log resolves to the same table, and a restarted query
resumes from its checkpoint without reprocessing."""

import pytest
from pyspark.sql import functions as F

from marketweave.operators import tables as TB
from marketweave.session import scratch_path
from marketweave.sources import folders
from marketweave.streaming import jobs as J
from marketweave.streaming.keyed import KeyedTable, insert_ignore_sink, upsert_sink
from tests.conftest import SMALL

COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@pytest.fixture(scope="module")
def landing(spark):
    """Three landing files (three arrivals of changed customers) in a fresh folder."""
    folder = scratch_path(spark, "landing")
    c = spark.read.parquet(f"{SMALL}/customer.parquet").select(*COLS)
    for i in range(3):
        part = c.where(F.col("c_custkey") % 3 == i).withColumn(
            "c_acctbal", F.col("c_acctbal") + 100 * (i + 1))
        part.coalesce(1).write.mode("append").parquet(folder)  # one new file per arrival
    return folder


def _rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def _stream(spark, folder):
    schema = spark.read.parquet(f"{SMALL}/customer.parquet").select(*COLS).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .parquet(folder))


@pytest.fixture()
def stored_customers(spark):
    """The first 50 customers as an initial table."""
    initial = scratch_path(spark, "init")
    spark.read.parquet(f"{SMALL}/customer.parquet").select(*COLS).where("c_custkey < 50").write.parquet(initial)
    return initial


AT = "2024-01-01 00:00:00"


def test_bucketed_upserts_chain_over_batches(spark, landing, stored_customers):
    table = scratch_path(spark, "keyed")
    J.finish(J.start(_stream(spark, landing),
                     upsert_sink(table, ["c_custkey"], ["c_custkey"], AT, stored_customers, 8),
                     scratch_path(spark, "ckpt")))
    t = KeyedTable(spark, table, ("c_custkey",), 8)
    assert t.versions() == [-1, 0, 1, 2]
    batch = spark.read.parquet(landing).select(*COLS)
    want = TB.upsert_merge(spark.read.parquet(stored_customers), batch, ["c_custkey"], ["c_custkey"], AT)
    assert _rows(t.read()) == _rows(want)
    # what newer versions replaced can go, the contents stay
    before = _rows(t.read())
    assert t.vacuum(keep=1) and _rows(t.read()) == before
    assert t.vacuum(keep=1) == []


def test_a_batch_writes_the_buckets_it_touches(spark, stored_customers):
    """One key of 50 goes to one of 16 buckets: the second version is a fraction of the first, a
    replay writes the same, and a version without its success file is not seen."""
    table = scratch_path(spark, "keyed")
    sink = upsert_sink(table, ["c_custkey"], ["c_acctbal"], AT, stored_customers, 16)
    one = spark.createDataFrame([(7, "new name", 1, 5.0, None)],
                                "c_custkey int, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    c = spark.read.parquet(stored_customers)
    one = one.select(*[F.col(k).cast(c.schema[k].dataType) if k != "c_custkey" else F.col(k) for k in COLS])
    sink(one, 0)
    t = KeyedTable(spark, table, ("c_custkey",), 16)
    size = {v: sum(n for f, n in folders.files(spark, f"{table}/version={v}") if "bucket=" in f) for v in (-1, 0)}
    assert len(folders.partitions(spark, f"{table}/version=0", "bucket")) == 1
    assert size[0] < size[-1] / 4
    assert all("bucket=3" in f for f in t.read([3]).inputFiles()) and t.read([3]).inputFiles()
    got = _rows(t.read())
    assert [r[1] for r in got if r[0] == 7] == ["new name"] and len(got) == 50
    sink(one, 0)
    assert _rows(t.read()) == got
    sink(one.limit(0), 1)
    assert t.versions() == [-1, 0]
    one.write.parquet(f"{table}/version=5/bucket=3")
    assert t.versions() == [-1, 0] and _rows(t.read()) == got


def test_bucketed_insert_ignore(spark, stored_customers):
    table = scratch_path(spark, "keyed")
    sink = insert_ignore_sink(table, ["c_custkey"], ["c_name"], stored_customers, 4)
    c = spark.read.parquet(f"{SMALL}/customer.parquet").select(*COLS)
    batch = c.where("c_custkey between 40 and 60").withColumn("c_name", F.lit("late"))
    sink(batch.unionByName(batch.withColumn("c_name", F.lit("later"))), 0)
    sink(batch, 1)
    got = {r.c_custkey: r.c_name for r in KeyedTable(spark, table, ("c_custkey",), 4).read().collect()}
    assert len(got) == 61 and got[60] == "late" and got[40] != "late"


def test_dedup_reads_its_own_slots(spark):
    table = scratch_path(spark, "dedup")
    sink = J.dedup_sink(table, ["id"], ["id"], slots=16)
    sink(spark.range(100).toDF("id"), 0)
    few = spark.range(100, 102).toDF("id")
    hashed = few.withColumn("_key_hash", F.xxhash64("id")).withColumn("slot", F.lit(1))
    plan = J.stored_keys(spark, table, hashed.schema, [3, 5], 1)._jdf.queryExecution().toString()
    found = [ln for ln in plan.splitlines() if "PartitionFilters" in ln][-1]
    assert "slot" in found.split("PartitionFilters")[1] and "batch" in found.split("PartitionFilters")[1]
    # rows of two keys meet the stored ones; a replay changes nothing
    again = spark.range(98, 102).toDF("id")
    for _ in range(2):
        sink(again, 1)
        t = spark.read.parquet(table)
        assert sorted(r.id for r in t.where("batch = 1").collect()) == [100, 101]
    # an error in the batch is an error, not "no table yet"
    with pytest.raises(Exception, match="UNRESOLVED|cannot be resolved"):
        sink(again.withColumnRenamed("id", "x"), 2)


def test_retention_deletes_whole_days_and_touches_no_other(spark):
    table = scratch_path(spark, "ttl")
    rows = [(1, "2024-01-01 10:00:00"), (2, "2024-01-08 23:59:59"), (3, "2024-01-09 08:00:00"),
            (4, "2024-01-09 13:00:00"), (5, "2024-01-10 11:00:00"), (6, None)]
    df = spark.createDataFrame(rows, "id int, at string").select("id", F.col("at").cast("timestamp").alias("created_at"))
    sink = J.expiry_sink(table)
    sink(df.where("id < 4"), 0)
    sink(df.where("id >= 4"), 1)
    sink(df.where("id >= 4"), 1)  # a replay
    as_of = "2024-01-10 12:00:00"
    live = lambda: sorted(r.id for r in J.live_rows(spark, table, as_of).collect())
    assert live() == [4, 5, 6]
    kept = [f for f in folders.files(spark, table) if "2024-01-02" not in f[0] and "2024-01-09" not in f[0]]
    assert J.sweep_table(spark, table, as_of) == ["2024-01-02", "2024-01-09"]
    assert [f for f in folders.files(spark, table)] == kept
    assert live() == [4, 5, 6] and J.sweep_table(spark, table, as_of) == []


def test_upsert_log_resolves_and_restart_is_idempotent(spark, landing):
    table = scratch_path(spark, "log")
    ckpt = scratch_path(spark, "ckpt")
    for _ in range(2):  # the second start finds nothing new in the checkpoint
        q = J.start(_stream(spark, landing), J.upsert_log_sink(table), ckpt)
        q.awaitTermination()
    log = spark.read.parquet(table)
    assert log.select("batch").distinct().count() == 3
    got = J.resolve_upserts(log, ["c_custkey"], ["batch"])
    want = spark.read.parquet(landing).select(*COLS)
    assert _rows(got) == _rows(want)


def test_dedup_state_spans_micro_batches(spark):
    """Copies of a text landing in different micro-batches are dropped by the state."""
    from marketweave.sources import fixtures as fx

    folder = scratch_path(spark, "docs-landing")
    d = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    for i in range(3):
        d.where(F.col("doc_id") % 3 == i).coalesce(1).write.mode("append").parquet(folder)
    s = (spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(folder))
    s = TB.with_content_hash(s).withColumn(
        "ts", F.timestamp_add("MINUTE", F.col("doc_id"), F.lit(fx.BASE_TS).cast("timestamp")))
    out = scratch_path(spark, "dedup-out")
    J.run_to_table(J.stream_dedup(s, ["content_hash"]).select("content_hash"), out,
                   scratch_path(spark, "ckpt"))
    got = spark.read.parquet(out)
    assert got.select("batch").distinct().count() == 3
    want = TB.with_content_hash(d).select("content_hash").distinct()
    assert sorted(r[0] for r in got.select("content_hash").collect()) == \
        sorted(r[0] for r in want.collect())


def test_dedup_sink_loses_nothing_and_restarts(spark):
    """Late files, copies across batches, a null key, and a stop and restart on one checkpoint."""
    folder, table, ckpt = (scratch_path(spark, n) for n in ("late", "late-table", "ckpt"))
    schema = "k string, n int"
    batches = [[("c", 30), ("a", 31), (None, 32)], [("b", 1), ("a", 2), (None, 3)], [("d", 20), ("c", 21)]]

    def run():
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        J.finish(J.start(s, J.dedup_sink(table, ["k"], ["n"]), ckpt))

    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        if i == 1:
            run()  # stops after two files and goes on from there
    run()
    run()
    got = sorted(((r["k"] or "", r["n"]) for r in spark.read.parquet(table).collect()))
    assert got == [("", 32), ("a", 31), ("b", 1), ("c", 30), ("d", 20)]


def test_late_rows_are_counted(spark):
    folder, out = scratch_path(spark, "late"), scratch_path(spark, "late-out")
    schema = "k string, ts timestamp"
    for day in ("2024-03-10", "2024-03-20", "2024-01-01"):
        spark.sql(f"SELECT '{day}' AS k, timestamp'{day}' AS ts").coalesce(1).write.mode("append") \
            .parquet(folder)
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    q = J.start(J.stream_dedup(s, ["k"]), lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}"),
                scratch_path(spark, "ckpt"))
    J.finish(q)
    assert J.late_rows(q) == 1
    assert spark.read.parquet(out).count() == 2


def test_compaction_drops_what_has_aged(spark):
    log, base = scratch_path(spark, "log"), scratch_path(spark, "base")
    schema = "k int, v string, created_at timestamp"
    spark.sql("SELECT 1 AS k, 'old' AS v, timestamp'2024-01-01' AS created_at UNION ALL "
              "SELECT 2, 'kept', timestamp'2024-01-09 12:00:00'").write.parquet(f"{log}/batch=-1")
    spark.createDataFrame([(2, "new", None)], schema).write.parquet(f"{log}/batch=0")
    t = J.compact_log(spark, log, base, ["k"], "2024-01-10 00:00:00")
    assert [(r["k"], r["v"]) for r in t.collect()] == [(2, "new")]
    assert [r["v"] for r in J.resolve_upserts(spark.read.parquet(base), ["k"], ["batch"]).collect()] == ["new"]


def test_one_kind_failing_leaves_the_others(spark):
    folder = scratch_path(spark, "kinds")
    spark.range(5).write.parquet(folder)
    s = spark.readStream.schema("id long").parquet(folder)
    out = scratch_path(spark, "kinds-out")

    def bad(batch, i):
        raise ValueError("broken kind")

    status = dict(J.run_kinds({
        "bad": lambda: J.start(s, bad, scratch_path(spark, "ckpt")),
        "good": lambda: J.start(s, J.upsert_log_sink(out), scratch_path(spark, "ckpt")),
        "never": lambda: 1 / 0}))
    assert status["good"] == "ok" and "broken kind" in status["bad"]
    assert status["never"].startswith("failed: ZeroDivisionError")
    assert spark.read.parquet(out).count() == 5


def test_a_landed_part_is_one_micro_batch(spark, tmp_path, monkeypatch):
    """However many splits the input has and files a part has: batches follow the parts."""
    from pyspark.sql import functions as F

    from marketweave.plans import stream_queries as Q

    df = spark.range(0, 600, 1, 16).withColumn("part", (F.col("id") % 4).cast("int")).where("part <> 2 OR id = 2")
    for size, newest in ((Q.FILE_BYTES, False), (300, True)):
        monkeypatch.setattr(Q, "FILE_BYTES", size)
        seen = []
        q = J.start(Q._landed(spark, df.where("part <> 2") if newest else df, 2 if newest else 4, newest),
                    lambda b, i: seen.append(sorted({r.id % 4 for r in b.collect()})), str(tmp_path / f"c{newest}"))
        J.finish(q)
        assert seen == ([[1], [0]] if newest else [[0], [1], [2], [3]])
