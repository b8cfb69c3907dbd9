"""Session construction and the few session-level helpers every job shares.

The library itself never creates a session: operators take DataFrames. These helpers
are for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "marketweave",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with AQE on, UTC, no UI. ``master`` only for local runs."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("MW_DRIVER_MEMORY", "16g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    On a cluster that setting names shared storage and is used as is. Only when it is
    unset (local tests) a private temporary folder is made, once a session.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
        return d
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mw-ckpt-"))
        d = spark.sparkContext.getCheckpointDir()
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (for intermediate tables)."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table under the shared checkpoint folder and read
    again: lineage is cut, later reads take only the columns they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ensure_parallelism(df: DataFrame, key: str | None = None,
                       min_partitions: int | None = None) -> DataFrame:
    """Spread ``df`` over at least ``min_partitions`` (default: the cluster's default
    parallelism) when its scan yields fewer splits — e.g. one large row group in one
    file — so CPU-heavy row work (tokenising, regexes) is not confined to one task. With
    a unique ``key`` the spread is a hash partitioning (no pre-sort needed, no skew);
    otherwise round-robin. On inputs that already have enough splits (the normal case at
    scale) this is a no-op and adds no shuffle. Deciding needs only the planned partition
    count, no job."""
    spark = df.sparkSession
    try:
        target = min_partitions or spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= target:
            return df
    except (PySparkAttributeError, PySparkNotImplementedError):  # a remote session has no RDD view
        return df
    if key is not None and key in df.columns:
        return df.repartition(target, key)
    return df.repartition(target)
