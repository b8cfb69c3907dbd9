"""Parquet table access for the given data set (one parquet per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketweave.session import ensure_parallelism

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")
# Fact and text tables with a well-distributed id: a scan with too few splits is spread
# over the cores by hashing the id (dimension tables are small and broadcast instead).
SPREAD_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id",
               "benchmark": "item_id", "lineitem": "l_orderkey", "orders": "o_orderkey",
               "events": "event_id", "embeddings": "vec_id", "labels": "doc_id"}


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str,
               spread: bool = True) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet``; listing ``columns`` makes the pruning explicit.

    ``spread`` (default) makes sure a fact or text table's scan feeds at least the
    default parallelism of tasks (``ensure_parallelism``, hash of the table's id): a no-op
    for inputs that already have enough splits, as at scale.
    """
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df = df.select(*columns) if columns else df
    if spread and name in SPREAD_KEYS:
        return ensure_parallelism(df, SPREAD_KEYS[name])
    return df
