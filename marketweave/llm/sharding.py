"""Sharding by vector bin packing: bytes, tokens and rows balanced together.

Rows with equal texts form a group. Groups are hashed into a fixed number of cells (a group of
more than a quarter of a shard, which cannot be relied on to fit beside others, is cut into
cells of its own, unless it has a few rows only), each cell is one vector (bytes, tokens, rows), and the cells are packed by falling size, each into the shard
whose residual capacity has the highest dot product with the cell's vector. What is packed
on the driver is bounded by the number of cells, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketweave.llm.common import word_count
from marketweave.session import cut_lineage

# Cells for ordinary groups; the driver packs at most CELLS + 2 * 3 * HOT_PARTS * shards vectors.
CELLS = 8192
# A group above 1 / HOT_GROUPS of a shard in any dimension and of more than FEW rows is split into
# parts of 1 / HOT_PARTS of a shard.
HOT_GROUPS, HOT_PARTS, FEW = 4, 64, 8


def pack_vectors(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each row of ``vectors`` (items x dimensions): falling size, highest dot
    product with the residual capacity; ties go to the lowest shard."""
    total = vectors.sum(axis=0)
    items = vectors / np.where(total > 0, total, 1.0)
    residual = np.full((shards, items.shape[1]), 1.0 / shards)
    out = np.zeros(len(items), dtype=np.int64)
    for i in np.argsort(-items.max(axis=1), kind="stable"):
        out[i] = s = int(np.argmax(residual @ items[i]))
        residual[s] -= items[i]
    return out


def shard_documents(docs: DataFrame, shards: int = 24, *, cells: int = CELLS,
                    hot_parts: int = HOT_PARTS) -> DataFrame:
    """``(doc_id, size, n_tokens, text_crc32, shard, slot)`` for every row of ``docs``.

    ``size`` is the UTF-8 length plus 8 bytes (null text: 8, as the empty text), ``slot``
    numbers the rows of a shard from 0 without gaps. Rows with equal texts share a shard
    unless they are more than ``FEW`` and more than a quarter of one; then they are dealt by id,
    those without an id by their place in the stored rows. Repeated rows keep a slot each; a
    null id sorts first; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut_lineage(docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        word_count(text).alias("n_tokens"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("grp")))
    measures = [F.sum("size").alias("b"), F.sum("n_tokens").alias("t"),
                F.count(F.lit(1)).alias("r")]
    total = rows.agg(*measures).first()
    part = [max(1.0, (total[c] or 0) / (shards * hot_parts)) for c in ("b", "t", "r")]
    over = F.greatest(*[F.col(c) / F.lit(m) for c, m in zip(("b", "t", "r"), part)])
    # at most 3 * shards * HOT_GROUPS groups can lie above one of the three limits
    hot = (rows.groupBy("grp").agg(*measures).filter((over > hot_parts / HOT_GROUPS) & (F.col("r") > FEW))
           .select("grp", F.least(F.ceil(over), F.col("r")).cast("long").alias("parts"))
           .orderBy("grp").collect())
    base, hot_rows = cells, []
    for g in hot:
        hot_rows.append((g["grp"], base, g["parts"]))
        base += g["parts"]
    hot_df = spark.createDataFrame(hot_rows, "grp long, first long, parts long")
    spot = F.when(F.col("first").isNull(), F.pmod(F.col("grp"), F.lit(cells))).otherwise(
        F.col("first") + F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.concat(
            F.lit("row "), F.col("place").cast("string")))), F.col("parts")))
    # the place of a row in the checkpoint is the same whenever it is read
    celled = (rows.withColumn("place", F.monotonically_increasing_id()).join(F.broadcast(hot_df), "grp", "left")
              .select("doc_id", "size", "n_tokens", "text_crc32", spot.alias("cell")))
    cell_sums = celled.groupBy("cell").agg(*measures).orderBy("cell").collect()
    vec = np.array([[c["b"], c["t"], c["r"]] for c in cell_sums], dtype=float).reshape(-1, 3)
    where = pack_vectors(vec, shards)
    filled = [0] * shards
    placed = []
    for c, s in zip(cell_sums, where.tolist()):
        placed.append((c["cell"], s, filled[s]))
        filled[s] += c["r"]
    placed_df = spark.createDataFrame(placed, "cell long, shard int, slot_base long")
    in_cell = W.partitionBy("cell").orderBy("doc_id", "size", "text_crc32")
    return (celled.join(F.broadcast(placed_df), "cell")
            .select("doc_id", "size", "n_tokens", "text_crc32", "shard",
                    (F.col("slot_base") + F.row_number().over(in_cell) - 1).alias("slot")))
