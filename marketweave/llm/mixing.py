"""Mixing sources to target weights with weighted reservoir keys (Efraimidis-Spirakis).

Every document gets the key ``u ** (1 / quality)`` with a reproducible ``u`` in (0, 1);
taking documents by falling key is a weighted sample without replacement. Per source, a
word budget is met by whole epochs first and then by the prefix of that order.

Plan: one pass over the texts leaves slim rows (id, source, size, key, bucket). A bucket is
a fixed slice of the key range, so the order inside a source is (bucket, key): bucket sums
give each bucket's base, and the running sum inside a bucket finishes the prefix sum. No
source, however large, is sorted in one task. Built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketweave.llm.common import unit_hash, word_count
from marketweave.session import cut_lineage, stored

# Slices of the key range per source: a source with r rows is sorted in groups of r / BUCKETS.
BUCKETS = 1024


def symbol_quality(text: Column) -> Column:
    """Quality weight in (0, 1]: falls with the share of markup-like symbols per word."""
    n = word_count(text)
    s = F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("double")
    return F.greatest(F.lit(0.05), F.lit(1.0) - s / F.greatest(n, F.lit(1)).cast("double"))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float,
                   max_epochs: int) -> DataFrame:
    """Word target per source from ``(source, source_size)``.

    Sources by code point (null last) carry ``weights`` in turn and share ``share`` of all
    words; none gets more than ``max_epochs`` times its size, the excess goes to the others
    by weight. That fixed point is a water level: sources sorted by cap / weight are capped
    until the level the rest would reach lies below the next cap. One row per source, so the
    two windows over the whole table are as small as the list of sources."""
    wcol = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_cap = W.orderBy("ratio", F.col("source").asc_nulls_last())
    every = W.partitionBy()
    t = (sizes.withColumn("rank", F.row_number().over(by_name))
         .withColumn("weight", wcol)
         .withColumn("cap", F.col("source_size").cast("double") * max_epochs)
         .withColumn("ratio", F.col("cap") / F.col("weight"))
         .withColumn("total", F.sum("source_size").over(every).cast("double") * share)
         .withColumn("caps_before", F.coalesce(F.sum("cap").over(
             by_cap.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("weights_left", F.sum("weight").over(
             by_cap.rowsBetween(W.currentRow, W.unboundedFollowing)))
         .withColumn("level", (F.col("total") - F.col("caps_before")) / F.col("weights_left"))
         .withColumn("water", F.min_by(
             "level", F.when(F.col("level") <= F.col("ratio"), F.col("ratio"))).over(every)))
    target = F.least(F.col("cap"), F.coalesce(F.col("water") * F.col("weight"), F.col("cap")))
    return t.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, *, weights: Sequence[float] = (1, 2, 3), share: float = 1.0,
                max_epochs: int = 3, quality: Column | None = None, seed: str = "mix",
                buckets: int = BUCKETS, carry: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` for every row of ``docs``, and the
    columns ``carry`` as they are.

    ``taken`` counts words with repeats: ``epochs * size`` for the complete epochs that fit
    the source's target, plus ``size`` for rows of the fractional epoch. The fractional
    prefix stops where the sum is nearest to the target (half of one document at most).

    Null text has size 0 and is never taken; a null source is a source of its own, last;
    rows that repeat an id are separate rows with one key, ordered by size; a row without an
    id has a key by its text; an empty table gives no rows; other columns are ignored. Same input, same result.
    """
    text = F.col("text")
    q = symbol_quality(text) if quality is None else quality
    ident = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.md5(F.coalesce(text, F.lit("")))))
    key = F.pow(unit_hash(F.lit(seed), ident), F.lit(1.0) / q)
    slim = cut_lineage(
        docs.select("doc_id", "source", word_count(text).alias("size"), key.alias("mix_key"), *carry)
        .withColumn("bucket", F.least(F.lit(buckets - 1), F.floor(
            (F.lit(1.0) - F.col("mix_key")) * buckets)).cast("int")))
    cells = slim.groupBy("source", "bucket").agg(F.sum("size").alias("cell"))
    targets = source_targets(cells.groupBy("source").agg(F.sum("cell").alias("source_size")),
                             weights, share, max_epochs)
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    based = cells.select("source", "bucket", F.coalesce(
        F.sum("cell").over(before), F.lit(0)).alias("base"))
    same_source = F.col("s.source").eqNullSafe(F.col("t.source"))
    plan = (based.alias("s").join(targets.alias("t"), same_source)
            .select(F.col("s.source").alias("p_source"), F.col("bucket").alias("p_bucket"),
                    "base", "source_size", "target"))
    rows = slim.join(plan, F.col("source").eqNullSafe(F.col("p_source"))
                     & (F.col("bucket") == F.col("p_bucket")))
    inside = (W.partitionBy("source", "bucket")
              .orderBy(F.desc("mix_key"), "size", "doc_id")
              .rowsBetween(W.unboundedPreceding, -1))
    epochs = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)).cast("double"))
    rest = F.col("target") - epochs * F.col("source_size")
    chosen = (F.col("prefix") + F.col("size") / 2) <= rest
    return (rows.withColumn("prefix", F.col("base") + F.coalesce(F.sum("size").over(inside),
                                                                 F.lit(0)))
            .select("doc_id", "source", "size", "source_size", "target",
                    ((epochs + F.when(chosen & (rest > 0), 1).otherwise(0))
                     * F.col("size")).cast("long").alias("taken"), *carry))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: the rows of ``docs`` repeated as often as the mix takes them, each by
    itself, also where rows share an id or have none. Columns are unchanged, whatever their
    names; nulls as in ``mix_sources``; an empty table stays empty."""
    # stored with a number per row, so that the choice comes back to the row it was made for
    rows = stored(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")),
                  "mix-rows")
    taken = mix_sources(rows.select("number", "row.doc_id", "row.text", "row.source"), carry=["number"], **options)
    times = taken.filter("taken > 0").select("number", (F.col("taken") / F.col("size")).cast("int").alias("times"))
    return (rows.join(times, "number").select("row", F.explode(F.sequence(F.lit(1), "times")).alias("copy"))
            .select("row.*"))
