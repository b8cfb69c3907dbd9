"""Keep-first / keep-newest deduplication that survives hot keys.

A window ``row_number() over (partition by key)`` sorts every copy of a key in one task;
when one key holds a third of the rows that task holds a third of the data. Here the
survivor is chosen by ``min_by``/``max_by`` over a struct of the row — an aggregate with
a map-side partial step, so each task ships one candidate per key and the final merge
sees at most one row per key per upstream task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(cols: Sequence[str | Column]) -> Column:
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols])


def _group_cols(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Grouping columns; string keys get a leading 64-bit hash so the sort-based
    aggregate compares long texts only when their hashes tie (still exact: the text
    itself stays in the key)."""
    types = dict(df.dtypes)
    lead = [F.xxhash64(F.col(k)).alias(f"_h_{k}") for k in keys if types.get(k) == "string"]
    return [*lead, *[F.col(k) for k in keys]]


def _keep(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], pick,
          pass_null_keys: bool, count: str | None) -> DataFrame:
    cols = df.columns
    src, passthru = df, None
    if pass_null_keys:
        all_null = F.lit(True)
        for k in keys:
            all_null = all_null & F.col(k).isNull()
        passthru = df.where(all_null)
        src = df.where(~all_null)
    # the key travels as the group already; only the other columns go into the row struct
    rest = [c for c in cols if c not in keys]
    row = F.struct(*rest) if rest else F.lit(True)
    aggs = [pick(row, _order(order_by)).alias("_r")]
    if count:
        aggs.append(F.count(F.lit(1)).alias(count))
    g = src.groupBy(*_group_cols(src, keys)).agg(*aggs)
    out = g.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in cols],
                   *([count] if count else []))
    if passthru is not None:
        out = out.unionByName(passthru.withColumn(count, F.lit(1)) if count else passthru)
    return out


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
               pass_null_keys: bool = False, count: str | None = None) -> DataFrame:
    """One row per ``keys`` (nulls group together): the one first in ``order_by``, which
    must end in a unique tie-break. ``pass_null_keys=True`` keeps every row whose keys
    are all null instead (e.g. rows without a content hash). ``count`` names a column that
    gets the rows of the key."""
    return _keep(df, keys, order_by, F.min_by, pass_null_keys, count)


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
              pass_null_keys: bool = False, count: str | None = None) -> DataFrame:
    """Like ``keep_first`` but the last row in ``order_by`` survives."""
    return _keep(df, keys, order_by, F.max_by, pass_null_keys, count)
