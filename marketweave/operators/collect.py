"""The end-to-end run: process every kind, give each record its content hash, drop what earlier
runs stored, and write by the kind's rule (keyed upsert for bars and macro series, insert-
ignore for the rest), with the write counts. The processed records of a kind are stored once, the
new table and the counts are read from them; a failing kind is reported and the others go on."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketweave.operators import tables as TB
from marketweave.operators.process import process_kind
from marketweave.session import cut_lineage
from marketweave.session import stored as stored_once

# How each kind is stored: upsert on these keys, or insert-ignore on the content hash.
UPSERT_KEYS = {"stock": ("symbol", "date"), "macro": ("indicator", "country", "date")}
HASH = "content_hash"


@dataclass(frozen=True)
class Written:
    """The new contents of a kind's table and how many records did what."""

    table: DataFrame
    counts: DataFrame


def store(kind: str, records: DataFrame, stored: DataFrame | None, as_of: str,
          id_col: str, arrival: Sequence[str] = ()) -> Written:
    """Route processed records into the stored table of their kind (None: not there yet).

    Upserted records of one key are applied in the order of ``arrival``, columns that say where
    a record stood in its source or when it was loaded (they are not stored); the last one
    wins, with its nulls, as a processed record has every field of its kind. Such a kind
    needs them: rows have no order of their own."""
    if kind in UPSERT_KEYS:
        if not arrival:
            raise ValueError(f"{kind} records are upserted in order: name their arrival columns")
        keys = UPSERT_KEYS[kind]
        old = records.limit(0).drop(*arrival) if stored is None else stored
        merged = TB.upsert_merge(old, records, keys, arrival, as_of, whole_rows=True)
        n = TB.write_counts(merged)
        return Written(merged.drop("action"), n.select(
            F.lit(kind).alias("kind"), "action", "n"))
    hashed = TB.with_content_hash(records)
    old = hashed.limit(0) if stored is None else stored
    fresh = TB.cross_run_dedup(TB.dedup_hash_batch(hashed, [id_col]), old, HASH)
    # the counts need no column but the hash
    slim = hashed.select(HASH, *([id_col] if id_col != HASH else []))
    n = (hashed.select(F.lit(1).alias("a"), F.lit(0).alias("f"))
         .unionAll(TB.cross_run_dedup(TB.dedup_hash_batch(slim, [id_col]), old, HASH).select(F.lit(0), F.lit(1)))
         .agg(F.coalesce(F.sum("f"), F.lit(0)).alias("fresh"),
              F.coalesce(F.sum("a") - F.sum("f"), F.lit(0)).alias("dup")))
    row = lambda action, c: F.struct(F.lit(kind).alias("kind"), F.lit(action).alias("action"),
                                     F.col(c).alias("n"))
    counts = n.select(F.inline(F.array(row("insert", "fresh"), row("duplicate", "dup"))))
    return Written(old.unionByName(fresh, allowMissingColumns=True), counts)


def _kept(records: DataFrame, kind: str) -> DataFrame:
    """``records`` made once: a compressed table, or a checkpoint where a column has no type."""
    if "void" in records.schema.simpleString():
        return cut_lineage(records)
    return stored_once(records, f"records-{kind}")


def collect_run(frames: dict[str, DataFrame], stored: dict[str, DataFrame], as_of: str,
                lexicon: DataFrame | None = None, id_cols: dict[str, str] | None = None,
                sentiment_model: str = "valence", arrival: dict[str, Sequence[str]] | None = None) -> tuple[dict[str, Written], dict[str, str]]:
    """One collection run over ``frames`` (kind → raw records) against the ``stored`` tables:
    what to write per kind, and the message of every kind that failed. ``arrival`` names the
    columns that order the records of an upserted kind."""
    out, failed = {}, {}
    for kind, df in frames.items():
        id_col = (id_cols or {}).get(kind, "doc_id")
        try:
            records = _kept(process_kind(df, kind, as_of, lexicon, id_col, sentiment_model), kind)
            out[kind] = store(kind, records, stored.get(kind), as_of, id_col, (arrival or {}).get(kind, ()))
        except Exception as e:  # noqa: BLE001 - isolate one kind's failure
            failed[kind] = f"{type(e).__name__}: {str(e)[:500]}"
    return out, failed
