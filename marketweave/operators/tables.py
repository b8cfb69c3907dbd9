"""Table maintenance as DataFrame jobs: insert-ignore, keyed upsert (merge), retention
sweep, expiry stamps, keep-newest dedup, duplicate and uniqueness reports, content hashes,
write counts and the JSON/CSV sinks.

There is no table format with MERGE here, so a merge produces the new snapshot as a
DataFrame; ``write_snapshot`` writes it to a fresh path (never over the path being read)
and the caller publishes that path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketweave.functions.text import HASH_FIELDS, content_hash
from marketweave.operators.dedup import keep_first, keep_last

TTL_SECONDS = 86_400  # fixed value: retention of stamped documents


def _same_key(keys: Sequence[str], left: str, right: str) -> Column:
    """Keys equal, a null counting as a value of its own (as in a unique index)."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def _key_cond(keys: Sequence[str], left: str, right: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"{left}.{k}") == F.col(f"{right}.{k}"))
    return cond


def _not_null(keys: Sequence[str]) -> Column:
    c = F.lit(True)
    for k in keys:
        c = c & F.col(k).isNotNull()
    return c


# ---------------------------------------------------------------- K04 / J04 / K13

def tag_stored(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
               order_by: Sequence[str]) -> DataFrame:
    """The batch collapsed to one row per key: its first row in ``order_by``, with ``_n`` (rows
    of the key in the batch) and ``_stored`` (whether the key is in ``target``). A null key is
    a value like any other: stored once, later ones are duplicates."""
    first = keep_first(incoming, keys, order_by, count="_n")
    stored = target.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return (first.alias("i").join(stored.alias("t"), _same_key(keys, "i", "t"), "left")
            .select("i.*", F.col("t._hit").isNotNull().alias("_stored")))


def insert_ignore(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  order_by: Sequence[str], handle_duplicates: bool = True) -> DataFrame:
    """Append incoming rows whose key is not stored yet; within the batch the first row per
    key wins (nulls are equal). Returns the new table contents; columns only the batch has
    are added (null for stored rows). With ``handle_duplicates=False`` a clash with the stored
    table raises instead (checked by one ``limit(1)`` probe).

    Plan: the batch collapsed per key, then one anti join with the stored keys."""
    first = keep_first(incoming, keys, order_by).alias("i")
    stored, same = target.select(*keys).alias("t"), _same_key(keys, "i", "t")
    if not handle_duplicates and first.join(stored, same, "left_semi").limit(1).count():
        raise ValueError("duplicate key in insert")
    return target.unionByName(first.join(stored, same, "left_anti"), allowMissingColumns=True)


def insert_counts(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  order_by: Sequence[str]) -> DataFrame:
    """inserted / duplicate counts of ``insert_ignore``, from the same tagged rows."""
    return tag_stored(target, incoming, keys, order_by).agg(
        F.coalesce(F.sum(F.when(~F.col("_stored"), 1).otherwise(0)), F.lit(0))
         .cast("bigint").alias("inserted"),
        F.coalesce(F.sum(F.when(F.col("_stored"), F.col("_n")).otherwise(F.col("_n") - 1)), F.lit(0))
         .cast("bigint").alias("duplicates"))


# ---------------------------------------------------------------- K05 / J05 / K12 / K13

FIELDS = "_fields"  # the names of the fields that a document has


def document_fields(text: Column) -> Column:
    """The field names of a JSON document, null values included: its ``_fields``."""
    return F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))


def upsert_merge(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                 arrival: Sequence[str], as_of: str, with_action: bool = True,
                 whole_rows: bool = False) -> DataFrame:
    """Keyed upsert: rows with a null key are skipped; the batch's rows for one key are
    applied in ``arrival`` order like sequential ``$set`` updates — each field takes its
    last present value; an existing row keeps the fields no incoming row sets; new keys are
    inserted; columns that only the batch has (other than ``arrival``) are added.
    ``updated_at`` is stamped on touched rows, ``created_at`` kept or set to ``as_of``.

    Where ``incoming`` has a ``_fields`` column (``document_fields``), a field is present if it is
    named there, so a field that is set to null differs from one that is absent; a null
    ``_fields`` sets nothing. The merged table then has ``_fields`` too: those a stored document
    had and those set since. Without that column, present means non-null, or with
    ``whole_rows`` every field is present in every row: the last row of a key sets them all.

    Plan: one aggregate collapses the batch per key (``max_by`` per field, partial
    map-side, so a key updated many times costs one row per task), then one full-outer
    join on the key."""
    named = FIELDS in incoming.columns and not whole_rows
    held = {*keys, "created_at", "updated_at", FIELDS}
    fields = [c for c in target.columns if c not in held]
    added = [c for c in incoming.columns if c not in {*held, *fields, *arrival}]
    order = F.struct(*[F.col(a) for a in arrival])
    upd = [c for c in fields if c in incoming.columns] + added

    def last(c: str) -> Column:
        """The last present value of a field, where nulls count in a struct (null: never)."""
        present = F.array_contains(FIELDS, c) if named else F.col(c).isNotNull()
        return F.max_by(F.struct(F.col(c).alias("v")) if named else F.col(c), F.when(present, order)).alias(c)

    sets = [F.array_distinct(F.flatten(F.collect_set(FIELDS))).alias(FIELDS)] if named else []
    sets += [F.max_by(F.struct(*upd), order).alias("_row")] if whole_rows else [last(c) for c in upd]
    batch = incoming.where(_not_null(keys)).groupBy(*keys).agg(F.lit(True).alias("_in"), *sets)
    t = target.alias("t")
    n = batch.alias("n")
    j = t.join(n, _key_cond(keys, "t", "n"), "full_outer")
    ts = F.lit(as_of).cast("timestamp")
    in_new = F.col("n._in").isNotNull()
    in_old = F.coalesce(*[F.col(f"t.{k}").isNotNull() for k in keys])

    def merged(c: str) -> Column:
        if c not in upd:
            return F.col(f"t.{c}")
        old = F.col(f"t.{c}") if c in fields else F.lit(None)
        if whole_rows:
            return F.when(in_new, F.col(f"n._row.{c}")).otherwise(old)
        if named:
            return F.when(F.col(f"n.{c}").isNotNull(), F.col(f"n.{c}.v")).otherwise(old)
        return F.coalesce(F.col(f"n.{c}"), old)

    out = [F.coalesce(F.col(f"t.{k}"), F.col(f"n.{k}")).alias(k) for k in keys]
    out += [merged(c).alias(c) for c in fields + added]
    if named:
        none = F.array().cast("array<string>")
        old = F.coalesce(F.col(f"t.{FIELDS}"), none) if FIELDS in target.columns else none
        out.append(F.array_sort(F.array_union(old, F.coalesce(F.col(f"n.{FIELDS}"), none))).alias(FIELDS))
    elif FIELDS in target.columns:
        out.append(F.col(f"t.{FIELDS}"))
    created = F.col("t.created_at") if "created_at" in target.columns else F.lit(None)
    updated = F.col("t.updated_at") if "updated_at" in target.columns else F.lit(None)
    out.append(F.coalesce(created.cast("timestamp"), ts).alias("created_at"))
    out.append(F.when(in_new, ts).otherwise(updated.cast("timestamp")).alias("updated_at"))
    if with_action:
        out.append(F.when(in_new & ~F.coalesce(in_old, F.lit(False)), F.lit("insert"))
                    .when(in_new, F.lit("update")).otherwise(F.lit("keep")).alias("action"))
    return j.select(*out)


def write_counts(merged: DataFrame) -> DataFrame:
    """Rows per merge action (insert / update / keep)."""
    return merged.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def stamp_columns(df: DataFrame, as_of: str, on_insert: bool = True) -> DataFrame:
    """``created_at`` (always on insert; on upsert only where missing), ``updated_at``
    and ``processed_date`` from an explicit ``as_of``."""
    ts = F.lit(as_of).cast("timestamp")
    created = ts if on_insert or "created_at" not in df.columns else \
        F.coalesce(F.col("created_at"), ts)
    return df.withColumns({"created_at": created, "updated_at": ts,
                           "processed_date": F.lit(as_of[:10])})


# ---------------------------------------------------------------- K06 / K07

def ttl_sweep(df: DataFrame, as_of: str, col: str = "created_at",
              ttl_seconds: int = TTL_SECONDS) -> DataFrame:
    """Drop rows older than the retention; rows without the field never expire."""
    limit = F.lit(as_of).cast("timestamp") - F.make_dt_interval(secs=F.lit(ttl_seconds))
    return df.where(F.col(col).isNull() | (F.col(col).cast("timestamp") > limit))


def mark_expiring(df: DataFrame, ids: DataFrame, key: str, as_of: str,
                  ttl_hours: int = 24) -> DataFrame:
    """Stamp ``created_at = as_of`` and ``expires_at = as_of + ttl_hours`` on the rows whose
    key is in ``ids``; other rows keep both as they are (no ``expires_at``: null). ``ids`` is
    joined (left, deduplicated), so any number of ids scales."""
    marks = ids.select(F.col(key).alias("_mk")).distinct().withColumn("_m", F.lit(True))
    j = df.join(marks, F.col(key) == F.col("_mk"), "left")
    ts = F.lit(as_of).cast("timestamp")

    def stamped(col: str, value: Column) -> Column:
        old = F.col(col).cast("timestamp") if col in df.columns else F.lit(None).cast("timestamp")
        return F.when(F.col("_m").isNotNull(), value).otherwise(old)
    return j.withColumns({"created_at": stamped("created_at", ts),
                          "expires_at": stamped("expires_at", ts + F.make_dt_interval(
                              hours=F.lit(ttl_hours)))}).drop("_mk", "_m")


# ---------------------------------------------------------------- K08-K10, A13

def dedup_keep_newest(df: DataFrame, key: str, created: str, tiebreak: str) -> DataFrame:
    """Per key keep the newest row (``created`` desc, then ``tiebreak`` desc); rows with
    a null key are untouched. Skew-safe aggregate (see ``dedup``)."""
    return keep_last(df, [key], [F.coalesce(F.col(created).cast("timestamp"),
                                            F.lit("0001-01-01").cast("timestamp")),
                                 F.col(tiebreak)], pass_null_keys=True)


def removed_count(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows removed by a dedup step (the ``after`` count is a scalar subquery)."""
    n_after = after.select(F.count(F.lit(1))).scalar()
    return before.agg((F.count(F.lit(1)) - n_after).alias("removed"))


def duplicate_groups(df: DataFrame, key: str, id_col: str) -> DataFrame:
    """Keys held by more than one row (null is a key): count and the id range. The ids
    themselves are ``duplicate_members``, one row each: a list per key could be unbounded."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("first_id"),
                                F.max(id_col).alias("last_id"))
              .where(F.col("n") > 1))


def duplicate_members(df: DataFrame, key: str, id_col: str) -> DataFrame:
    """(key, id) for every row of a duplicated key (null is a key): counts per key joined back
    (AQE splits a hot key's partition in the skew join)."""
    counts = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return df.join(counts, F.col(key).eqNullSafe(F.col("_k")), "left_semi").select(key, id_col)


def uniqueness_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Violations of a unique key: every key value held by more than one row."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def dup_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows before / after a dedup on ``keys`` and the difference."""
    k = F.struct(*keys) if len(keys) > 1 else F.col(keys[0])
    return df.agg(F.count(F.lit(1)).alias("rows_before"),
                  F.count_distinct(k).alias("rows_after")).withColumn(
        "duplicates", F.col("rows_before") - F.col("rows_after"))


# ---------------------------------------------------------------- K11, K03

def valid_docs(df: DataFrame, col: str) -> DataFrame:
    """Flag JSON texts that can be a document: exactly one object and nothing after it, with
    double-quoted strings. The rest are for the quarantine sink."""
    text = F.ltrim(F.col(col))
    # inside brackets, a text that goes on after its object is no array of one object
    strict = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}
    one = F.from_json(F.concat(F.lit("["), F.col(col), F.lit("]")), "array<map<string,string>>", strict)
    is_obj = text.startswith("{") & F.rtrim(text).endswith("}") & (F.size(one) == 1) & \
        F.get(one, 0).isNotNull()
    return df.withColumn("is_valid", F.coalesce(is_obj, F.lit(False)))


def iso_text(ts: str | Column) -> Column:
    """Timestamp → ISO text ``yyyy-MM-ddTHH:mm:ss`` plus ``.ffffff`` when the fraction is
    not zero (Python ``isoformat``)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    frac = F.date_format(c, "SSSSSS")
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(frac != "000000", F.concat(F.lit("."), frac)).otherwise(F.lit("")))


def to_document(df: DataFrame) -> DataFrame:
    """Storage normalisation: timestamps → ISO text, NaN → null, empty arrays → null."""
    out = []
    for name, dtype in df.dtypes:
        c = F.col(name)
        if dtype.startswith("timestamp") or dtype == "date":
            out.append(iso_text(c.cast("timestamp")).alias(name) if dtype != "date"
                       else F.date_format(c, "yyyy-MM-dd").alias(name))
        elif dtype in ("double", "float"):
            out.append(F.when(F.isnan(c), F.lit(None).cast(dtype)).otherwise(c).alias(name))
        elif dtype.startswith("array"):
            out.append(F.when(F.size(c) == 0, F.lit(None).cast(dtype)).otherwise(c).alias(name))
        else:
            out.append(c)
    return df.select(*out)


# ---------------------------------------------------------------- P23 / W07 / J06

def with_content_hash(df: DataFrame, out: str = "content_hash",
                      fields: Sequence[str] = HASH_FIELDS) -> DataFrame:
    return df.withColumn(out, content_hash(df.dtypes, fields))


def dedup_hash_batch(df: DataFrame, order_by: Sequence[str], col: str = "content_hash"
                     ) -> DataFrame:
    """Keep the first row per content hash inside a batch; rows without a hash are kept."""
    return keep_first(df, [col], order_by, pass_null_keys=True)


def cross_run_dedup(batch: DataFrame, history: DataFrame, col: str = "content_hash"
                    ) -> DataFrame:
    """Drop rows whose hash was seen in earlier runs (anti join with the history table;
    rows without a hash pass)."""
    seen = history.select(col).where(F.col(col).isNotNull()).distinct()
    return batch.join(seen, col, "left_anti")


# ---------------------------------------------------------------- K01 / K02

def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """Write a merge result to a fresh path (parquet); publishing is the caller's."""
    df.write.mode("errorifexists").parquet(path)
