"""Macro indicator series: unnest API envelopes, coerce values and dates, country
names, ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketweave.functions.dates import parse_generic

# Country codes with their names (unknown codes map to null).
COUNTRY_NAMES = {"US": "United States", "GB": "United Kingdom", "CN": "China", "IN": "India"}

ENTRY_SCHEMA = "array<struct<date:string, value:string>>"


def unnest_indicator_payload(df: DataFrame, col: str = "payload",
                             tags: Sequence[str] = ("indicator", "country")) -> DataFrame:
    """Envelope ``[meta, [entry, ...]]`` JSON text → one row per entry with the tag
    columns kept; envelopes without element 1 give no rows."""
    entries = F.from_json(F.get_json_object(F.col(col), "$[1]"), ENTRY_SCHEMA)
    e = df.select(*tags, F.explode(entries).alias("e"))
    return e.select(*tags, F.col("e.date").alias("date"), F.col("e.value").alias("value"))


def numeric_coerce(df: DataFrame, col: str = "value") -> DataFrame:
    """Text → double; unparseable → null."""
    return df.withColumn(col, F.col(col).cast("string").try_cast("double"))


def parse_dates_generic(df: DataFrame, col: str = "date", out: str | None = None
                        ) -> DataFrame:
    return df.withColumn(out or col, parse_generic(col))


def country_code_name(df: DataFrame, country: str = "country",
                      names: dict[str, str] = COUNTRY_NAMES) -> DataFrame:
    """``country_code`` := ``country`` when absent; ``country_name`` from a small fixed
    map held in the expression (no join)."""
    out = df if "country_code" in df.columns else df.withColumn("country_code", F.col(country))
    m = F.create_map(*[x for kv in names.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return out.withColumn("country_name", F.try_element_at(m, F.col("country_code")))


def key_lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str,
               values: Sequence[str]) -> DataFrame:
    """Left lookup of ``values`` from a dimension; the planner broadcasts a dimension it
    measures to be small and shuffles otherwise."""
    d = dim.select(F.col(dim_key).alias("_lk"), *values)
    return df.join(d, F.col(key).eqNullSafe(F.col("_lk")) & F.col(key).isNotNull(),
                   "left").drop("_lk")


def clean_macro(df: DataFrame) -> DataFrame:
    """Coerce value, parse date, year, country code/name."""
    out = numeric_coerce(df)
    out = parse_dates_generic(out)
    out = out.withColumn("year", F.year("date"))
    return country_code_name(out)


_MACRO_ORDER = (("date", False), ("country", True), ("indicator", True))


def _macro_order():
    return [F.asc_nulls_last(c) if up else F.desc_nulls_last(c) for c, up in _MACRO_ORDER]


def sort_macro(df: DataFrame) -> DataFrame:
    """Newest first, then country and indicator ascending; nulls last (a global sort: range
    partitioned, so it scales)."""
    return df.orderBy(*_macro_order())


def number_macro(df: DataFrame) -> DataFrame:
    """``row_number`` of every row in the order of ``sort_macro``. Per date the rows are
    numbered among themselves; what precedes a date is a running count over the dates, one
    row each, so no task orders the whole table."""
    per = df.groupBy("date").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(F.desc_nulls_last("date")).rowsBetween(Window.unboundedPreceding, -1)
    base = per.select(F.col("date").alias("_d"),
                      F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("date").orderBy(*_macro_order()[1:])
    return (df.join(base, F.col("date").eqNullSafe(F.col("_d")))
            .withColumn("row_number", (F.col("_base") + F.row_number().over(inside)).cast("long"))
            .drop("_d", "_base"))
