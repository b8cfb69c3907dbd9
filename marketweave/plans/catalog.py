"""Registry of named queries: ``(spark, sf_dir) -> DataFrame`` plus the DuckDB text of
the same query (the independent oracle). Query modules register with ``@query``.

Report conventions shared by both sides: dates and timestamps leave as ISO text (so the
comparison does not depend on client time zones or driver type mapping), floating
results of sums/averages are rounded to 6 decimals (sum order differs between engines).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketweave.plans.oracle_views import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6


def query(key: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn`` under ``key``; ``sql`` (with the named views as CTEs) is its oracle."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the jobs are written for UTC wall-clock time
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[key] = run
        if sql is not None:
            ORACLE[key] = with_views(sql, *views)
        return run
    return deco


# -- Spark-side report helpers

def rnd(c: str | Column, digits: int = DIGITS) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits)


def dtxt(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd")


def tstxt(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def report(df: DataFrame, round_cols: tuple[str, ...] = (), date_cols: tuple[str, ...] = (),
           ts_cols: tuple[str, ...] = ()) -> DataFrame:
    """Apply the report conventions to the named columns, keeping column order."""
    sel = []
    for c in df.columns:
        if c in round_cols:
            sel.append(rnd(c).alias(c))
        elif c in date_cols:
            sel.append(dtxt(c).alias(c))
        elif c in ts_cols:
            sel.append(tstxt(c).alias(c))
        else:
            sel.append(F.col(c))
    return df.select(*sel)


# -- SQL-side spellings of the same conventions

def R(expr: str, alias: str | None = None) -> str:
    return f"round({expr}, {DIGITS})" + (f" AS {alias}" if alias else "")


def D(expr: str, alias: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d')" + (f" AS {alias}" if alias else "")


def TS(expr: str, alias: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')" + (f" AS {alias}" if alias else "")


def NN(expr: str) -> str:
    """NaN → NULL (DuckDB returns NaN where Spark returns null, e.g. 0/0 slopes)."""
    return f"CASE WHEN isnan({expr}) THEN NULL ELSE {expr} END"
