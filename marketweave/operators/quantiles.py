"""Exact quantiles (linear interpolation, as SQL ``quantile_cont``) by radix selection.

``percentile`` is exact but its final merge holds every distinct value of a group in one task.
Here every value becomes a 64-bit integer code in the order of the values, and the order
statistics are found digit by digit: a histogram of the leading digit per (group, column) tells
which digit holds each wanted rank and how many values lie below it; the next histogram
counts the next digit of the values with that prefix only, until the code is complete.

A histogram has at most 2^22 bins per (group, column, prefix), whatever the data: counts are
partially aggregated where the rows are, and no task ever holds a group's values. There is no
sketch and nothing to retry. All steps are one plan over the input, which is stored once with
the needed columns only (or has been, by the caller).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketweave.session import stored

SHIFTS = (42, 21, 0)  # bits below the first, second and last digit
_MANTISSA = 1 << 52


def order_code_sql(rows: str, x: str, keep: str) -> str:
    """SQL: ``keep`` and ``_code`` of the rows of a subquery, a 64-bit integer per double ``x`` in
    the order of the doubles (NaN last, -0.0 equal to 0.0, null stays null): biased exponent and
    mantissa of the size, negated for negative numbers.

    ``log2`` may round across a power of two next to one, so the exponent is corrected by the
    powers themselves, which are exact. Each step names columns of the one before, and the
    generator at the end keeps the optimiser from writing them out over and over."""
    inf, keep = "double('Infinity')", f"{keep}, {x}"
    return f"""
    SELECT {keep}, _code FROM (
      SELECT {keep}, IF({x} < 0, -1, 1) AS _s, CASE
          WHEN isnan(_a) THEN {2047 * _MANTISSA + 1}L WHEN _a = {inf} THEN {2047 * _MANTISSA}L
          WHEN _a < {2.0 ** -1022}D THEN CAST(_a * {2.0 ** 537}D * {2.0 ** 537}D AS BIGINT)
          ELSE CAST(_e + 1023 AS BIGINT) * {_MANTISSA}L
               + CAST((_a / pow(2.0D, _e) - 1) * {float(_MANTISSA)}D AS BIGINT) END AS _m
      FROM (SELECT {keep}, _a, CASE WHEN _u > _a AND _e > -1022 THEN _e - 1
                                    WHEN _u * 2 <= _a AND _e < 1023 THEN _e + 1 ELSE _e END AS _e
            FROM (SELECT *, pow(2.0D, _e) AS _u
                  FROM (SELECT *, greatest(least(floor(log2(IF(_a > 0 AND _a < {inf}, _a, 1.0D))),
                                                 1023), -1022) AS _e
                        FROM (SELECT *, abs({x}) AS _a FROM {rows})))))
    LATERAL VIEW explode(array(_s * _m)) AS _code"""


def code_value(code: Column) -> Column:
    """The double of an order code."""
    a = F.abs(code)
    e = F.shiftright(a, 52)
    part = (a % F.lit(_MANTISSA)).cast("double")
    size = F.when(e == 0, part / F.lit(2.0 ** 537) / F.lit(2.0 ** 537)) \
        .otherwise((part / F.lit(float(_MANTISSA)) + 1) * F.pow(F.lit(2.0), F.least(e, F.lit(2046)) - 1023))
    size = F.when(a > F.lit(2047 * _MANTISSA), F.lit(float("nan"))) \
        .when(a == F.lit(2047 * _MANTISSA), F.lit(float("inf"))).otherwise(size)
    return F.when(code < 0, -size).otherwise(size)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = (), is_stored: bool = False) -> DataFrame:
    """Long result ``(*by, column, p, value)`` for every column and probability (see
    ``quantile_arrays``)."""
    each = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("p"), F.col("values").alias("value"))
    return quantile_arrays(df, cols, probs, by, is_stored).select(*by, "column", F.inline(each))


def quantile_arrays(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = (), is_stored: bool = False) -> DataFrame:
    """``(*by, column, values)``, one value per probability: groups are the distinct ``by``
    values (null is a value), columns without a non-null value in a group give no row.
    ``is_stored`` says that ``df`` is cheap to read (a stored table); otherwise it is stored
    first."""
    if not is_stored:
        df = stored(df.select(*by, *cols), "quantile-input")
    names = ["column", *by]
    keys = ", ".join(f"`{k}`" for k in names)
    each = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    rows = f"(SELECT {keys}, _x FROM {{t}} LATERAL VIEW stack({len(cols)}, {each}) AS `column`, _x WHERE _x IS NOT NULL)"
    # r: two ranks per probability, null where they lie in another prefix
    here = "transform(r, x -> IF(x >= below AND x < below + c, x - below, NULL)) AS r"
    held = "exists(r, x -> x IS NOT NULL)"
    at = ", ".join(f"CAST(floor({float(p)!r}D * (n - 1)) AS BIGINT)" for p in probs)
    first = f"flatten(transform(array({at}), x -> array(x, least(x + 1, n - 1)))) AS r"
    run = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    top, *lower = SHIFTS
    # p<i>: per (group, column) the prefixes that hold a wanted rank, with the rank inside them
    steps = [f"""v AS ({order_code_sql(rows, "_x", keys)})""", f"""
b0 AS (SELECT {keys}, shiftright(_code, {top}) AS prefix, count(*) AS c
       FROM v GROUP BY {keys}, shiftright(_code, {top})),
p0 AS (SELECT * FROM (SELECT {keys}, n, prefix, {here} FROM (
         SELECT *, {first} FROM (
           SELECT *, sum(c) OVER (PARTITION BY {keys} ORDER BY prefix {run}) - c AS below,
                  sum(c) OVER (PARTITION BY {keys}) AS n FROM b0)))
       WHERE {held})"""]
    for i, (above, shift) in enumerate(zip(SHIFTS, lower), 1):
        same = " AND ".join(f"v.`{k}` <=> p.`{k}`" for k in names)
        own = ", ".join(f"v.`{k}`" for k in names)
        # without groups the prefixes are a handful of rows, else their number is left to measure
        hint = "" if by else "/*+ BROADCAST(p) */"
        steps.append(f"""
b{i} AS (SELECT {hint} {own}, p.prefix AS parent, n, r, shiftright(_code, {shift}) AS prefix, count(*) AS c
         FROM v JOIN p{i - 1} p ON {same} AND shiftright(v._code, {above}) = p.prefix
         GROUP BY {own}, p.prefix, n, r, shiftright(_code, {shift})),
p{i} AS (SELECT * FROM (SELECT {keys}, n, prefix, {here} FROM (
           SELECT *, sum(c) OVER (PARTITION BY {keys}, parent ORDER BY prefix {run}) - c AS below
           FROM b{i})) WHERE {held})""")
    found = df.sparkSession.sql("WITH " + ",".join(steps) + f" SELECT * FROM p{len(lower)}", t=df)
    end = lambda i: F.max(F.when(F.col("r")[i].isNotNull(), F.col("prefix")))
    wide = found.groupBy(*names, "n").agg(*[code_value(end(i)).alias(f"_v{i}") for i in range(2 * len(probs))])

    def between(i: int, p: float) -> Column:
        at = F.lit(float(p)) * (F.col("n") - 1)
        part = at - F.floor(at)
        low, high = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        return low + F.when(part == 0, F.lit(0.0)).otherwise(part * (high - low))

    return wide.select(*by, "column", F.array(*[between(i, p) for i, p in enumerate(probs)]).alias("values"))
