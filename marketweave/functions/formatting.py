"""Display formatting that is identical in every engine.

``format_string('%.2f')`` rounds the shortest decimal text of a double half-up, C's
``printf`` rounds the binary value; prices with a trailing 5 in the third decimal come
out one cent apart. Here the value is scaled to hundredths once (one IEEE multiply),
rounded half-up with ``floor(x + 0.5)`` and printed from the integer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(x: str | Column, digits: int = 2, prefix: str = "", suffix: str = "",
          signed: bool = False) -> Column:
    """``x`` with ``digits`` decimals (half-up on the scaled value), e.g.
    ``fixed(p, 2, '$')`` → ``$1029.95``; ``signed=True`` always prints the sign."""
    x = F.col(x) if isinstance(x, str) else x
    scale = 10 ** digits
    units = F.floor(F.abs(x) * scale + F.lit(0.5)).cast("bigint")
    whole = (units / scale).cast("bigint").cast("string")
    body = whole if digits == 0 else F.concat(
        whole, F.lit("."), F.lpad((units % scale).cast("string"), digits, "0"))
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit("+" if signed else ""))
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(sign, F.lit(prefix), body, F.lit(suffix)))


def fixed2(x: str | Column, prefix: str = "", suffix: str = "", signed: bool = False
           ) -> Column:
    """``x`` with two decimals (see ``fixed``)."""
    return fixed(x, 2, prefix, suffix, signed)


def fixed_sql(x: str, digits: int = 2, prefix: str = "", suffix: str = "",
              signed: bool = False) -> str:
    """DuckDB text of ``fixed`` (for the oracle)."""
    scale = 10 ** digits
    u = f"CAST(floor(abs({x}) * {scale} + 0.5) AS BIGINT)"
    pos = "'+'" if signed else "''"
    body = f"CAST({u} // {scale} AS VARCHAR)"
    if digits:
        body += f" || '.' || lpad(CAST({u} % {scale} AS VARCHAR), {digits}, '0')"
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE (CASE WHEN {x} < 0 THEN '-' ELSE {pos} END)"
            f" || '{prefix}' || {body} || '{suffix}' END")


def fixed2_sql(x: str, prefix: str = "", suffix: str = "", signed: bool = False) -> str:
    return fixed_sql(x, 2, prefix, suffix, signed)
