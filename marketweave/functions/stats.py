"""Aggregate expressions that stay defined under ANSI mode.

``corr()`` divides by zero (and throws under ANSI) when one side is constant; these
forms return null instead, and are all partial-aggregatable (map-side combine).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Standard deviations below this count as zero variance (near-constant floats).
VARIANCE_EPS = 1e-12


def safe_corr(x: str | Column, y: str | Column, eps: float = VARIANCE_EPS) -> Column:
    """Pearson correlation; null when either side has (near) zero variance or n < 2."""
    x, y = F.col(x) if isinstance(x, str) else x, F.col(y) if isinstance(y, str) else y
    # only pairs where both sides are present, like corr()
    xx = F.when(y.isNotNull(), x)
    yy = F.when(x.isNotNull(), y)
    den = F.stddev_pop(xx) * F.stddev_pop(yy)
    return F.when(den > F.lit(eps), F.try_divide(F.covar_pop(xx, yy), den))


def corr_strength(r: str | Column) -> Column:
    """Label a correlation coefficient; thresholds are strict ``>`` as in the reference."""
    r = F.col(r) if isinstance(r, str) else r
    # Label texts and thresholds of the correlation-strength rule.
    return (F.when(r.isNull(), F.lit("No correlation"))
             .when(r > 0.7, F.lit("Strong positive"))
             .when(r > 0.3, F.lit("Moderate positive"))
             .when(r > -0.3, F.lit("Weak"))
             .when(r > -0.7, F.lit("Moderate negative"))
             .otherwise(F.lit("Strong negative")))
