"""The two division rules used by the marts and by the metric helpers.

* mart rates are NULL when the denominator is 0 (``ratio_or_null``);
* metric helpers return 0.0 instead (``safe_divide``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_or_null(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator::DOUBLE / NULLIF(denominator, 0)``."""
    num, den = _col(numerator), _col(denominator)
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator`` as DOUBLE, 0.0 when the denominator is 0."""
    num, den = _col(numerator), _col(denominator)
    return F.when(den == 0, F.lit(0.0)).otherwise(
        num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    )


def count_if(cond: Column) -> Column:
    """Number of rows where ``cond`` is true, BIGINT."""
    return F.count(F.when(cond, F.lit(1)))
