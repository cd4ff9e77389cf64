"""Calendar arithmetic as Spark column expressions.

All helpers work on wall-clock values (TIMESTAMP_NTZ, or TIMESTAMP in a UTC
session) and never depend on the session time zone for NTZ input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minute_index(t: ColumnOrName) -> Column:
    """Whole minutes since 1970-01-01 00:00, rounded down (floor), BIGINT.

    Built from the date and the clock fields so that it is exact for any
    timestamp and has floor semantics before 1970 as well.
    """
    t = _col(t)
    return (
        F.unix_date(F.to_date(t)).cast("bigint") * F.lit(1440)
        + F.hour(t).cast("bigint") * F.lit(60)
        + F.minute(t).cast("bigint")
    )


def minute_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end``.

    10:00:59 -> 10:31:00 is 31 and 10:00:00 -> 10:30:59 is 30: the count of
    boundaries, not of elapsed minutes (``timestampdiff`` counts elapsed).
    """
    return minute_index(end) - minute_index(start)


def month_start(t: ColumnOrName) -> Column:
    """First day of the month of ``t`` as DATE."""
    return F.trunc(F.to_date(_col(t)), "month")


def month_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Calendar-month boundaries from ``start`` to ``end`` (BIGINT)."""
    start, end = _col(start), _col(end)
    return (
        (F.year(end) - F.year(start)).cast("bigint") * F.lit(12)
        + (F.month(end) - F.month(start)).cast("bigint")
    )


def day_of_week(t: ColumnOrName) -> Column:
    """Day of week with Sunday = 0 .. Saturday = 6, BIGINT."""
    return (F.dayofweek(_col(t)) - F.lit(1)).cast("bigint")


def hour_of_day(t: ColumnOrName) -> Column:
    """Hour 0..23 as BIGINT."""
    return F.hour(_col(t)).cast("bigint")
