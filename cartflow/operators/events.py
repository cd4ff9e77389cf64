"""Typed event fact (P3) and the conditional measures shared by all marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow.functions.labels import EVENT_CART, EVENT_PURCHASE, EVENT_VIEW


def fct_events(events: DataFrame) -> DataFrame:
    """Events with ``event_date`` as the second column; other columns kept.

    ``event_time`` stays a wall-clock timestamp; ``event_date`` is its date
    (NULL when the time is NULL).
    """
    rest = [c for c in events.columns if c not in ("event_time", "event_date")]
    return events.select(
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
        F.to_date("event_time").alias("event_date"),
        *[F.col("price").cast("double").alias("price") if c == "price" else F.col(c) for c in rest],
    )


def is_type(name: str) -> Column:
    return F.col("event_type") == F.lit(name)


def type_count(name: str, alias: str) -> Column:
    """``SUM(CASE WHEN event_type = name THEN 1 ELSE 0 END)`` as BIGINT."""
    return F.sum(F.when(is_type(name), F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(alias)


def purchase_revenue(alias: str = "revenue") -> Column:
    """``SUM(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END)``."""
    return F.sum(
        F.when(is_type(EVENT_PURCHASE), F.col("price")).otherwise(F.lit(0.0))
    ).alias(alias)


def funnel_measures() -> list[Column]:
    """views / carts / purchases counts and purchase revenue."""
    return [
        type_count(EVENT_VIEW, "views_cnt"),
        type_count(EVENT_CART, "carts_cnt"),
        type_count(EVENT_PURCHASE, "purchases_cnt"),
        purchase_revenue("revenue"),
    ]
