"""User-level metrics and segments.

Every per-user table is a hash aggregate with map-side combine.  Thresholds
(75th percentile of views, revenue terciles) are exact quantiles from value
counts (``ranks.exact_quantiles``); the resulting one or two numbers are read
on the driver and used as literals.  The user table is read for the thresholds
and for the labels, so it is computed once and cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.functions.labels import (
    EVENT_PURCHASE,
    EVENT_VIEW,
    SEGMENT_BUYER,
    SEGMENT_HEAVY_VIEWER,
    SEGMENT_OTHER,
    USER_NEW,
    USER_RETURNING,
    VALUE_HIGH,
    VALUE_LOW,
    VALUE_MID,
)
from cartflow.functions.ratios import count_if, safe_divide
from cartflow.functions.timefn import month_start
from cartflow.operators.events import purchase_revenue, type_count
from cartflow.operators.ranks import exact_quantiles
from cartflow.session import checkpoint_dir


def _cut(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def purchases_per_user(fct: DataFrame) -> DataFrame:
    """A10: purchases per user (NULL user is one group)."""
    return (
        fct.where(F.col("event_type") == F.lit(EVENT_PURCHASE))
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("purchases_cnt"))
    )


def repeat_purchase_rate(per_user: DataFrame, purchases_col: str = "purchases_cnt") -> DataFrame:
    """Buyers with more than one purchase / buyers; 0.0 when none."""
    c = F.col(purchases_col)
    return per_user.agg(
        safe_divide(count_if(c > 1), count_if(c > 0)).alias("repeat_purchase_rate")
    )


def abandoned_cart_share(
    sessions: DataFrame, carts_col: str = "carts_cnt", purchases_col: str = "purchases_cnt"
) -> DataFrame:
    """Sessions with a cart and no purchase / sessions with a cart."""
    carts, buys = F.col(carts_col), F.col(purchases_col)
    return sessions.agg(
        safe_divide(count_if((carts > 0) & (buys == 0)), count_if(carts > 0)).alias(
            "abandoned_cart_share"
        )
    )


def monthly_user_status(fct: DataFrame, ordered: bool = False) -> DataFrame:
    """A13 + J4 + U5 + P10: new vs returning active users per month.

    DISTINCT (user, month) first, so hot users shrink to one row per month
    before the join.
    """
    um = fct.select("user_id", month_start("event_time").alias("activity_month")).distinct()
    first = um.groupBy("user_id").agg(F.min("activity_month").alias("first_activity_month"))
    j = um.join(first, "user_id", "inner")
    seg = (
        F.when(F.col("activity_month") == F.col("first_activity_month"), F.lit(USER_NEW))
        .otherwise(F.lit(USER_RETURNING))
        .alias("user_segment")
    )
    out = (
        j.select("activity_month", seg, "user_id")
        .groupBy("activity_month", "user_segment")
        .agg(F.count("user_id").alias("users_cnt"))  # (month, user) rows are distinct
    )
    if ordered:  # T6: by month, then segment
        out = out.orderBy(F.col("activity_month").asc_nulls_last(), F.col("user_segment").asc_nulls_last())
    return out


def user_summary(fct: DataFrame) -> DataFrame:
    """Views, purchases and revenue per user."""
    return fct.groupBy("user_id").agg(
        type_count(EVENT_VIEW, "views_cnt"),
        type_count(EVENT_PURCHASE, "purchases_cnt"),
        purchase_revenue("revenue"),
    )


def with_behavior_segment(users: DataFrame, share: float = 0.75) -> DataFrame:
    """P11 + A21: label users; heavy viewers without purchase take priority,
    then buyers, then everyone else.  Heavy = views >= the exact ``share``
    quantile of views over all users."""
    users = _cut(users)
    thr = exact_quantiles(users, "views_cnt", [share], prefix="views").first()[0]
    threshold = F.lit(thr).cast("double")  # one number (NULL when there are no users)
    seg = (
        F.when(
            (F.col("views_cnt") >= threshold) & (F.col("purchases_cnt") == 0),
            F.lit(SEGMENT_HEAVY_VIEWER),
        )
        .when(F.col("purchases_cnt") > 0, F.lit(SEGMENT_BUYER))
        .otherwise(F.lit(SEGMENT_OTHER))
    )
    return users.withColumn("behavior_segment", seg)


def behavior_segments(users: DataFrame, share: float = 0.75) -> DataFrame:
    """Distinct users per behaviour segment."""
    return (
        with_behavior_segment(users, share)
        .groupBy("behavior_segment")
        .agg(F.count("user_id").alias("users_cnt"))  # one row per user
    )


def with_value_segment(users: DataFrame) -> DataFrame:
    """A28 + A29 + P12: buyers (revenue > 0) into revenue terciles.

    Fewer than three distinct revenues -> everyone is the middle segment.
    Otherwise right-closed bins on the exact 1/3 and 2/3 quantiles
    (<= q1 low, <= q2 middle, else high); collapsed edges give no error.
    """
    buyers = _cut(users.where(F.col("revenue") > 0))
    q1, q2, kinds = exact_quantiles(buyers, "revenue", [1.0 / 3.0, 2.0 / 3.0]).first()  # three numbers
    if kinds < 3:
        seg = F.lit(VALUE_MID)
    else:
        seg = (
            F.when(F.col("revenue") <= F.lit(q1), F.lit(VALUE_LOW))
            .when(F.col("revenue") <= F.lit(q2), F.lit(VALUE_MID))
            .otherwise(F.lit(VALUE_HIGH))
        )
    return buyers.withColumn("value_segment", seg)


def value_segments(users: DataFrame) -> DataFrame:
    """Users, revenue sum and mean revenue per value segment."""
    return (
        with_value_segment(users)
        .groupBy("value_segment")
        .agg(
            F.count("user_id").alias("users_cnt"),  # one row per user
            F.sum("revenue").alias("revenue"),
            F.avg("revenue").alias("avg_revenue_per_user"),
        )
    )
