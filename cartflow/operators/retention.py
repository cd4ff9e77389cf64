"""Cohort retention by month of first purchase.

Plan: reduce purchases to DISTINCT (user, order_month) first.  That table is
bounded by users x months, so a user holding a third of all purchases
contributes only one row per month; the first-month aggregate and the join
back on ``user_id`` then work on this reduced table.  Cohort sizes have one
row per month, a proven small bound, so they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartflow.functions.labels import EVENT_PURCHASE
from cartflow.functions.ratios import ratio_or_null
from cartflow.functions.timefn import month_diff, month_start


def user_purchase_months(fct: DataFrame) -> DataFrame:
    """DISTINCT (user_id, order_month) of purchases; NULL months kept."""
    return (
        fct.where(F.col("event_type") == F.lit(EVENT_PURCHASE))
        .select("user_id", month_start("event_time").alias("order_month"))
        .distinct()
    )


def first_purchase_months(user_months: DataFrame) -> DataFrame:
    """A4: cohort month per user (MIN ignores NULL months)."""
    return user_months.groupBy("user_id").agg(F.min("order_month").alias("cohort_month"))


def cohort_sizes(first: DataFrame) -> DataFrame:
    """A5: distinct users per cohort month (NULL users not counted).  The
    input has one row per user, so a plain count is the distinct count."""
    return first.groupBy("cohort_month").agg(F.count("user_id").alias("cohort_size"))


def mart_retention(fct: DataFrame, ordered: bool = False) -> DataFrame:
    """Active users and retention rate per (cohort_month, order_month).

    Users with a NULL id, and cohorts that are NULL (only NULL-time
    purchases), drop out at the inner joins; a purchase with a NULL time
    gives a row with NULL order month and month number.
    """
    um = user_purchase_months(fct)
    first = first_purchase_months(um)
    sizes = cohort_sizes(first)
    activity = um.join(first, "user_id", "inner")  # U4: already distinct
    active = activity.groupBy("cohort_month", "order_month").agg(
        F.count("user_id").alias("active_users")
    )
    out = active.join(F.broadcast(sizes), "cohort_month", "inner")
    out = out.select(
        "cohort_month",
        "order_month",
        month_diff(F.col("cohort_month"), F.col("order_month")).alias("months_since_first_purchase"),
        "active_users",
        "cohort_size",
        ratio_or_null("active_users", "cohort_size").alias("retention_rate"),
    )
    if ordered:  # T2: by cohort, then month number (NULLs last)
        out = out.orderBy(F.col("cohort_month").asc_nulls_last(),
                          F.col("months_since_first_purchase").asc_nulls_last())
    return out


def retention_pivot(mart: DataFrame) -> DataFrame:
    """The cohort x month grid as rows (cohort_month, month_number, rate), the
    empty cells included: every cohort has all month numbers from 0 to the largest one
    in the mart, rate NULL where the mart has no row.

    Rates are gathered by cohort (one entry a month at most), so the mart is read once;
    the window that finds the largest month number holds one row a cohort."""
    known = mart.where(F.col("months_since_first_purchase").isNotNull())
    cells = F.collect_list(F.struct(F.col("months_since_first_purchase").cast("int"), "retention_rate"))
    rows = known.groupBy("cohort_month").agg(
        F.map_from_entries(cells).alias("_rates"), F.max("months_since_first_purchase").cast("int").alias("_last")
    )
    rows = rows.withColumn("_last", F.max("_last").over(Window.partitionBy()))
    grid = rows.select("cohort_month", "_rates", F.explode(F.sequence(F.lit(0), "_last")).alias("month_number"))
    return grid.select("cohort_month", "month_number", F.try_element_at("_rates", F.col("month_number")).alias("rate"))


def retention_curve(mart: DataFrame) -> DataFrame:
    """Unweighted mean retention per month number."""
    return mart.groupBy("months_since_first_purchase").agg(
        F.avg("retention_rate").alias("retention_rate")
    )


def month1_retention(mart: DataFrame) -> DataFrame:
    """A27 + P18: mean month-1 retention over cohorts, 0.0 when none."""
    return mart.where(F.col("months_since_first_purchase") == 1).agg(
        F.coalesce(F.avg("retention_rate"), F.lit(0.0)).alias("avg_month_1_retention")
    )
