"""Session summary for the dashboard and headline KPIs
(A8, A15, A23, A32, A34, A35, V5, J5, P9, T4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.functions.labels import (
    EVENT_PURCHASE,
    KPI_ABANDONED,
    KPI_CART_TO_PURCHASE,
    KPI_GMV,
    KPI_REPEAT_BUYERS,
    KPI_VIEW_TO_PURCHASE,
    depth_segment,
)
from cartflow.functions.ratios import count_if, ratio_or_null, safe_divide
from cartflow.operators.events import type_count
from cartflow.operators.funnel import funnel_rate_columns
from cartflow.operators.segments import repeat_purchase_rate
from cartflow.operators.sessions import session_keys
from cartflow.session import checkpoint_dir


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Glue one-row frames with distinct columns into one row (J5):
    union by name, then take each column's single non-NULL value."""
    cols = [c for f in frames for c in f.columns]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in cols])


def sessions_summary(sessions: DataFrame, ordered: bool = True) -> DataFrame:
    """A15 + P9 + T4: per (session_date, depth segment)."""
    g = sessions.groupBy(
        F.to_date("session_start").alias("session_date"),
        depth_segment("events_cnt").alias("session_depth_segment"),
    ).agg(
        F.count(F.lit(1)).alias("sessions_cnt"),
        F.sum("purchase_flag").cast("bigint").alias("purchase_sessions_cnt"),
        count_if(F.col("carts_cnt") > 0).alias("cart_sessions_cnt"),
        count_if((F.col("carts_cnt") > 0) & (F.col("purchases_cnt") == 0)).alias(
            "abandoned_cart_sessions_cnt"
        ),
        F.sum("revenue").alias("revenue"),
        F.avg("session_duration_minutes").alias("avg_session_duration_minutes"),
        F.avg("events_cnt").alias("avg_events_cnt"),
    )
    if ordered:
        g = g.orderBy(F.col("session_date").asc_nulls_last(), F.col("session_depth_segment").asc_nulls_last())
    return g


def session_kpis(summary: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """Session conversion, abandoned-cart share and GMV re-aggregated
    from the summary over any dimensions (sum/sum)."""
    g = summary.groupBy(*dims).agg(
        F.sum("sessions_cnt").cast("bigint").alias("sessions_cnt"),
        F.sum("purchase_sessions_cnt").cast("bigint").alias("purchase_sessions_cnt"),
        F.sum("cart_sessions_cnt").cast("bigint").alias("cart_sessions_cnt"),
        F.sum("abandoned_cart_sessions_cnt").cast("bigint").alias("abandoned_cart_sessions_cnt"),
        F.sum("revenue").alias("gmv"),
    )
    return g.select(
        *dims,
        "sessions_cnt",
        ratio_or_null("purchase_sessions_cnt", "sessions_cnt").alias("session_conversion_rate"),
        ratio_or_null("abandoned_cart_sessions_cnt", "cart_sessions_cnt").alias("abandoned_cart_share"),
        "gmv",
    )


def depth_conversion(summary: DataFrame) -> DataFrame:
    """Per depth segment: sessions, mean events per session, session
    conversion (all weighted by sessions)."""
    g = summary.groupBy("session_depth_segment").agg(
        F.sum("sessions_cnt").cast("bigint").alias("sessions_cnt"),
        F.sum(F.col("avg_events_cnt") * F.col("sessions_cnt")).alias("_events"),
        F.sum("purchase_sessions_cnt").cast("bigint").alias("_buyers"),
    )
    return g.select(
        "session_depth_segment",
        "sessions_cnt",
        ratio_or_null("_events", "sessions_cnt").alias("avg_events_cnt"),
        ratio_or_null("_buyers", "sessions_cnt").alias("session_conversion_rate"),
    )


def overview(fct: DataFrame, sessions: DataFrame) -> DataFrame:
    """A8 + V5 + J5: period, volumes and distinct counts in one row.

    ``source_sessions_cnt`` counts raw ``user_session`` values, blanks
    included, unlike sessionisation."""
    # One row for each distinct value first, so that no row is expanded for two distinct
    # counts; every event's user is that of its session.
    per_source = fct.groupBy("user_session").agg(
        F.min("event_date").alias("first"), F.max("event_date").alias("last"), F.count(F.lit(1)).alias("n")
    )
    a = per_source.agg(
        F.min("first").alias("period_start"),
        F.max("last").alias("period_end"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("events_cnt"),
        F.count("user_session").alias("source_sessions_cnt"),
    )
    per_user = sessions.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    b = per_user.agg(F.count("user_id").alias("users_cnt"), F.coalesce(F.sum("n"), F.lit(0)).alias("sessions_cnt"))
    return side_by_side(a, b)


def _sums(sessions: DataFrame) -> list:
    """Event totals as sums over sessions: every event is in one session."""
    return [F.sum(c).cast("bigint").alias(c) for c in ("views_cnt", "carts_cnt", "purchases_cnt")]


def kpi_counters(shop: DataFrame) -> DataFrame:
    """Number of purchases and number of sessions, without a session fact: purchases
    need no session, and the distinct session keys need no join back to the events."""
    purchases = shop.agg(type_count(EVENT_PURCHASE, "purchases_cnt"))
    return side_by_side(purchases, session_keys(shop).agg(F.count(F.lit(1)).alias("sessions_cnt")))


def kpi_table(sessions: DataFrame) -> DataFrame:
    """The five headline KPIs in long form (metric_order, metric, value).

    All from the session fact, cut to five columns once: one totals row gives
    rates, GMV and the abandoned share, one row for each user the repeat rate."""
    checkpoint_dir(sessions.sparkSession)
    facts = sessions.select("user_id", "views_cnt", "carts_cnt", "purchases_cnt", "revenue").checkpoint()
    with_cart = F.col("carts_cnt") > 0
    totals = facts.agg(
        *_sums(facts),
        F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("gmv"),
        safe_divide(count_if(with_cart & (F.col("purchases_cnt") == 0)), count_if(with_cart)).alias("abandoned_cart_share"),
    )
    rates = totals.select("gmv", "abandoned_cart_share", *[c.alias(n) for n, c in funnel_rate_columns().items()])
    buyers = facts.groupBy("user_id").agg(F.sum("purchases_cnt").alias("purchases_cnt")).where("purchases_cnt > 0")
    one = side_by_side(rates, repeat_purchase_rate(buyers))
    items = [
        (1, KPI_VIEW_TO_PURCHASE, "purchase_conversion_rate"),
        (2, KPI_CART_TO_PURCHASE, "cart_to_purchase_rate"),
        (3, KPI_REPEAT_BUYERS, "repeat_purchase_rate"),
        (4, KPI_GMV, "gmv"),
        (5, KPI_ABANDONED, "abandoned_cart_share"),
    ]
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("metric_order"),
                        F.lit(name).alias("metric"),
                        F.col(col).cast("double").alias("value"),
                    )
                    for i, name, col in items
                ]
            )
        )
    )
