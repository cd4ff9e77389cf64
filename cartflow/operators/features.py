"""Session feature table for the propensity models.

The user's previous sessions / previous purchase sessions are per-user
running counts.  A plain window over ``PARTITION BY user_id`` would put a
user with a third of all sessions into one task, so they are computed on
one global (user, start, id) order over frozen range partitions
(``ranks.cumulative``) and rebased per user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.functions.labels import FEATURE_COLUMNS, TARGET_COLUMN  # noqa: F401
from cartflow.functions.timefn import day_of_week, hour_of_day
from cartflow.operators.ranks import cumulative
from cartflow.operators.sessions import fct_sessions

def previous_session_counts(sessions: DataFrame) -> DataFrame:
    """W3 + W4: sessions and purchase sessions of the same user strictly
    before each session, ordered by (session_start NULLs last, session_id).

    One global order (user, start, id) over frozen ranges gives every
    session its position and the running sum of purchase flags; a user's
    counts are those minus the values just before the user's first session
    (one row per user, joined back).  No task ever holds a whole user.
    """
    order = [
        F.col("user_id").asc_nulls_last(),
        F.col("session_start").asc_nulls_last(),
        F.col("session_id").asc_nulls_last(),
    ]
    flagged = sessions.withColumn("_pf", F.col("purchase_flag").cast("bigint"))
    run = cumulative(flagged, order, ["_pf"])
    before = F.col("cum__pf") - F.col("_pf")
    starts = run.groupBy(F.col("user_id").alias("_u")).agg(
        F.min("rank").alias("_r0"), F.min(before).alias("_p0")
    )
    j = run.join(starts, run["user_id"].eqNullSafe(starts["_u"]), "inner")
    return j.withColumns(
        {
            "user_previous_sessions_cnt": (F.col("rank") - F.col("_r0")).cast("bigint"),
            "user_previous_purchases_cnt": (before - F.col("_p0")).cast("bigint"),
        }
    ).drop("_pf", "rank", "cum__pf", "total__pf", "_u", "_r0", "_p0")


def session_features(
    sessionized: DataFrame,
    limit: int | None = None,
    ordered: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """M2: one row per session with the 12 features and the target.

    Built from the session aggregate with the mean viewed price folded in
    (one aggregation instead of a second pass and a join).  With ``limit``
    the first ``limit`` sessions by (session_start, session_id) are kept
    (a top-n, not a full sort).  ``keep`` passes extra session-fact columns
    through (e.g. ``revenue`` for the decile table).
    """
    return features_of_sessions(fct_sessions(sessionized, with_view_price=True), limit, ordered, keep)


def features_of_sessions(
    sessions: DataFrame,
    limit: int | None = None,
    ordered: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The features of a session fact that has ``avg_price_viewed`` (as the marts
    job writes it): no second sessionisation."""
    s = previous_session_counts(sessions)
    dow = day_of_week("session_start")
    out = s.select(
        "session_id",
        "user_id",
        "session_start",
        "session_duration_minutes",
        "events_cnt",
        "views_cnt",
        "carts_cnt",
        "distinct_products_cnt",
        "distinct_categories_cnt",
        "avg_price_viewed",
        hour_of_day("session_start").alias("hour"),
        dow.alias("day_of_week"),
        F.when(dow.isin(0, 6), F.lit(1)).otherwise(F.lit(0)).alias("is_weekend"),
        "user_previous_sessions_cnt",
        "user_previous_purchases_cnt",
        "purchase_flag",
        *keep,
    )
    if ordered or limit is not None:
        out = out.orderBy(F.col("session_start").asc_nulls_last(), F.col("session_id").asc_nulls_last())
    if limit is not None:
        out = out.limit(limit)
    return out
