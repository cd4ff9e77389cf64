"""Sessionisation (M1) and the session fact (A1).

Rule: an event keeps its source session id (``user_session`` trimmed, blank
-> NULL).  A blank event starts a new derived session when the user's
previous event of any kind (ordered by time, type, product, tie-breakers;
NULLs last) is missing or more than ``gap`` minute boundaries earlier.  The
derived id is ``derived_<user_id>_<running count of starts>``.

Plan (one scan and one exchange of the events, no per-user sort)
-----------------------------------------------------------------
The gap is measured in minute boundaries, so cut each user's timeline into
blocks of ``gap + 1`` consecutive minute indexes.  Two events in one block
are at most ``gap`` boundaries apart, hence only the *first* event of a
block can start a session, and every event of a block carries the same
running count.

1. The events are dealt by (user, block), ordered within blocks (windows of at
   most ``gap + 1`` minutes of one user), and stored in the shared checkpoint
   folder; their partitioning is kept, so nothing below deals them again.
2. Their first rows are the block table: first and last time, and whether the
   block opens with a blank event.  A window per user runs over it; its rows are
   bounded by the length of the timeline over ``gap + 1`` minutes (17,000 a year),
   whatever the number of events.
3. The block table is dealt by (user, block) and joined to the stored events.

Events without a time come after all others.  The time before them is NULL
except for the first one, so each blank one starts a session (the first only
for a user without timed events).  Their running counts use one global order
over frozen ranges (``ranks.cumulative``), so no user is one task's window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartflow.functions.labels import (
    DERIVED_SESSION_PREFIX,
    EVENT_CART,
    EVENT_PURCHASE,
    EVENT_VIEW,
    SESSION_GAP_MINUTES,
)
from cartflow.functions.timefn import minute_diff, minute_index
from cartflow.operators.events import is_type, purchase_revenue, type_count
from cartflow.operators.ranks import cumulative
from cartflow.session import partitioned_checkpoint


def source_session_id(col: str = "user_session") -> Column:
    """``NULLIF(TRIM(CAST(user_session AS STRING)), '')``."""
    return F.nullif(F.trim(F.col(col).cast("string")), F.lit(""))


#: Order of events at one time: these first, then what makes the order total.
EVENT_ORDER = ("event_type", "product_id")
REST_ORDER = ("category_id", "category_code", "brand", "price", "user_session")


def _order_columns(shop: DataFrame, tie: Sequence[str] | None) -> list[str]:
    if tie is None:
        tie = ("event_id",) if "event_id" in shop.columns else REST_ORDER
    return [*EVENT_ORDER, *[c for c in tie if c in shop.columns]]


def _ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def _on(columns: Sequence[str], left: str, right: str) -> Column:
    return reduce(and_, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


#: User and block without nulls, so that plain equality joins keep the partitioning.
KEY = ("_user", "_nobody", "_block")


def _dealt(timed: DataFrame, order: Sequence[str], gap: int) -> DataFrame:
    """``timed`` events dealt by (user, block) and stored, with their place in the block,
    the time before them there, and the block's last time."""
    spark = timed.sparkSession
    m, width = minute_index("event_time"), F.lit(gap + 1)
    keyed = timed.withColumns(
        {
            "_user": F.coalesce("user_id", F.lit(0)),
            "_nobody": F.col("user_id").isNull(),
            "_block": ((m - F.pmod(m, width)) / width).cast("bigint"),
        }
    )
    in_block = Window.partitionBy(*KEY).orderBy(*_ascending(["event_time", *order]))
    dealt = keyed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *KEY)
    placed = dealt.withColumns(
        {
            "_place": F.row_number().over(in_block),
            "_prior": F.lag("event_time").over(in_block),
            "_last": F.max("event_time").over(Window.partitionBy(*KEY)),
            "_blanks": F.max(F.col("source_session_id").isNull()).over(Window.partitionBy(*KEY)),
        }
    )
    return partitioned_checkpoint(placed)


def _blocks(dealt: DataFrame, gap: int) -> DataFrame:
    """Per (user, block): last time, the time before the block, whether it starts a
    session, and the running count of starts."""
    per_user = Window.partitionBy("_user", "_nobody").orderBy("_block")
    blocks = dealt.where("_place = 1").select(
        "user_id",
        *KEY,
        F.col("event_time").alias("_first"),
        "_last",
        F.lag("_last").over(per_user).alias("_before"),
        "_blanks",
        F.col("source_session_id").isNull().alias("_opens"),
    )
    late = F.col("_before").isNull() | (minute_diff("_before", "_first") > F.lit(gap))
    blocks = blocks.withColumn("_start", (F.col("_opens") & late).cast("int"))
    run = F.sum("_start").over(per_user.rowsBetween(Window.unboundedPreceding, 0))
    return blocks.select("user_id", *KEY, "_last", "_blanks", "_before", "_start", run.alias("_counter"))


def _untimed_rows(untimed: DataFrame, blocks: DataFrame, order: Sequence[str]) -> DataFrame:
    """Counts, start flags and previous times of events without a time."""
    rows = untimed.withColumn("_blank", F.col("source_session_id").isNull().cast("bigint"))
    run = cumulative(rows, _ascending(["user_id", *order]), ["_blank"])
    first = F.min_by("_blank", "rank").alias("_first_blank")
    starts = run.groupBy("user_id").agg(
        F.min("rank").alias("_r0"), F.min(F.col("cum__blank") - F.col("_blank")).alias("_b0"), first
    )
    users = blocks.groupBy("user_id").agg(F.max("_counter").alias("_timed"), F.max("_last").alias("_latest"))
    starts = starts.alias("s").join(users.alias("u"), _on(["user_id"], "s", "u"), "left").select(
        "s.*", "u._timed", "u._latest"
    )
    run = run.alias("r").join(starts.alias("s"), _on(["user_id"], "r", "s")).select(
        "r.*", "s._r0", "s._b0", "s._first_blank", "s._timed", "s._latest"
    )
    seen, is_first = F.col("_timed").isNotNull(), F.col("rank") == F.col("_r0")
    return run.withColumns(
        {
            "_counter": F.coalesce("_timed", F.lit(0)) + F.col("cum__blank") - F.col("_b0")
            - F.when(seen, F.col("_first_blank")).otherwise(F.lit(0)),
            "derived_session_start": ((F.col("_blank") == 1) & ~(is_first & seen)).cast("int"),
            "previous_event_time": F.when(is_first, F.col("_latest")),
        }
    )


def _derived_id() -> Column:
    """The running count's session id; CONCAT skips a NULL user."""
    user = F.col("user_id").cast("string")
    return F.concat_ws("", F.lit(DERIVED_SESSION_PREFIX), user, F.lit("_"), F.col("_counter").cast("string"))


def session_keys(shop: DataFrame, gap: int = SESSION_GAP_MINUTES, tie: Sequence[str] | None = None) -> DataFrame:
    """The distinct (session_id, user_id) of ``sessionize``'s events: source ids, and the
    running counts of blocks that hold a blank event, without a join back to the events."""
    order = _order_columns(shop, tie)
    keyed = shop.select("event_time", "user_id", *order, source_session_id().alias("source_session_id"))
    blocks = _blocks(_dealt(keyed.where("event_time is not null"), order, gap), gap)
    found = keyed.where("source_session_id is not null").select(F.col("source_session_id").alias("session_id"), "user_id")
    found = found.union(blocks.where("_blanks").select(_derived_id().alias("session_id"), "user_id"))
    untimed = keyed.where("event_time is null")
    if not untimed.isEmpty():
        rows = _untimed_rows(untimed, blocks, order).where("source_session_id is null")
        found = found.union(rows.select(_derived_id().alias("session_id"), "user_id"))
    return found.distinct()


def sessionize(
    shop: DataFrame,
    gap: int = SESSION_GAP_MINUTES,
    tie: Sequence[str] | None = None,
    with_previous_time: bool = False,
) -> DataFrame:
    """Add ``source_session_id``, ``derived_session_start`` (0/1) and
    ``session_id`` (and ``previous_event_time`` when asked) to every event.

    ``tie`` names the columns that complete the order (time, type, product);
    by default ``event_id``, or all other event columns where there is none.
    Rows that agree in all of them are interchangeable.
    """
    if gap < 0:
        raise ValueError("gap must be >= 0 minutes")
    order = _order_columns(shop, tie)
    keyed = shop.withColumn("source_session_id", source_session_id())
    dealt = _dealt(keyed.where("event_time is not null"), order, gap)
    blocks = _blocks(dealt, gap)
    rows = dealt.drop("_last", "_blanks").join(blocks.drop("user_id", "_last", "_blanks"), list(KEY))
    rows = rows.withColumns(
        {
            "derived_session_start": F.when(F.col("_place") == 1, F.col("_start")).otherwise(F.lit(0)),
            "previous_event_time": F.coalesce("_prior", "_before"),
        }
    )
    out = [*shop.columns, "source_session_id", "derived_session_start", "previous_event_time", "_counter"]
    rows = rows.select(*out)
    untimed = keyed.where("event_time is null")
    if not untimed.isEmpty():  # else nothing to order; a filter that Parquet statistics answer
        rows = rows.unionByName(_untimed_rows(untimed, blocks, order).select(*out))
    rows = rows.withColumn("session_id", F.coalesce(F.col("source_session_id"), _derived_id()))
    extra = ["previous_event_time"] if with_previous_time else []
    return rows.select(*shop.columns, "source_session_id", "derived_session_start", "session_id", *extra)


def session_measures(with_view_price: bool = False) -> list[Column]:
    aggs = [
        F.min("event_time").alias("session_start"),
        F.max("event_time").alias("session_end"),
        F.count(F.lit(1)).alias("events_cnt"),
        type_count(EVENT_VIEW, "views_cnt"),
        type_count(EVENT_CART, "carts_cnt"),
        type_count(EVENT_PURCHASE, "purchases_cnt"),
        F.max(F.when(is_type(EVENT_PURCHASE), F.lit(1)).otherwise(F.lit(0))).alias("purchase_flag"),
        purchase_revenue("revenue"),
        F.count_distinct("product_id").alias("distinct_products_cnt"),
        F.count_distinct("category_id").alias("distinct_categories_cnt"),
    ]
    if with_view_price:
        aggs.append(F.avg(F.when(is_type(EVENT_VIEW), F.col("price"))).alias("_avg_view_price"))
    return aggs


SESSION_COLUMNS = (
    "session_id", "user_id", "session_start", "session_end", "events_cnt", "views_cnt",
    "carts_cnt", "purchases_cnt", "purchase_flag", "revenue", "session_duration_minutes",
    "distinct_products_cnt", "distinct_categories_cnt",
)


def fct_sessions(sessionized: DataFrame, with_view_price: bool = False) -> DataFrame:
    """A1: one row per (session_id, user_id).

    With ``with_view_price`` an extra ``avg_price_viewed`` column is added:
    the mean price of the session's views, 0 when it has none, and 0 for a
    NULL user (the feature query joins on user_id, which never matches NULL).
    """
    g = sessionized.groupBy("session_id", "user_id").agg(*session_measures(with_view_price))
    g = g.withColumn(
        "session_duration_minutes", minute_diff(F.col("session_start"), F.col("session_end"))
    )
    cols: list = list(SESSION_COLUMNS)
    if with_view_price:
        cols.append(
            F.when(F.col("user_id").isNull(), F.lit(0.0))
            .otherwise(F.coalesce(F.col("_avg_view_price"), F.lit(0.0)))
            .alias("avg_price_viewed")
        )
    return g.select(*cols)
