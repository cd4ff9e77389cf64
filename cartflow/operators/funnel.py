"""Funnel marts and funnel KPIs.

All of these are one hash aggregation with map-side partial aggregation:
a hot key (one brand or product holding a third of the events) is combined
inside each map task before the shuffle, so it never lands in one reducer
as raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartflow.functions.labels import (
    NO_BRAND_LABEL,
    NO_CATEGORY_LABEL,
    STAGE_CART,
    STAGE_PURCHASE,
    STAGE_VIEW,
)
from cartflow.functions.ratios import ratio_or_null, safe_divide
from cartflow.operators.events import funnel_measures


def funnel_by(shop: DataFrame, keys: Sequence[str]) -> DataFrame:
    """views, carts, purchases and revenue per ``keys`` (NULL keys kept)."""
    return shop.groupBy(*keys).agg(*funnel_measures())


def mart_funnel_daily(fct: DataFrame) -> DataFrame:
    """A2: daily funnel per (event_date, category_code, brand) with rates."""
    g = funnel_by(fct, ["event_date", "category_code", "brand"])
    return g.select(
        "event_date",
        "category_code",
        "brand",
        "views_cnt",
        "carts_cnt",
        "purchases_cnt",
        ratio_or_null("carts_cnt", "views_cnt").alias("view_to_cart_rate"),
        ratio_or_null("purchases_cnt", "carts_cnt").alias("cart_to_purchase_rate"),
        ratio_or_null("purchases_cnt", "views_cnt").alias("purchase_conversion_rate"),
        "revenue",
    )


def mart_product_conversion(fct: DataFrame) -> DataFrame:
    """A3: per (product_id, category_code, brand) with conversion rate."""
    g = funnel_by(fct, ["product_id", "category_code", "brand"])
    return g.select(
        "product_id",
        "category_code",
        "brand",
        "views_cnt",
        "carts_cnt",
        "purchases_cnt",
        "revenue",
        ratio_or_null("purchases_cnt", "views_cnt").alias("conversion_rate"),
    )


def event_totals(shop: DataFrame) -> DataFrame:
    """One row of global views / carts / purchases and GMV."""
    return shop.agg(*funnel_measures()).withColumnRenamed("revenue", "gmv")


def funnel_rate_columns() -> dict:
    """A22 rate expressions over views/carts/purchases (0.0 on zero)."""
    return {
        "view_to_cart_rate": safe_divide("carts_cnt", "views_cnt"),
        "cart_to_purchase_rate": safe_divide("purchases_cnt", "carts_cnt"),
        "purchase_conversion_rate": safe_divide("purchases_cnt", "views_cnt"),
    }


def funnel_metrics(totals: DataFrame) -> DataFrame:
    """The three funnel rates with the 0.0-on-zero rule."""
    return totals.select(*[c.alias(n) for n, c in funnel_rate_columns().items()])


def funnel_stages(totals: DataFrame) -> DataFrame:
    """(stage_order, stage, events) in long form."""
    return totals.select(
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("stage_order"), F.lit(STAGE_VIEW).alias("stage"),
                         F.col("views_cnt").alias("events")),
                F.struct(F.lit(2).alias("stage_order"), F.lit(STAGE_CART).alias("stage"),
                         F.col("carts_cnt").alias("events")),
                F.struct(F.lit(3).alias("stage_order"), F.lit(STAGE_PURCHASE).alias("stage"),
                         F.col("purchases_cnt").alias("events")),
            )
        )
    )


def _summed(mart: DataFrame, keys: Sequence[str]) -> DataFrame:
    return mart.groupBy(*keys).agg(
        F.sum("views_cnt").cast("bigint").alias("views_cnt"),
        F.sum("carts_cnt").cast("bigint").alias("carts_cnt"),
        F.sum("purchases_cnt").cast("bigint").alias("purchases_cnt"),
        F.sum("revenue").alias("revenue"),
    )


def top_funnel(mart: DataFrame, key: str, label: str, n: int = 15) -> DataFrame:
    """A11/A12 + T1: per ``key`` of the daily mart, views > 0, top ``n`` by views.

    Grouping is on the source column; the NULL group is labelled after
    grouping, so a NULL group and a literal equal to the label stay apart.
    Ties on views are broken by the key (NULLs last).  The top-n is a
    TakeOrderedAndProject: each task keeps n rows, the driver merges them.
    """
    g = _summed(mart, [key]).where(F.col("views_cnt") > 0)
    top = g.orderBy(F.col("views_cnt").desc(), F.col(key).asc_nulls_last()).limit(n)
    return top.select(
        F.coalesce(F.col(key), F.lit(label)).alias(key),
        "views_cnt",
        "carts_cnt",
        "purchases_cnt",
        "revenue",
        ratio_or_null("purchases_cnt", "views_cnt").alias("purchase_conversion_rate"),
    )


def category_funnel(mart: DataFrame, n: int = 15) -> DataFrame:
    return top_funnel(mart, "category_code", NO_CATEGORY_LABEL, n)


def brand_funnel(mart: DataFrame, n: int = 15) -> DataFrame:
    return top_funnel(mart, "brand", NO_BRAND_LABEL, n)


def best_by_conversion(top: DataFrame, key: str) -> DataFrame:
    """T5: the row of ``top`` with the highest conversion (NULL rates last,
    ties by key)."""
    return top.orderBy(
        F.col("purchase_conversion_rate").desc_nulls_last(), F.col(key).asc_nulls_last()
    ).limit(1)


def weighted_rates(mart: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """Rates re-aggregated from the daily mart (sum/sum, never averaged).

    ``cart_dropoff_rate`` is the event-level ``1 - purchases / carts``.
    """
    g = _summed(mart, list(dims))
    return g.select(
        *dims,
        "views_cnt",
        "carts_cnt",
        "purchases_cnt",
        "revenue",
        ratio_or_null("carts_cnt", "views_cnt").alias("view_to_cart_rate"),
        ratio_or_null("purchases_cnt", "carts_cnt").alias("cart_to_purchase_rate"),
        ratio_or_null("purchases_cnt", "views_cnt").alias("purchase_conversion_rate"),
        (F.lit(1.0) - ratio_or_null("purchases_cnt", "carts_cnt")).alias("cart_dropoff_rate"),
    )


def product_rates(product_mart: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """Product conversion re-aggregated over any dimensions."""
    g = _summed(product_mart, list(dims))
    return g.select(
        *dims,
        "views_cnt",
        "purchases_cnt",
        "revenue",
        ratio_or_null("purchases_cnt", "views_cnt").alias("conversion_rate"),
    )


def problem_table(mart: DataFrame, key: str, min_views: int = 0) -> DataFrame:
    """Per ``key``: volumes, conversion and cart drop-off, keeping keys
    with at least ``min_views`` views, highest drop-off first."""
    rates = weighted_rates(mart, [key]).where(F.col("views_cnt") >= F.lit(min_views))
    return rates.select(
        key,
        "views_cnt",
        "carts_cnt",
        "purchases_cnt",
        "purchase_conversion_rate",
        "cart_dropoff_rate",
    ).orderBy(F.col("cart_dropoff_rate").desc_nulls_last(), F.col(key).asc_nulls_last())


def filter_mart(
    mart: DataFrame,
    date_from=None,
    date_to=None,
    categories: Sequence[str] | None = None,
    brands: Sequence[str] | None = None,
    deciles: Sequence[str] | None = None,
    date_col: str = "event_date",
    month_col: str = "event_month",
) -> DataFrame:
    """Dashboard filters (date range, category, brand, score decile) as
    pushed-down predicates.  Where the table is partitioned by month, the dates
    also give a month predicate, so whole partitions are left out."""
    tests = []
    for bound, test in ((date_from, Column.__ge__), (date_to, Column.__le__)):
        if bound is not None:
            day = F.lit(bound).cast("date")
            tests.append(test(F.col(date_col), day))
            if month_col in mart.columns:
                tests.append(test(F.col(month_col), F.lit(str(bound)[:7])))
    for col, values in (("category_code", categories), ("brand", brands), ("score_decile", deciles)):
        if values is not None:
            tests.append(F.col(col).isin(list(values)))
    for test in tests:
        mart = mart.where(test)
    return mart


def by_conversion(top: DataFrame, key: str) -> DataFrame:
    """The top table by conversion, highest first (ties by key), with the
    position of each row; the table has ``n`` rows at most, so one task orders it."""
    order = Window.orderBy(F.col("purchase_conversion_rate").desc_nulls_last(), F.col(key).asc_nulls_last())
    return top.withColumn("position", F.row_number().over(order))
