"""Fixed text values and bucket expressions shared by the jobs.

The strings below must equal the ones the dashboards and reports expect,
so they are kept verbatim in one place.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written).
# ---------------------------------------------------------------------------
REQUIRED_EVENT_COLUMNS = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
)
# Model features, in the order of the feature table, and the target.
FEATURE_COLUMNS = [
    "session_duration_minutes",
    "events_cnt",
    "views_cnt",
    "carts_cnt",
    "distinct_products_cnt",
    "distinct_categories_cnt",
    "avg_price_viewed",
    "hour",
    "day_of_week",
    "is_weekend",
    "user_previous_sessions_cnt",
    "user_previous_purchases_cnt",
]
TARGET_COLUMN = "purchase_flag"
EVENT_VIEW = "view"
EVENT_CART = "cart"
EVENT_PURCHASE = "purchase"
DERIVED_SESSION_PREFIX = "derived_"
SESSION_GAP_MINUTES = 30

NO_CATEGORY_LABEL = "Без категории"
NO_BRAND_LABEL = "Без бренда"

DEPTH_1 = "01 событие"
DEPTH_2_3 = "02-03 события"
DEPTH_4_7 = "04-07 событий"
DEPTH_8_15 = "08-15 событий"
DEPTH_16_PLUS = "16+ событий"

USER_NEW = "Новые"
USER_RETURNING = "Возвращающиеся"

SEGMENT_HEAVY_VIEWER = "Активно смотрят без покупки"
SEGMENT_BUYER = "Покупатели"
SEGMENT_OTHER = "Прочие пользователи"

VALUE_LOW = "Низкая ценность"
VALUE_MID = "Средняя ценность"
VALUE_HIGH = "Высокая ценность"

KPI_VIEW_TO_PURCHASE = "Конверсия просмотра в покупку"
KPI_CART_TO_PURCHASE = "Конверсия корзины в покупку"
KPI_REPEAT_BUYERS = "Доля повторных покупателей"
KPI_GMV = "GMV"
KPI_ABANDONED = "Доля брошенных корзин"

STAGE_VIEW = "Просмотр"
STAGE_CART = "Корзина"
STAGE_PURCHASE = "Покупка"

MODEL_BASELINE = "baseline_logistic_regression"
MODEL_TREES = "hist_gradient_boosting"
# ---------------------------------------------------------------------------


def decile_label(decile: Column) -> Column:
    """1..10 -> 'D1'..'D10'."""
    return F.concat(F.lit("D"), decile.cast("string"))


def depth_segment(events_cnt: Column | str) -> Column:
    """Session depth bucket: 1 / 2-3 / 4-7 / 8-15 / 16+ events."""
    n = F.col(events_cnt) if isinstance(events_cnt, str) else events_cnt
    return (
        F.when(n == 1, F.lit(DEPTH_1))
        .when(n.between(2, 3), F.lit(DEPTH_2_3))
        .when(n.between(4, 7), F.lit(DEPTH_4_7))
        .when(n.between(8, 15), F.lit(DEPTH_8_15))
        .otherwise(F.lit(DEPTH_16_PLUS))
    )
