"""Marts on a small shop week, values worked out by hand.

Ada (7) looks at two lamps, puts one into the cart and buys it in one sourced
visit, and buys a rug unsourced in March.  Bo (8) views a rug twice, 40 minutes
apart, unsourced, and leaves a lamp in the cart of a sourced visit.
"""

import datetime as dt

import pytest

from cartflow.operators import funnel, retention, segments, summary
from cartflow.operators.events import fct_events
from cartflow.operators.features import session_features
from cartflow.operators.sessions import fct_sessions, sessionize
from cartflow.sources.schema import EVENT_SCHEMA

D = dt.datetime
LAMP, RUG = "home.lamp", "home.rug"


@pytest.fixture(scope="module")
def sample(spark):
    rows = [
        (D(2021, 1, 9, 23, 50), "view", 51, 5, LAMP, "lux", 40.0, 7, "a1"),
        (D(2021, 1, 9, 23, 58), "view", 52, 5, LAMP, "lux", 60.0, 7, "a1"),
        (D(2021, 1, 10, 0, 2), "cart", 52, 5, LAMP, "lux", 60.0, 7, "a1"),
        (D(2021, 1, 10, 0, 9), "purchase", 52, 5, LAMP, "lux", 60.0, 7, "a1"),
        (D(2021, 3, 3, 8, 30), "purchase", 61, 6, RUG, "wool", 125.0, 7, "  "),
        (D(2021, 1, 11, 9, 0), "view", 61, 6, RUG, "wool", 120.0, 8, None),
        (D(2021, 1, 11, 9, 40), "view", 61, 6, RUG, "wool", 120.0, 8, ""),
        (D(2021, 1, 12, 10, 0), "cart", 51, 5, LAMP, "lux", 40.0, 8, "b1"),
    ]
    return fct_events(spark.createDataFrame(rows, EVENT_SCHEMA))


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_sessions(sample):
    s = by(fct_sessions(sessionize(sample)), "session_id")
    assert set(s) == {"a1", "derived_7_1", "derived_8_1", "derived_8_2", "b1"}
    a = s["a1"]
    assert (a["events_cnt"], a["views_cnt"], a["carts_cnt"], a["purchases_cnt"], a["purchase_flag"]) == (4, 2, 1, 1, 1)
    assert (a["revenue"], a["session_duration_minutes"], a["distinct_products_cnt"], a["distinct_categories_cnt"]) == (60.0, 19, 2, 1)
    assert s["derived_7_1"]["revenue"] == 125.0 and s["b1"]["purchase_flag"] == 0


def test_funnel(sample):
    f = {(r["event_date"].day, r["category_code"]): r for r in funnel.mart_funnel_daily(sample).collect()}
    assert len(f) == 5
    late, next_day = f[9, LAMP], f[10, LAMP]
    assert (late["views_cnt"], late["view_to_cart_rate"], late["cart_to_purchase_rate"]) == (2, 0.0, None)
    assert (next_day["view_to_cart_rate"], next_day["cart_to_purchase_rate"], next_day["revenue"]) == (None, 1.0, 60.0)
    assert (f[11, RUG]["views_cnt"], f[11, RUG]["revenue"]) == (2, 0.0)


def test_retention(sample):
    january, march = dt.date(2021, 1, 1), dt.date(2021, 3, 1)
    got = sorted(tuple(r) for r in retention.mart_retention(sample).collect())
    assert got == [(january, january, 0, 1, 1, 1.0), (january, march, 2, 1, 1, 1.0)]
    grid = sorted(map(tuple, retention.retention_pivot(retention.mart_retention(sample)).collect()))
    assert grid == [(january, 0, 1.0), (january, 1, None), (january, 2, 1.0)]


def test_retention_grid_is_dense(spark):
    """Every cohort has every month number up to the largest; rows without a time have none."""
    day = lambda *d: dt.date(*d)
    rows = [(day(2021, 1, 1), 0, 1.0), (day(2021, 1, 1), 3, 0.25), (day(2021, 2, 1), 0, 1.0), (day(2021, 2, 1), None, 0.5)]
    mart = spark.createDataFrame(rows, "cohort_month date, months_since_first_purchase int, retention_rate double")
    got = sorted(map(tuple, retention.retention_pivot(mart).collect()))
    want = [(day(2021, m, 1), k, {(1, 0): 1.0, (1, 3): 0.25, (2, 0): 1.0}.get((m, k))) for m in (1, 2) for k in range(4)]
    assert got == want
    assert retention.retention_pivot(mart.limit(0)).count() == 0


def test_product_conversion(sample):
    p = by(funnel.mart_product_conversion(sample), "product_id")
    assert (p[51]["conversion_rate"], p[52]["conversion_rate"], p[61]["conversion_rate"]) == (0.0, 1.0, 0.5)


def test_features(sample):
    f = by(session_features(sessionize(sample)), "session_id")
    a = f["a1"]  # starts on a Saturday
    assert (a["hour"], a["day_of_week"], a["is_weekend"], a["avg_price_viewed"]) == (23, 6, 1, 50.0)
    assert [f[k]["user_previous_sessions_cnt"] for k in ("a1", "derived_7_1", "derived_8_1", "derived_8_2", "b1")] == [0, 1, 0, 1, 2]
    assert (f["derived_7_1"]["user_previous_purchases_cnt"], f["b1"]["user_previous_purchases_cnt"]) == (1, 0)
    assert (f["derived_7_1"]["avg_price_viewed"], f["derived_7_1"]["day_of_week"]) == (0.0, 3)


def test_sessions_summary(sample):
    rows = summary.sessions_summary(fct_sessions(sessionize(sample))).collect()
    got = [(r["session_date"].isoformat(), r["session_depth_segment"][:2], r["sessions_cnt"], r["purchase_sessions_cnt"],
            r["cart_sessions_cnt"], r["abandoned_cart_sessions_cnt"], r["revenue"]) for r in rows]
    assert got == [
        ("2021-01-09", "04", 1, 1, 1, 0, 60.0), ("2021-01-11", "01", 2, 0, 0, 0, 0.0),
        ("2021-01-12", "01", 1, 0, 1, 1, 0.0), ("2021-03-03", "01", 1, 1, 0, 0, 125.0),
    ]


def test_kpis(sample):
    got = {r["metric_order"]: r["value"] for r in summary.kpi_table(fct_sessions(sessionize(sample))).collect()}
    assert got == {1: 0.5, 2: 1.0, 3: 1.0, 4: 185.0, 5: 0.5}
    assert tuple(summary.kpi_counters(sample).first()) == (2, 5)


def test_null_time_retention_and_funnel(spark):
    rows = [
        (D(2020, 1, 5), "purchase", 1, 1, "c", "b", 5.0, 1, None),
        (None, "purchase", 1, 1, "c", "b", 5.0, 1, None),
        (None, "purchase", 1, 1, "c", "b", 5.0, 2, None),
    ]
    fct = fct_events(spark.createDataFrame(rows, EVENT_SCHEMA))
    ret = sorted((tuple(r) for r in retention.mart_retention(fct).collect()), key=str)
    assert ret == sorted([
        (dt.date(2020, 1, 1), dt.date(2020, 1, 1), 0, 1, 1, 1.0),
        (dt.date(2020, 1, 1), None, None, 1, 1, 1.0),
    ], key=str)
    dates = {r["event_date"] for r in funnel.mart_funnel_daily(fct).collect()}
    assert None in dates


def test_top_funnel_labels_null_group_after_grouping(spark):
    rows = [
        (D(2020, 1, 1), "view", 1, 1, None, "b", 1.0, 1, "s"),
        (D(2020, 1, 1), "view", 1, 1, "Без категории", "b", 1.0, 1, "s"),
        (D(2020, 1, 1), "view", 1, 1, "Без категории", "b", 1.0, 1, "s"),
    ]
    mart = funnel.mart_funnel_daily(fct_events(spark.createDataFrame(rows, EVENT_SCHEMA)))
    got = sorted((r["category_code"], r["views_cnt"]) for r in funnel.category_funnel(mart).collect())
    assert got == [("Без категории", 1), ("Без категории", 2)]


def test_ordered_outputs_and_feature_limit(sample):
    ret = [(r[0], r[2]) for r in retention.mart_retention(sample, ordered=True).collect()]
    assert ret == sorted(ret)
    mus = [(r[0], r[1]) for r in segments.monthly_user_status(sample, ordered=True).collect()]
    assert mus == sorted(mus)
    first = session_features(sessionize(sample), limit=2).collect()
    assert [r["session_id"] for r in first] == ["a1", "derived_8_1"]


def test_filters(sample):
    from cartflow.sources.sinks import with_event_month

    tagged = with_event_month(sample)
    kept = funnel.filter_mart(tagged, "2021-01-10", "2021-01-11", categories=[LAMP, RUG], brands=["wool"])
    assert kept.count() == 2
    assert funnel.filter_mart(sample, date_to="2021-01-31").count() == 7


def test_metrics_frame(spark):
    from cartflow.sources.sinks import metrics_frame

    m = {"one": {"x": 0.25, "y": 0.5}, "two": {"x": 0.75}}
    rows = {r["model"]: (r["x"], r["y"]) for r in metrics_frame(spark, m).collect()}
    assert rows == {"one": (0.25, 0.5), "two": (0.75, 0.0)}
