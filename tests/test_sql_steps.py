"""The marts as SQL steps: equal to the function form, and checked before they run."""

import datetime as dt

import pytest

from cartflow.operators import funnel, retention
from cartflow.operators.events import fct_events
from cartflow.operators.sessions import fct_sessions, sessionize
from cartflow.plans.sql_steps import MART_STEPS, Step, StepError, check_steps, run_steps
from cartflow.sources.adapters import load_commerce_events, untied_events


@pytest.fixture(scope="module")
def shop(spark):
    """Ties, events without time or user, and product and category values that are missing."""
    return untied_events(load_commerce_events(spark, "/root/testdata/sf0.001")).checkpoint()


def test_marts_equal_the_function_form(spark, shop):
    events = sessionize(shop)
    got = run_steps(spark, MART_STEPS, {"shop": shop, "shop_sessions": events}, {"since": None})
    fct = fct_events(shop)
    want = {
        "fct_events": fct,
        "fct_sessions": fct_sessions(events),
        "mart_funnel_daily": funnel.mart_funnel_daily(fct),
        "mart_retention": retention.mart_retention(fct),
        "mart_product_conversion": funnel.mart_product_conversion(fct),
    }
    assert list(got) == list(want)
    def rows(df, columns):
        told = [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(columns).collect()]
        return sorted(map(str, told))

    for name, df in want.items():
        columns = [c for c in df.columns if c in got[name].columns]
        assert set(columns) == set(df.columns), name
        assert rows(got[name], columns) == rows(df, columns), name


def test_parameters_are_bound(spark, shop):
    since = dt.date(2024, 1, 10)
    got = run_steps(spark, MART_STEPS, {"shop": shop, "shop_sessions": sessionize(shop)}, {"since": since})
    dates = [r.event_date for r in got["mart_funnel_daily"].select("event_date").distinct().collect()]
    assert dates and min(dates) >= since


def test_order_is_checked_before_anything_runs():
    one, two = Step("a", "SELECT 1 AS x FROM {shop}"), Step("b", "SELECT * FROM {a} JOIN {shop} USING (x)")
    check_steps([one, two], ["shop"])
    assert two.inputs == {"a", "shop"}
    with pytest.raises(StepError, match="b needs a, and a comes later"):
        check_steps([two, one], ["shop"])
    with pytest.raises(StepError, match="a needs shop"):
        check_steps([one], [])
    with pytest.raises(StepError, match="made twice"):
        check_steps([one, one], ["shop"])
    with pytest.raises(StepError, match="made twice"):
        check_steps([Step("shop", "SELECT 1")], ["shop"])
