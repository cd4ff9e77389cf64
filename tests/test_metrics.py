"""Ratios and shares, each against the same count in Python."""

import random

import pytest
from pyspark.sql import functions as F

from cartflow.functions.ratios import ratio_or_null, safe_divide
from cartflow.operators.funnel import funnel_metrics
from cartflow.operators.segments import abandoned_cart_share, repeat_purchase_rate


@pytest.mark.parametrize(("num", "den", "safe", "null"), [(7, 8, 0.875, 0.875), (0, 3, 0.0, 0.0), (9, 0, 0.0, None), (0, 0, 0.0, None)])
def test_division_rules(spark, num, den, safe, null):
    row = spark.range(1).select(safe_divide(F.lit(num), F.lit(den)), ratio_or_null(F.lit(num), F.lit(den))).first()
    assert tuple(row) == (safe, null)


@pytest.mark.parametrize("counts", [(640, 160, 48), (0, 0, 0), (5, 0, 2)])
def test_funnel_rates(spark, counts):
    views, carts, buys = counts
    totals = spark.createDataFrame([counts], "views_cnt long, carts_cnt long, purchases_cnt long")
    share = lambda a, b: a / b if b else 0.0
    row = funnel_metrics(totals).first()
    assert (row["view_to_cart_rate"], row["cart_to_purchase_rate"], row["purchase_conversion_rate"]) == (
        share(carts, views), share(buys, carts), share(buys, views),
    )


def test_repeat_buyers_and_abandoned_carts(spark):
    rnd = random.Random(8)
    rows = [(k, rnd.choice([0, 0, 1, 2]), rnd.choice([0, 1, 1, 4])) for k in range(90)]
    df = spark.createDataFrame(rows, "user_id long, carts_cnt long, purchases_cnt long")
    buyers = [b for _, _, b in rows if b]
    assert repeat_purchase_rate(df).first()[0] == sum(b > 1 for b in buyers) / len(buyers)
    carted = [b for _, c, b in rows if c]
    assert abandoned_cart_share(df).first()[0] == carted.count(0) / len(carted)
    assert repeat_purchase_rate(df.limit(0)).first()[0] == abandoned_cart_share(df.limit(0)).first()[0] == 0.0
