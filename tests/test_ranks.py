"""Distributed exact ranks, deciles, quantiles and ranking metrics against
brute force on small frames."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartflow.operators import deciles, ranks


def _scores(spark, values, labels=None):
    base = dt.datetime(2020, 1, 1)
    labels = labels or [0] * len(values)
    rows = [(f"s{i:03d}", i % 3, base + dt.timedelta(hours=i % 5), int(y), float(v))
            for i, (v, y) in enumerate(zip(values, labels))]
    return spark.createDataFrame(rows, "session_id string, user_id long, session_start timestamp_ntz, "
                                       "purchase_flag int, model_score double")


def test_global_rank_matches_sort(spark):
    rnd = random.Random(3)
    vals = [rnd.choice([0.1, 0.5, 0.9, rnd.random()]) for _ in range(200)]
    df = _scores(spark, vals)
    order = deciles.score_order("model_score")
    got = {r["session_id"]: r["rank"] for r in ranks.global_rank(df, order, num_ranges=7).collect()}
    rows = sorted(df.collect(), key=lambda r: (-r["model_score"], r["session_start"], r["session_id"]))
    assert got == {r["session_id"]: i + 1 for i, r in enumerate(rows)}


def test_deciles_of_twelve(spark):
    df = _scores(spark, [1.0 - i / 100 for i in range(12)])
    d = deciles.score_deciles(df).orderBy("score_rank").select("score_decile").collect()
    assert [r[0] for r in d] == ["D1", "D1", "D2", "D3", "D4", "D5", "D6", "D7", "D8", "D9", "D10", "D10"]


def test_deciles_single_row(spark):
    assert deciles.score_deciles(_scores(spark, [0.3])).first()["score_decile"] == "D1"


def test_rank_first_descending(spark):
    df = _scores(spark, [0.5, 0.9, 0.5])
    got = [r["score_rank"] for r in deciles.score_deciles(df).orderBy("session_id").collect()]
    assert got == [2, 1, 3]


def test_exact_quantiles(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 10]], "x double")
    assert ranks.exact_quantiles(df, "x", [0.75]).first()[0] == 4.75
    df7 = spark.createDataFrame([(float(v),) for v in range(1, 8)], "x double")
    q = ranks.exact_quantiles(df7, "x", [1 / 3, 2 / 3]).first()
    assert (q[0], q[1], q["q_kinds"]) == (3.0, 5.0, 3)
    many = spark.range(100_000).selectExpr("IF(id % 10 = 0, id, 4) AS x")  # one value in nine rows of ten
    assert tuple(ranks.exact_quantiles(many, "x", [0.5, 0.95]).first()) == (4.0, float(np.quantile(
        [i if i % 10 == 0 else 4 for i in range(100_000)], 0.95)), 3)
    assert ranks.value_counts(many, "x").agg(F.max("n")).first()[0] == 90_000
    none = ranks.exact_quantiles(many.limit(0), "x", [0.5]).first()
    assert tuple(none) == (None, 0)
    rnd = np.random.default_rng(1)
    xs = rnd.normal(size=301)
    dfr = spark.createDataFrame([(float(v),) for v in xs], "x double")
    got = ranks.exact_quantiles(dfr, "x", [0.1, 0.5, 0.9]).first()
    assert np.allclose(list(got)[:3], np.quantile(xs, [0.1, 0.5, 0.9]), rtol=0, atol=1e-12)


@pytest.mark.parametrize(("few", "sketch"), [(5_000, 10_000), (7, 25), (1, 10_000)])
def test_quantiles_by_narrowing(spark, monkeypatch, few, sketch):
    """Few values read and a coarse sketch take more passes, and give the same values."""
    monkeypatch.setattr(ranks, "FEW", few)
    monkeypatch.setattr(ranks, "SKETCH", sketch)
    rnd = np.random.default_rng(7)
    columns = {
        "wide": rnd.normal(size=4000) * 1e6,
        "tied": np.where(rnd.random(4000) < 0.6, 1.5, np.where(rnd.random(4000) < 0.9, 2.5, rnd.random(4000))),
        "zeros": np.where(rnd.random(4000) < 0.5, -0.0, 0.0),
        "two": rnd.integers(0, 2, 4000).astype(float),
    }
    df = spark.createDataFrame(list(zip(*[c.tolist() for c in columns.values()], strict=True)), ", ".join(f"{c} double" for c in columns))
    probs = [0.0, 0.013, 1 / 3, 0.5, 0.75, 0.999, 1.0]
    got = ranks.quantile_values(df, dict.fromkeys(columns, probs))
    for c, values in columns.items():
        assert np.allclose(got[c][0], np.quantile(values, probs), rtol=0, atol=1e-9)
        assert got[c][1] == min(3, len(np.unique(values)))


def test_quantiles_without_a_shuffle_of_the_values(spark):
    """Missing and unlimited values, and what kinds of values there are."""
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, None, nan), (None, None, 2.0), (inf, None, nan), (-inf, None, 3.0)], "a double, b double, c double")
    got = ranks.quantile_values(df, {"a": [0.0, 0.5, 1.0], "b": [0.5], "c": [0.0, 0.25, 1.0]})
    assert got["a"] == ([-inf, 1.0, inf], 3) and got["b"] == ([None], 0)
    assert got["c"][0][:2] == [2.0, 2.75] and np.isnan(got["c"][0][2]) and got["c"][1] == 3


def test_top_share_against_a_full_sort(spark):
    """Heavy ties at the border: its rows are taken by the tie-breakers."""
    rnd = random.Random(21)
    for n, share in ((57, 0.1), (40, 0.25), (9, 1.0), (30, 0.01)):
        scores = [rnd.choice([0.2, 0.4, 0.4, 0.8]) for _ in range(n)]
        labels = [rnd.randint(0, 1) for _ in range(n)]
        df = _scores(spark, scores, labels)
        rows = sorted(df.collect(), key=lambda r: (-r["model_score"], r["session_start"], r["session_id"], r["user_id"]))
        top = [r["purchase_flag"] for r in rows[: max(1, math.ceil(n * share))]]
        got = deciles.top_share_metrics(df, share=share).first()
        assert got["precision_at_top_10_percent"] == sum(top) / len(top)
        assert got["purchase_capture_rate_at_top_10_percent"] == (sum(top) / sum(labels) if sum(labels) else 0.0)


def test_top_share_of_nothing(spark):
    assert tuple(deciles.top_share_metrics(_scores(spark, [])).first()) == (0.0, 0.0)


def test_top_share_bad_share(spark):
    with pytest.raises(ValueError):
        deciles.top_share_metrics(_scores(spark, [0.1]), share=0.0)


def _brute_auc_ap(y, s):
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        sel = s >= t
        tp = (y[sel] == 1).sum()
        prec, rec = tp / sel.sum(), tp / len(pos)
        ap += (rec - prev_r) * prec
        prev_r = rec
    return auc, ap


def test_auc_ap_against_brute_force(spark):
    rnd = random.Random(5)
    s = [round(rnd.random(), 1) for _ in range(120)]
    y = [1 if rnd.random() < 0.2 + 0.6 * v else 0 for v in s]
    r = deciles.auc_metrics(_scores(spark, s, y)).first()
    auc, ap = _brute_auc_ap(y, s)
    assert abs(r["roc_auc"] - auc) < 1e-12 and abs(r["pr_auc"] - ap) < 1e-12


def test_auc_one_class(spark):
    r = deciles.auc_metrics(_scores(spark, [0.1, 0.2], [0, 0])).first()
    assert (r["roc_auc"], r["pr_auc"]) == (0.0, 0.0)


def test_global_rank_nulls_last(spark):
    rnd = random.Random(9)
    base = dt.datetime(2020, 1, 1)
    rows = [(f"s{i:03d}", None if rnd.random() < 0.2 else base + dt.timedelta(minutes=rnd.randint(0, 30)))
            for i in range(120)]
    df = spark.createDataFrame(rows, "session_id string, session_start timestamp_ntz")
    order = [F.col("session_start").asc_nulls_last(), F.col("session_id").asc_nulls_last()]
    got = {r["session_id"]: r["rank"] for r in ranks.global_rank(df, order, num_ranges=5).collect()}
    expect = sorted(rows, key=lambda r: (r[1] is None, r[1] or base, r[0]))
    assert got == {sid: i + 1 for i, (sid, _) in enumerate(expect)}


def test_exact_medians(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, float(rnd.randint(0, 5))]), rnd.random(), None) for _ in range(101)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    want = [float(np.median([r[i] for r in rows if r[i] is not None])) for i in (0, 1)]
    assert ranks.exact_medians(df, ["a", "b", "c"]) == {"a": want[0], "b": want[1], "c": None}


def test_neighbouring_places_share_a_sketch(spark, monkeypatch):
    monkeypatch.setattr(ranks, "FEW", 20)
    rnd = np.random.default_rng(4)
    a, b = rnd.normal(size=3000), rnd.integers(0, 7, 3000).astype(float)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b, strict=True)], "a double, b double")
    asked, numbers = [], ranks._numbers

    def counted(rows, aggregates):
        asked.append(sum("percentile_approx" in str(c) for c in aggregates))
        return numbers(rows, aggregates)

    monkeypatch.setattr(ranks, "_numbers", counted)
    assert ranks.exact_medians(df, ["a", "b"]) == {"a": float(np.median(a)), "b": float(np.median(b))}
    assert max(asked) == 2
    got = ranks.quantile_values(df, {"a": [0.1, 0.5, 0.9]})["a"][0]
    assert np.allclose(got, np.quantile(a, [0.1, 0.5, 0.9]), atol=1e-12) and max(asked) == 3


def test_auc_of_huge_counts(spark):
    """Counts whose product exceeds BIGINT."""
    per = spark.createDataFrame([(0.9, 4_000_000_000, 0), (0.1, 0, 4_000_000_000)], "s double, p long, q long")
    rows = ranks.cumulative(per, [F.col("s").desc()], ["p", "q"])
    got = rows.agg(F.sum(F.col("p").cast("double") * F.col("total_q").cast("double"))).first()[0]
    assert got == 1.6e19
