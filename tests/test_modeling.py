"""Propensity models on sessions whose outcome is known from two features."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartflow.functions.labels import FEATURE_COLUMNS, TARGET_COLUMN
from cartflow.operators import boosting, deciles, modeling
from cartflow.plans import registry


@pytest.fixture(scope="module")
def visits(spark):
    """Buyers put things into the cart and stay; some values are missing."""
    rnd = random.Random(17)
    rows = []
    for k in range(260):
        carts, minutes = rnd.choice([0, 0, 0, 1, 2, 5]), rnd.expovariate(1 / 20)
        bought = int(rnd.random() < 1 / (1 + np.exp(3 - 1.5 * carts - minutes / 30)))
        noise = [rnd.choice([None, float(rnd.randint(0, 9))]) for _ in FEATURE_COLUMNS]
        own = dict(zip(FEATURE_COLUMNS, noise, strict=True)) | {"carts_cnt": float(carts), "session_duration_minutes": minutes}
        rows.append((f"v{k:04d}", rnd.randint(1, 40), k * 7919 % 260, *[own[c] for c in FEATURE_COLUMNS], bought))
    schema = "session_id string, user_id long, at long, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    df = spark.createDataFrame(rows, f"{schema}, {TARGET_COLUMN} int")
    start = F.timestamp_seconds(F.lit(1_600_000_000) + F.col("at") * 600).cast("timestamp_ntz")
    return df.withColumn("session_start", start).drop("at")


def _parts(visits, share=0.7):
    split = deciles.time_split(visits, share)
    return split.where("is_train"), split.where("not is_train")


def test_split_is_by_time(visits):
    train, test = _parts(visits)
    assert (train.count(), test.count()) == (182, 78)
    assert train.agg(F.max("session_start")).first()[0] < test.agg(F.min("session_start")).first()[0]


@pytest.mark.parametrize("share", [0.0, 1.0, -0.5, 1.5])
def test_split_needs_a_proper_share(visits, share):
    with pytest.raises(ValueError):
        deciles.time_split(visits, share)


def test_split_needs_two_rows(visits):
    for n in (0, 1):
        with pytest.raises(ValueError):
            deciles.time_split(visits.limit(n))


def test_inputs_against_numpy(visits):
    train, _ = _parts(visits)
    pdf = train.toPandas()
    got = {r.feature: r for r in modeling.model_inputs(train).collect()}
    for c in FEATURE_COLUMNS:
        median = pdf[c].median()
        filled = pdf[c].fillna(median)
        assert np.allclose([got[c].median, got[c]["mean"], got[c].deviation], [median, filled.mean(), filled.std(ddof=0)])
    y = pdf[TARGET_COLUMN]
    assert np.isclose(got["hour"].weight_positive, len(y) / (2 * y.sum()))
    assert np.isclose(got["hour"].weight_negative, len(y) / (2 * (1 - y).sum()))


def _plain_inputs(train):
    pdf = train.toPandas().sort_values("session_id")
    x = pdf[list(FEATURE_COLUMNS)].astype(float)
    return x.fillna(x.median()).to_numpy(), pdf[TARGET_COLUMN].to_numpy().astype(float)


def test_baseline_is_the_optimum(visits):
    """Against gradient descent on the written objective, and by its gradient."""
    train, _ = _parts(visits)
    model = modeling.fit_baseline(train)
    x, y = _plain_inputs(train)
    x = (x - x.mean(0)) / x.std(0)
    x = np.column_stack([np.ones(len(x)), x])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    beta, ridge = np.zeros(x.shape[1]), np.array([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(20_000):
        beta -= 0.01 * (x.T @ (w * (1 / (1 + np.exp(-x @ beta)) - y)) + ridge * beta)
    assert np.allclose(model.beta, beta, atol=1e-8) and model.steps < 20
    rows = modeling.coefficients(model, train).collect()
    assert [r.feature for r in rows] == ["intercept", *FEATURE_COLUMNS] and rows[0].rows_cnt == 182
    assert max(abs(r.gradient) for r in rows) < 1e-9
    got = [r.model_score for r in modeling.score(model, train).orderBy("session_id").collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-x @ beta)), atol=1e-8)


def test_baseline_of_odd_samples(spark, visits):
    """One class, a constant column, a column without values and NaN all give finite scores."""
    one = visits.withColumn(TARGET_COLUMN, F.lit(0)).withColumn("hour", F.lit(3.0)).withColumn("events_cnt", F.lit(None).cast("double"))
    one = one.withColumn("views_cnt", F.when(F.col("views_cnt") > 5, F.lit(float("nan"))).otherwise(F.col("views_cnt")))
    model = modeling.fit_baseline(one, max_iter=30)
    for fitted in (model, modeling.fit_trees(one, max_iter=2)):
        scores = [r.model_score for r in modeling.score(fitted, one).collect()]
        assert len(scores) == 260 and np.isfinite(scores).all() and max(scores) < 0.5
    assert modeling.fit_baseline(one.limit(0)).steps == 0 and modeling.fit_trees(one.limit(0)).trees == []


def _plain_trees(x, y, edges, rounds, rate=0.08, l2=0.1, leaves=31):
    """Histogram boosting by the definition, on one machine in floats: probabilities."""
    bins = np.array([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])
    raw = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)

        def best(rows):
            found = None
            for f in range(len(edges)):
                for at in range(len(edges[f])):
                    go = bins[f][rows] <= at
                    left, right = rows[go], rows[~go]
                    if min(len(left), len(right)) < 20 or min(h[left].sum(), h[right].sum()) < 1e-3:
                        continue
                    gain = sum(s * g[r].sum() ** 2 / (h[r].sum() + l2) for r, s in ((left, 1), (right, 1), (rows, -1)))
                    if gain > 1e-12 and (found is None or gain > found[0] + 1e-12):
                        found = (gain, left, right)
            return found

        done, open_ = [], [(best(np.arange(len(y))), np.arange(len(y)))]
        while open_ and len(done) + len(open_) < leaves:
            k = max(range(len(open_)), key=lambda i: open_[i][0][0] if open_[i][0] else -1)
            if open_[k][0] is None:
                break
            (_, left, right), _ = open_.pop(k)
            open_ += [(best(left), left), (best(right), right)]
        for _, rows in open_ + done:
            raw[rows] -= rate * g[rows].sum() / (h[rows].sum() + l2)
    return 1 / (1 + np.exp(-raw))


@pytest.mark.parametrize(("parts", "leaves"), [(1, 31), (5, 31), (3, 4)])
def test_trees_equal_a_plain_version(visits, parts, leaves):
    train, _ = _parts(visits)
    data = modeling.narrow(train)
    medians = modeling.medians_of(data, FEATURE_COLUMNS)
    model = boosting.fit(train.repartition(parts), FEATURE_COLUMNS, medians, TARGET_COLUMN, max_iter=12, max_leaves=leaves)
    x, y = _plain_inputs(train)
    want = _plain_trees(x, y, model.edges, 12, leaves=leaves)
    got = [r.model_score for r in modeling.score(model, train).orderBy("session_id").collect()]
    assert np.allclose(got, want, atol=1e-9) and len(model.trees) == 12
    assert all(len(t.values) == len(t.splits) + 1 <= leaves for t in model.trees)


def test_bins_are_midpoints_or_midpoint_quantiles(spark):
    rnd = np.random.default_rng(5)
    wide = np.concatenate([rnd.normal(size=700), np.full(400, 0.25)])  # more than 255 values, one of them hot
    few = rnd.integers(0, 9, len(wide)).astype(float) * np.where(rnd.random(len(wide)) < 0.5, 1, -1)
    df = spark.createDataFrame([(float(a), float(b), -0.0) for a, b in zip(wide, few, strict=True)], "wide double, few double, flat double")
    edges = boosting.bin_edges(df, ["wide", "few", "flat"])
    want = np.unique(np.percentile(wide, np.linspace(0, 100, 256)[1:-1], method="midpoint"))
    assert np.allclose(edges[0], want, atol=1e-12) and len(edges[0]) == len(want)
    values = np.unique(few)
    assert np.array_equal(edges[1], (values[1:] + values[:-1]) / 2) and len(edges[2]) == 0


def test_both_models_beat_chance_on_later_visits(visits):
    scored = modeling.score_sessions(visits, share=0.7, tree_iters=8)
    assert scored.count() == 260 and scored.select("session_id").distinct().count() == 260
    for col in ("baseline_score", "model_score"):
        assert scored.where(F.col(col).between(0, 1)).count() == 260
    metrics = modeling.compare_models(scored)
    assert sorted(metrics) == sorted([modeling.MODEL_BASELINE, modeling.MODEL_TREES])
    for values in metrics.values():
        assert len(values) == 4 and all(0 <= v <= 1 for v in values.values()) and values["roc_auc"] > 0.6


def test_both_fits_take_the_medians_once(visits, monkeypatch):
    seen, medians_of = [], modeling.medians_of
    monkeypatch.setattr(modeling, "medians_of", lambda *a: seen.append(1) or medians_of(*a))
    assert modeling.score_sessions(visits, share=0.7, tree_iters=1).count() == 260 and len(seen) == 1


def _noise(spark, n=400, seed=3):
    rnd = random.Random(seed)
    rows = [(f"s{k}", 1, *[float(rnd.randint(0, 3)) for _ in FEATURE_COLUMNS], rnd.randint(0, 1)) for k in range(n)]
    fields = ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    return spark.createDataFrame(rows, f"session_id string, user_id long, {fields}, {TARGET_COLUMN} int")


def test_trees_stop_early_on_many_rows(spark, monkeypatch):
    """Labels are noise, so the held-back loss soon rises; medians are those of all rows."""
    monkeypatch.setattr(boosting, "EARLY_STOP_ROWS", 100)
    df = _noise(spark, seed=4)
    model = modeling.fit_trees(df, max_iter=30)
    assert boosting.PATIENCE <= len(model.trees) < 30 and len(model.losses) == len(model.trees) + 1
    assert model.medians == {c: df.toPandas()[c].median() for c in FEATURE_COLUMNS}
    pdf = df.withColumn("held", modeling.held_back(df, FEATURE_COLUMNS)).toPandas()
    assert 0.02 < pdf.held.mean() < 0.25
    # The first loss is that of the start score on the rows held back.
    y = pdf.loc[pdf.held, TARGET_COLUMN]
    p = pdf.loc[~pdf.held, TARGET_COLUMN].mean()
    assert np.isclose(model.losses[0], -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean(), atol=1e-9)
    # The rows held back do not shape the trees.
    alone = boosting.fit(df.where(~modeling.held_back(df, FEATURE_COLUMNS)), FEATURE_COLUMNS, model.medians, TARGET_COLUMN, max_iter=3)
    assert alone.trees == model.trees[:3]


def test_stopping_waits_for_rounds_without_a_fall():
    falling = [1.0 - k / 1000 for k in range(40)]  # under 0.1 % a round, but steady
    assert not any(boosting.is_over(falling[:n]) for n in range(41))
    flat = [*falling[:20], *[falling[19]] * 30]
    assert [n for n in range(len(flat)) if boosting.is_over(flat[:n])][0] == 30
    broken = [*falling[:20], *[falling[19] + 0.1] * 9, *falling[20:30]]
    assert not any(boosting.is_over(broken[:n]) for n in range(31))


def test_growth_asks_for_what_it_needs_only():
    """Gains known in part: the growth is sure only if no leaf without a gain was open when
    another was split."""
    node = lambda gain: boosting.Node(100, 0, 1 << 40, True, (gain, 0, 0, 50, 0, 1 << 39) if gain else None)
    known = {(): node(9.0)}
    order, unknown, sure = boosting._played(known, 3, 1.0)
    assert (order, unknown, sure) == ([()], [(0,), (1,)], False)
    known[(0,)], known[(1,)] = node(5.0), node(None)
    order, unknown, sure = boosting._played(known, 3, 1.0)
    assert order == [(), (0,)] and sure  # full: the new leaves need no gain
    order, unknown, sure = boosting._played(known, 4, 1.0)
    assert unknown == [(0, 0), (0, 1)] and not sure


@pytest.mark.parametrize("many", [32, 1])
def test_passes_sum_the_smaller_of_two_leaves_only(visits, monkeypatch, many):
    """The other's histogram is the parent's without it; scores go on through the shared
    folder, and the trees are those of one task."""
    train, _ = _parts(visits)
    medians = modeling.medians_of(modeling.narrow(train), FEATURE_COLUMNS)
    passes, look = [], boosting._look

    def watched(blocks, splits, nodes, start):
        passes.append((splits, nodes, start.tasks))
        found = look(blocks, splits, nodes, start)
        rows = found[0][:, 0, 0].sum(axis=1)
        beside = {a: b for *_, left, right in splits for a, b in ((left, right), (right, left))}
        assert not splits or all(beside[n] not in nodes for n in nodes) and max(rows) * 2 <= 182
        return found

    monkeypatch.setattr(boosting, "_look", watched)
    monkeypatch.setattr(boosting, "TASK_ROWS", 50)
    monkeypatch.setattr(boosting, "MANY_TASKS", many)
    monkeypatch.setattr(boosting, "REFRESH", 2)
    model = boosting.fit(train.repartition(7), FEATURE_COLUMNS, medians, TARGET_COLUMN, max_iter=5)
    assert {n for *_, n in passes} == {min(4, train.sparkSession.sparkContext.defaultParallelism)}
    assert sum(not splits for splits, *_ in passes) == 5
    monkeypatch.setattr(boosting, "TASK_ROWS", 1 << 13)
    assert boosting.fit(train, FEATURE_COLUMNS, medians, TARGET_COLUMN, max_iter=5).trees == model.trees


def test_queries_share_one_production_fit(spark, monkeypatch):
    seen, fit = [], modeling.fit_trees

    def short(train, **how):
        seen.append(how.get("max_iter", 100))
        return fit(train, **(how | {"max_iter": 2}))

    monkeypatch.setattr(modeling, "fit_trees", short)
    monkeypatch.setattr(registry, "_FITTED", {})
    for name in ("tree_model_metrics", "propensity_scores", "model_comparison"):
        assert registry.QUERIES[name](spark, "/root/testdata/sf0.001").count()
    assert seen == [100]
