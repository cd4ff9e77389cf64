"""Purchase-propensity models.

* baseline: exact median imputation -> standardisation -> logistic regression with
  balanced class weights, the optimum of ``C * sum(w_i * loss_i) + ||beta||^2 / 2`` with
  C = 1 (intercept not penalised), by Newton steps: each step is one aggregate of the
  gradient and the Hessian (a Gram matrix of features), solved on the driver.
* trees: exact median imputation -> histogram gradient boosting (``boosting``).

Both are deterministic up to rounding, whatever the partitioning.  Scores are the
positive-class probability.  Evaluation uses the exact distributed AUC / AP / top-share
metrics from ``deciles``.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow.functions.labels import MODEL_BASELINE, MODEL_TREES
from cartflow.operators import boosting
from cartflow.operators.boosting import BoostedTrees, filled
from cartflow.operators.deciles import SCORE_TIES, auc_metrics, time_split, top_share_metrics
from cartflow.operators.features import FEATURE_COLUMNS, TARGET_COLUMN
from cartflow.operators.ranks import exact_medians
from cartflow.operators.summary import side_by_side
from cartflow.session import checkpoint_dir

# Tasks get this module's functions by value, so executors need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def narrow(train: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = TARGET_COLUMN) -> DataFrame:
    """The training columns as DOUBLE, NaN as missing, computed once: medians, moments,
    Newton steps and class counts all read them."""
    checkpoint_dir(train.sparkSession)
    value = {c: F.col(c).cast("double") for c in features}
    known = [F.when(~F.isnan(v), v).alias(c) for c, v in value.items()]
    return train.select(*known, F.col(label).cast("double").alias(label)).checkpoint()


def medians_of(data: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """M3: the exact median of every column of ``narrow`` rows (0 for one without values)."""
    return {c: m or 0.0 for c, m in exact_medians(data, features).items()}


def class_weights(n: int, positives: float) -> tuple[float, float]:
    """M5: weights n / (2 * n_class) of negative and positive rows."""
    return n / (2.0 * (n - positives)) if n - positives else 0.0, n / (2.0 * positives) if positives else 0.0


@dataclass
class Baseline:
    """A fitted logistic regression on imputed, standardised features."""

    features: tuple[str, ...]
    medians: dict[str, float]
    means: np.ndarray
    scales: np.ndarray
    weights: tuple[float, float]
    #: Intercept, then one coefficient a feature.
    beta: np.ndarray
    steps: int = 0

    def inputs(self) -> list[Column]:
        told = zip(self.features, self.means, self.scales, strict=True)
        return [((filled(c, self.medians[c]) - F.lit(float(m))) / F.lit(float(s))).alias(c) for c, m, s in told]

    def score_column(self) -> Column:
        margin = F.lit(float(self.beta[0]))
        for x, b in zip(self.inputs(), self.beta[1:], strict=True):
            margin = margin + x * F.lit(float(b))
        return 1 / (1 + F.exp(-margin))


def _newton_sums(data: DataFrame, model: Baseline, label: str) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of sum(w * loss) at the model: one row a task and entry, one
    row an entry on the driver."""
    wide = len(model.features) + 1
    beta, weights = model.beta, model.weights

    def added(batches):
        total = np.zeros((wide, wide + 1))
        for batch in batches:
            told = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            x = np.column_stack([np.ones(batch.num_rows), *told[:-1]])
            y, w = told[-1], np.where(told[-1] == 1, weights[1], weights[0])
            p = 1 / (1 + np.exp(-(x @ beta)))
            total[:, :wide] += x.T @ (x * (w * p * (1 - p))[:, None])
            total[:, wide] += x.T @ (w * (p - y))
        i, j = (k.reshape(-1) for k in np.indices(total.shape))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.reshape(-1))], ["i", "j", "total"])

    rows = data.select(*model.inputs(), F.col(label)).mapInArrow(added, "i long, j long, total double")
    out = np.zeros((wide, wide + 1))
    for r in rows.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        out[r["i"], r["j"]] = r["total"]
    return out[:, wide], out[:, :wide]


def fit_baseline(
    train: DataFrame,
    features: Sequence[str] = FEATURE_COLUMNS,
    label: str = TARGET_COLUMN,
    max_iter: int = 1000,
    tol: float = 1e-9,
) -> Baseline:
    """M6: logistic regression baseline (M3 + M4 + M5).  Newton steps until none of the
    coefficients moves by more than ``tol``; a step that does not bring the gradient
    down is halved."""
    data = narrow(train, features, label)
    medians = medians_of(data, features)
    n, positives = data.agg(F.count(F.lit(1)), F.sum(label)).first()
    moments = data.agg(*[f(filled(c, medians[c])) for c in features for f in (F.avg, F.stddev_pop)]).first()
    means = np.array([m or 0.0 for m in moments[0::2]])
    scales = np.array([s or 1.0 for s in moments[1::2]])  # a constant column is left as it is
    model = Baseline(
        tuple(features), medians, means, scales, class_weights(n, positives or 0), np.zeros(len(features) + 1)
    )
    if not n:
        return model
    penalty = np.array([0.0] + [1.0] * len(features))
    gradient, hessian = _newton_sums(data, model, label)
    gradient = gradient + penalty * model.beta
    while model.steps < max_iter:
        # Least squares also serves a sample of one class, whose intercept has no optimum.
        step = np.linalg.lstsq(hessian + np.diag(penalty), gradient, rcond=1e-14)[0]
        model.steps += 1
        before, norm = model.beta, np.abs(gradient).max()
        while True:
            model.beta = before - step
            gradient, hessian = _newton_sums(data, model, label)
            gradient = gradient + penalty * model.beta
            if np.abs(gradient).max() <= max(norm, 1e-9) or np.abs(step).max() <= tol:
                break
            step = step / 2
        if np.abs(step).max() <= tol:
            break
    return model


def held_back(train: DataFrame, features: Sequence[str]) -> Column:
    """A tenth of the rows, by a hash of the session's key (of the features without one)."""
    key = [c for c in ("session_id", "user_id") if c in train.columns] or list(features)
    return F.pmod(F.xxhash64(*key), F.lit(boosting.HELD_SHARE)) == 0


def fit_trees(
    train: DataFrame,
    features: Sequence[str] = FEATURE_COLUMNS,
    label: str = TARGET_COLUMN,
    max_iter: int = 100,
    rate: float = 0.08,
    l2: float = 0.1,
    medians: dict[str, float] | None = None,
) -> BoostedTrees:
    """M7: histogram gradient boosting (M3; medians of all training rows, unless they are
    given), stopped early on more than 10,000 rows by a held-back tenth."""
    medians = medians or medians_of(narrow(train, features, label), features)
    held = held_back(train, features) if train.count() > boosting.EARLY_STOP_ROWS else None
    return boosting.fit(train, features, medians, label, held, max_iter, rate, l2)


def score(model: Baseline | BoostedTrees, df: DataFrame, score_col: str = "model_score") -> DataFrame:
    """M8: positive-class probability as ``score_col``; input columns kept."""
    return df.withColumn(score_col, model.score_column())


def evaluate(scored: DataFrame, score_col: str = "model_score", label: str = TARGET_COLUMN) -> DataFrame:
    """ROC-AUC, PR-AUC, precision and capture in the top 10 % (one row).

    Both metric passes read the scored rows, so they are checkpointed once
    (lineage cut, model applied once)."""
    base = scored.select(score_col, label, *[c for c in SCORE_TIES if c in scored.columns])
    checkpoint_dir(base.sparkSession)
    frozen = base.checkpoint(eager=True)
    a = auc_metrics(frozen, label_col=label, score_col=score_col)
    t = top_share_metrics(frozen, label_col=label, score_col=score_col, share=0.1)
    return side_by_side(a, t)


def model_inputs(train: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = TARGET_COLUMN) -> DataFrame:
    """M3-M5: per feature the median, and mean and deviation after imputation; the
    two class weights beside them."""
    data = narrow(train, features, label)
    medians = exact_medians(data, features)
    values = {c: filled(c, medians[c] or 0.0) for c in features}
    n, n1 = F.count(F.lit(1)), F.sum(label)
    row = data.agg(
        *[F.avg(v).alias(f"a_{c}") for c, v in values.items()],
        *[F.stddev_pop(v).alias(f"d_{c}") for c, v in values.items()],
        (n / (2.0 * n1)).alias("weight_positive"),
        (n / (2.0 * (n - n1))).alias("weight_negative"),
    )
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("feature"),
                        F.lit(medians[c]).cast("double").alias("median"),
                        F.col(f"a_{c}").alias("mean"),
                        F.col(f"d_{c}").alias("deviation"),
                        F.col("weight_positive"),
                        F.col("weight_negative"),
                    )
                    for c in features
                ]
            )
        )
    )


def coefficients(model: Baseline, train: DataFrame, label: str = TARGET_COLUMN) -> DataFrame:
    """M6: the fitted coefficients (intercept first) with, for each, the component of the
    objective's gradient there, per row (0 at the optimum), and the training rows."""
    data = narrow(train, model.features, label)
    n = data.count()
    gradient, _ = _newton_sums(data, model, label)
    gradient = gradient + np.array([0.0, *model.beta[1:]])
    names = ("intercept", *model.features)
    rows = [(c, float(b), float(g / max(n, 1)), n) for c, b, g in zip(names, model.beta, gradient, strict=True)]
    return train.sparkSession.createDataFrame(rows, "feature string, coefficient double, gradient double, rows_cnt long")


def first_splits(train: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = TARGET_COLUMN) -> DataFrame:
    """M7: per feature its number of bins and the best first split of the first tree:
    threshold, gain, and rows, gradient and Hessian sums of the left child."""
    medians = medians_of(narrow(train, features, label), features)
    found = boosting.first_splits(train, features, medians, label)
    kinds = "feature string, bins long, threshold double, gain double, left_rows long, left_gradient double, left_hessian double"
    return train.sparkSession.createDataFrame(found, kinds)


def train_propensity(
    features_df: DataFrame,
    share: float = 0.8,
    tree_iters: int = 100,
) -> tuple[dict[str, dict[str, float]], DataFrame]:
    """Time split -> two fits -> test metrics -> scores for all rows.

    Returns ({model: metrics}, scores DataFrame with baseline_score and
    model_score for every session, train and test alike)."""
    scored = score_sessions(features_df, share, tree_iters)
    metrics = compare_models(scored)
    return metrics, score_table(scored)


def score_table(scored: DataFrame) -> DataFrame:
    """The columns of the score dataset from ``score_sessions`` rows."""
    return scored.select("session_id", "user_id", "session_start", TARGET_COLUMN, "baseline_score", "model_score")


def score_sessions(features_df: DataFrame, share: float = 0.8, tree_iters: int = 100) -> DataFrame:
    """Both models fitted on the train part; every session with both scores
    and ``is_train``, computed once."""
    split = time_split(features_df, share).drop("time_rank")
    train = split.where(F.col("is_train"))
    base = fit_baseline(train)
    trees = fit_trees(train, max_iter=tree_iters, medians=base.medians)
    scored = score(trees, score(base, split, "baseline_score"), "model_score")
    keep = ("session_id", "user_id", "session_start", TARGET_COLUMN, "is_train", "baseline_score", "model_score")
    return scored.select(*keep).checkpoint()


def compare_models(scored: DataFrame) -> dict[str, dict[str, float]]:
    """{model: metrics on the test part} from ``score_sessions`` rows."""
    test = scored.where(~F.col("is_train"))
    metrics = {}
    for name, col in ((MODEL_BASELINE, "baseline_score"), (MODEL_TREES, "model_score")):
        row = evaluate(test, col).first()  # one row of four numbers
        metrics[name] = {k: float(row[k]) for k in row.asDict()}
    return metrics
