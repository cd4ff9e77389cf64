"""Score ranks, deciles, time split and ranking metrics
(W5-W9, A18, A36, A37, M9, M10, P15, P17, F12).

All global orders go through ``ranks`` (range partitions frozen by a
checkpoint), never through a single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow.functions.labels import decile_label
from cartflow.functions.ratios import ratio_or_null, safe_divide
from cartflow.operators.ranks import cumulative, global_rank
from cartflow.session import checkpoint_dir

SCORE_TIES = ("session_start", "session_id", "user_id")
SCORE_EXPORT_COLUMNS = (
    "session_id", "user_id", "session_start", "purchase_flag", "baseline_score", "model_score",
    "score_decile",
)


def deterministic_score(sessions: DataFrame, col: str = "model_score") -> DataFrame:
    """Test score (not a model): ((views*31 + carts*17 + events*7) % 97) / 97."""
    raw = F.col("views_cnt") * 31 + F.col("carts_cnt") * 17 + F.col("events_cnt") * 7
    return sessions.withColumn(col, (F.pmod(raw, F.lit(97)) / F.lit(97.0)).cast("double"))


def score_order(score_col: str, ties: Sequence[str] = SCORE_TIES) -> list[Column]:
    """Score descending, then the tie-breakers ascending (NULLs last)."""
    return [F.col(score_col).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in ties]


def score_deciles(
    scores: DataFrame,
    score_col: str = "model_score",
    ties: Sequence[str] = SCORE_TIES,
    decile_col: str = "score_decile",
) -> DataFrame:
    """W5 + W6: rank by score (first-come on ties via ``ties``) and cut the
    ranks 1..n into ten right-closed bins with edges 1 + (n-1)k/10:
    decile = max(1, ceil((r-1)*10 / (n-1))) in exact integers; n = 1 -> D1.
    Labels D1 (best) .. D10."""
    ranked = global_rank(scores, score_order(score_col, ties), rank_col="score_rank", total_col="_n")
    a = (F.col("score_rank") - 1) * 10
    b = F.col("_n") - 1
    dec = F.when(b <= 0, F.lit(1)).otherwise(
        F.greatest(F.lit(1), ((a + b - 1) - F.pmod(a + b - 1, F.greatest(b, F.lit(1))))
                   / F.greatest(b, F.lit(1)))
    ).cast("int")
    return ranked.withColumn(decile_col, decile_label(dec)).drop("_n")


def export_scores(scored: DataFrame) -> DataFrame:
    """W7 + P15: the score extract columns that exist, in order."""
    return scored.select(*[c for c in SCORE_EXPORT_COLUMNS if c in scored.columns])


def decile_summary(
    scored: DataFrame,
    score_col: str = "model_score",
    decile_col: str = "score_decile",
    sessions: DataFrame | None = None,
) -> DataFrame:
    """A18 (+ A37): sessions, purchases, purchase rate and mean score per
    decile.  Revenue and revenue per session are added when the scored rows
    carry ``revenue`` or when ``sessions`` is given (then joined on
    (session_id, user_id))."""
    df = scored
    aggs = [
        F.count("session_id").alias("sessions_cnt"),
        F.sum("purchase_flag").cast("bigint").alias("purchases_cnt"),
        F.avg("purchase_flag").alias("purchase_rate"),
        F.avg(score_col).alias("avg_score"),
    ]
    with_revenue = sessions is not None or "revenue" in df.columns
    if sessions is not None and "revenue" not in df.columns:
        rev = sessions.select(
            F.col("session_id").alias("_sid"), F.col("user_id").alias("_uid"), "revenue"
        )
        cond = (df["session_id"] == rev["_sid"]) & df["user_id"].eqNullSafe(rev["_uid"])
        df = df.join(rev, cond, "left")
    if with_revenue:
        aggs.append(F.sum("revenue").alias("revenue"))
    g = df.groupBy(decile_col).agg(*aggs)
    if with_revenue:
        g = g.withColumn("revenue_per_session", ratio_or_null("revenue", "sessions_cnt"))
    return g


def decile_headline(scored: DataFrame, decile_col: str = "score_decile") -> DataFrame:
    """Overall purchase rate and the top decile's (D1) purchase rate."""
    return scored.agg(
        F.avg("purchase_flag").alias("overall_purchase_rate"),
        F.avg(F.when(F.col(decile_col) == "D1", F.col("purchase_flag"))).alias("top_decile_purchase_rate"),
    )


def _check_share(share: float, upper_inclusive: bool) -> None:
    ok = 0 < share <= 1 if upper_inclusive else 0 < share < 1
    if not ok:
        raise ValueError(f"share must be in (0, 1{']' if upper_inclusive else ')'}: {share}")


def time_split(
    features: DataFrame,
    share: float = 0.8,
    time_col: str = "session_start",
    ties: Sequence[str] = ("session_id", "user_id"),
) -> DataFrame:
    """W8 + F12: flag ``is_train`` for the first int(n*share) rows by time
    (clamped to [1, n-1]), the rest test.  Raises on a bad share, on an
    empty frame and when n < 2 (one side would be empty)."""
    _check_share(share, upper_inclusive=False)
    order = [F.col(time_col).asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in ties]
    ranked = global_rank(features, order, rank_col="time_rank")
    n = ranked.count()  # one number, needed to validate and to cut
    if n == 0:
        raise ValueError("cannot split an empty frame")
    if n < 2:
        raise ValueError("need at least 2 rows for a train/test split")
    cut = min(max(int(n * share), 1), n - 1)
    return ranked.withColumn("is_train", F.col("time_rank") <= F.lit(cut))


def top_share_metrics(
    scored: DataFrame,
    label_col: str = "purchase_flag",
    score_col: str = "model_score",
    share: float = 0.1,
    ties: Sequence[str] = SCORE_TIES,
) -> DataFrame:
    """Precision and purchase capture in the top max(1, ceil(n*share))
    rows by score (ties by ``ties``); zeros when empty."""
    _check_share(share, upper_inclusive=True)
    # Scores whose rows all lie inside the top need no order; only the rows of
    # the score at the border are ranked.
    keys = [c for c in ties if c in scored.columns]
    checkpoint_dir(scored.sparkSession)
    rows = scored.select(F.col(score_col).alias("_s"), F.col(label_col).cast("bigint").alias("_p"), *keys).checkpoint()
    per_score = rows.groupBy("_s").agg(F.count(F.lit(1)).alias("n"), F.sum("_p").alias("p"))
    cum = cumulative(per_score, [F.col("_s").desc_nulls_last()], ["n", "p"])
    top_n = F.greatest(F.lit(1), F.ceil(F.col("total_n") * F.lit(float(share)))).cast("bigint")
    inside, before = F.col("cum_n") <= top_n, F.col("cum_n") - F.col("n")
    border = ~inside & (before < top_n)
    row = cum.agg(
        F.max(top_n).alias("top_n"),
        F.max("total_p").alias("all_pos"),
        F.coalesce(F.sum(F.when(inside, F.col("p"))), F.lit(0)).alias("top_pos"),
        F.max(F.when(border, top_n - before)).alias("room"),
        F.max(F.when(border, F.col("_s"))).alias("score"),
    ).first()  # five numbers
    top_pos = row["top_pos"] or 0
    if row["room"] is not None:
        tied = rows.where(F.col("_s").eqNullSafe(F.lit(row["score"]))).drop("_s")
        ranked = global_rank(tied, [F.col(c).asc_nulls_last() for c in keys] or [F.col("_p")], "_r")
        top_pos += ranked.where(F.col("_r") <= row["room"]).agg(F.sum("_p")).first()[0] or 0  # one number
    g = scored.sparkSession.range(1).select(
        F.lit(top_pos).cast("bigint").alias("top_pos"),
        F.lit(row["top_n"]).cast("bigint").alias("top_n"),
        F.lit(row["all_pos"]).cast("bigint").alias("all_pos"),
    )
    return g.select(
        F.coalesce(safe_divide("top_pos", "top_n"), F.lit(0.0)).alias("precision_at_top_10_percent"),
        F.coalesce(safe_divide("top_pos", "all_pos"), F.lit(0.0)).alias(
            "purchase_capture_rate_at_top_10_percent"
        ),
    )


def auc_metrics(scored: DataFrame, label_col: str = "purchase_flag", score_col: str = "model_score") -> DataFrame:
    """M9 + M10 + P17: ROC-AUC (tied scores get average ranks) and average
    precision (step sum over distinct scores); 0.0 for both when the labels
    are not two-class.

    Work is on the DISTINCT-score table: per score s, positives p_s and
    negatives q_s; one descending cumulative pass gives TP_s and FP_s.
      AUC = sum_s p_s * (N - FP_s + q_s / 2) / (P * N)
      AP  = sum_s (p_s / P) * TP_s / (TP_s + FP_s)
    """
    y = F.col(label_col).cast("bigint")
    per_score = scored.groupBy(F.col(score_col).alias("_s")).agg(
        F.sum(y).alias("p"), F.sum(F.lit(1) - y).alias("q")
    )
    cum = cumulative(per_score, [F.col("_s").desc_nulls_last()], ["p", "q"])
    # Counts multiply as DOUBLE: a product of two of them may exceed BIGINT.
    j = cum.select(
        *[F.col(c).cast("double").alias(c) for c in ("p", "q", "cum_p", "cum_q")],
        F.col("total_p").cast("double").alias("_pos"),
        F.col("total_q").cast("double").alias("_neg"),
    )
    g = j.agg(
        F.sum(F.col("p") * (F.col("_neg") - F.col("cum_q") + F.col("q") / 2.0)).alias("_auc_num"),
        F.sum(F.col("p") * F.col("cum_p") / (F.col("cum_p") + F.col("cum_q"))).alias("_ap_num"),
        F.max("_pos").alias("_pos"),
        F.max("_neg").alias("_neg"),
    )
    pos, neg = F.coalesce(F.col("_pos"), F.lit(0)), F.coalesce(F.col("_neg"), F.lit(0))
    two_class = (pos > 0) & (neg > 0)
    return g.select(
        F.when(two_class, F.col("_auc_num") / (F.col("_pos") * F.col("_neg")))
        .otherwise(F.lit(0.0)).alias("roc_auc"),
        F.when(two_class, F.col("_ap_num") / F.col("_pos")).otherwise(F.lit(0.0)).alias("pr_auc"),
    )
