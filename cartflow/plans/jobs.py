"""Batch jobs: raw CSV -> events -> marts -> propensity models -> BI extracts.

Each job reads its inputs from storage and writes its outputs, so the four
stages can run as separate ``spark-submit`` steps and every stage boundary is a written table, not a long lineage.

    python -m cartflow.plans.jobs etl      --raw DIR   --events PATH
    python -m cartflow.plans.jobs marts    --events PATH --marts DIR
    python -m cartflow.plans.jobs train    --marts DIR  [--tree-iters N]
    python -m cartflow.plans.jobs export   --marts DIR  --out DIR
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession

from cartflow.operators import funnel, retention
from cartflow.operators.events import fct_events
from cartflow.operators.features import features_of_sessions
from cartflow.operators.modeling import train_propensity
from cartflow.operators.sessions import fct_sessions, sessionize
from cartflow.session import get_session
from cartflow.sources import raw, sinks
from cartflow.sources.schema import check_events

log = logging.getLogger(__name__)

MARTS = ("mart_funnel_daily", "mart_retention", "mart_product_conversion")


def _p(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def etl_job(spark: SparkSession, raw_dir: str, events_path: str, finite_only: bool = False) -> dict[str, int]:
    """Entry 1 (S1-S7): raw CSV folder -> cleaned events Parquet; returns the counts
    observed on the way."""
    return raw.run_etl(spark, raw_dir, events_path, finite_only=finite_only)


def build_marts(
    spark: SparkSession,
    events_path: str,
    marts_dir: str,
    csv_copies: bool = True,
    catalog_tables: bool = False,
) -> dict[str, str]:
    """Entry 2 (S8-S12, S20): events -> fct_events, fct_sessions and 3 marts.

    ``fct_events`` is written partitioned by month so later date-filtered
    reads prune files; the other tables are derived from that written copy.
    """
    sinks.require_path(spark, events_path, "processed events")
    out: dict[str, str] = {}
    events = check_events(spark.read.parquet(events_path))
    out["fct_events"] = sinks.write_by_month(fct_events(events), _p(marts_dir, "fct_events.parquet"))
    fct = spark.read.parquet(out["fct_events"]).drop(sinks.MONTH)

    # With the mean viewed price, so that training reads sessions, not events.
    facts = fct_sessions(sessionize(fct.drop("event_date")), with_view_price=True)
    out["fct_sessions"] = sinks.write_parquet(facts, _p(marts_dir, "fct_sessions.parquet"))
    tables: dict[str, DataFrame] = {
        "mart_funnel_daily": funnel.mart_funnel_daily(fct),
        "mart_retention": retention.mart_retention(fct),
        "mart_product_conversion": funnel.mart_product_conversion(fct),
    }
    for name, df in tables.items():
        out[name] = sinks.write_parquet(df, _p(marts_dir, f"{name}.parquet"))
        if csv_copies:
            back = spark.read.parquet(out[name])
            sinks.write_csv(back, _p(marts_dir, f"{name}.csv"))
        if catalog_tables:
            sinks.save_table(spark.read.parquet(out[name]), name)
    return out


def train_job(
    spark: SparkSession,
    marts_dir: str,
    metrics_path: str | None = None,
    scores_path: str | None = None,
    tree_iters: int = 100,
) -> dict[str, dict[str, float]]:
    """Entry 3 (M13, S17, S19): features -> split -> two models -> metrics
    JSON + session scores Parquet."""
    sessions = _p(marts_dir, "fct_sessions.parquet")
    sinks.require_path(spark, sessions, "fct_sessions (run the marts job first)")
    feats = features_of_sessions(spark.read.parquet(sessions))
    metrics, scores = train_propensity(feats, tree_iters=tree_iters)
    sinks.save_metrics(spark, metrics, metrics_path or _p(marts_dir, "propensity_metrics.json"))
    sinks.write_parquet(scores, scores_path or _p(marts_dir, "propensity_scores.parquet"))
    return metrics


def export_job(spark: SparkSession, marts_dir: str, out_dir: str) -> list[str]:
    """Entry 4 (S13-S15, S18, W7): dashboard CSV extracts."""
    sessions_path = _p(marts_dir, "fct_sessions.parquet")
    sessions = spark.read.parquet(sessions_path) if sinks.path_exists(spark, sessions_path) else None
    return sinks.export_bi(spark, marts_dir, out_dir, sessions=sessions,
                           scores_path=_p(marts_dir, "propensity_scores.parquet"))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="cartflow.plans.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl")
    e.add_argument("--raw", required=True)
    e.add_argument("--events", required=True)
    e.add_argument("--finite-only", action="store_true")
    m = sub.add_parser("marts")
    m.add_argument("--events", required=True)
    m.add_argument("--marts", required=True)
    m.add_argument("--tables", action="store_true", help="also save catalog tables")
    t = sub.add_parser("train")
    t.add_argument("--marts", required=True)
    t.add_argument("--tree-iters", type=int, default=100)
    x = sub.add_parser("export")
    x.add_argument("--marts", required=True)
    x.add_argument("--out", required=True)
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = get_session(app=f"cartflow-{args.cmd}")
    if args.cmd == "etl":
        log.info("events: %s", etl_job(spark, args.raw, args.events, args.finite_only))
    elif args.cmd == "marts":
        log.info("tables: %s", build_marts(spark, args.events, args.marts, catalog_tables=args.tables))
    elif args.cmd == "train":
        log.info("metrics: %s", train_job(spark, args.marts, tree_iters=args.tree_iters))
    else:
        log.info("exported: %s", export_job(spark, args.marts, args.out))
    spark.stop()


if __name__ == "__main__":
    main()
