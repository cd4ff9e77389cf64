"""End to end: raw CSV written from sf0.001 -> ETL -> marts -> models -> BI."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cartflow.operators import funnel
from cartflow.operators.events import fct_events
from cartflow.plans import jobs
from cartflow.sources import sinks
from cartflow.sources.adapters import load_commerce_events
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def workdir(spark):
    base = tempfile.mkdtemp(prefix="cartflow-jobs-")
    ce = load_commerce_events(spark, SF_SMALL).drop("event_id")
    raw = ce.select(*[F.col(c).cast("string").alias(c) for c in ce.columns])
    raw_dir = os.path.join(base, "raw_csv")
    raw.coalesce(2).write.options(header="true", escape='"').csv(raw_dir)
    # the writer names parts part-*.csv; the ETL lists *.csv directly in the folder
    return base, raw_dir, ce


def test_pipeline(spark, workdir):
    base, raw_dir, ce = workdir
    events = os.path.join(base, "events_clean.parquet")
    marts = os.path.join(base, "marts")
    jobs.etl_job(spark, raw_dir, events)
    clean = spark.read.parquet(events)
    assert clean.count() == ce.distinct().where("price >= 0").count()

    out = jobs.build_marts(spark, events, marts)
    for name in ("fct_events", "fct_sessions", *jobs.MARTS):
        assert sinks.path_exists(spark, out[name])
    got = spark.read.parquet(out["mart_funnel_daily"])
    want = funnel.mart_funnel_daily(fct_events(clean))
    assert got.count() == want.count()
    assert got.agg(F.sum("views_cnt")).first()[0] == want.agg(F.sum("views_cnt")).first()[0]

    # CSV fallback reader returns the same rows, typed
    csv_only = tempfile.mkdtemp(prefix="cartflow-csv-")
    sinks.write_csv(got, os.path.join(csv_only, "mart_funnel_daily.csv"), single_file=True)
    back = sinks.read_mart(spark, "mart_funnel_daily", csv_only)
    assert back.schema["views_cnt"].dataType.typeName() == "long"
    assert back.count() == got.count()
    assert sinks.read_mart(spark, "no_such_mart", csv_only) is None

    metrics = jobs.train_job(spark, marts, tree_iters=3)
    assert set(metrics) == {"baseline_logistic_regression", "hist_gradient_boosting"}
    assert sinks.load_metrics(spark, os.path.join(marts, "propensity_metrics.json")) == metrics

    written = jobs.export_job(spark, marts, os.path.join(base, "bi"))
    names = {os.path.basename(p) for p in written}
    assert {"datalens_funnel_daily.csv", "datalens_retention.csv", "datalens_product_conversion.csv",
            "datalens_sessions_summary.csv", "datalens_propensity_scores.csv",
            "datalens_propensity_deciles.csv"} <= names
    dec = spark.read.option("header", True).csv(os.path.join(base, "bi", "datalens_propensity_deciles.csv"))
    assert dec.count() == 10


def test_missing_inputs(spark):
    empty = tempfile.mkdtemp(prefix="cartflow-none-")
    with pytest.raises(FileNotFoundError):
        jobs.build_marts(spark, os.path.join(empty, "nope.parquet"), empty)
    with pytest.raises(FileNotFoundError):
        jobs.export_job(spark, empty, os.path.join(empty, "bi"))


def test_filters_reach_the_scan(spark, workdir):
    """Dashboard filters on the written event table prune month
    partitions and are pushed into the Parquet scan."""
    base, raw_dir, _ = workdir
    marts = os.path.join(base, "marts_pruning")
    events = os.path.join(base, "events_pruning.parquet")
    jobs.etl_job(spark, raw_dir, events)
    out = jobs.build_marts(spark, events, marts, csv_copies=False)
    fct = spark.read.parquet(out["fct_events"])
    filtered = funnel.filter_mart(fct, date_from="2024-01-05", date_to="2024-01-20", categories=["STANDARD"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan
    assert "(event_month#" in plan and ">= 2024-01)" in plan  # derived from the dates
    assert "GreaterThanOrEqual(event_date,2024-01-05)" in plan
    assert "In(category_code" in plan or "EqualTo(category_code" in plan
    days = "event_date BETWEEN '2024-01-05' AND '2024-01-20'"
    assert filtered.count() == fct.where(f"{days} AND category_code = 'STANDARD'").count()


def test_catalog_table_first(spark):
    """A catalog table wins over files in the fallback reader."""
    name = "cartflow_test_mart_product_conversion"
    df = spark.createDataFrame([(1, "c", "b", 2, 1, 1, 5.0, 0.5)],
                               "product_id long, category_code string, brand string, views_cnt long, "
                               "carts_cnt long, purchases_cnt long, revenue double, conversion_rate double")
    sinks.save_table(df, name)
    try:
        assert sinks.table_exists(spark, name)
        got = sinks.read_mart(spark, name, tempfile.mkdtemp(prefix="cartflow-empty-"))
        assert got.count() == 1 and got.first()["revenue"] == 5.0
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert not sinks.table_exists(spark, name)
