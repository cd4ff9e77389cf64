"""Sinks, mart exports and the BI extract job.

Paths may be local or any Hadoop filesystem.  Session-level outputs are
written as multi-file datasets; only aggregates (bounded size) are
collapsed to a single CSV part when ``single_file`` is asked for.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartflow.sources.files import path_exists, remove_path, replace_path  # noqa: F401
from cartflow.sources.raw import CSV_OPTIONS

log = logging.getLogger(__name__)

MART_SCHEMAS = {
    "mart_funnel_daily": T.StructType(
        [
            T.StructField("event_date", T.DateType()),
            T.StructField("category_code", T.StringType()),
            T.StructField("brand", T.StringType()),
            T.StructField("views_cnt", T.LongType()),
            T.StructField("carts_cnt", T.LongType()),
            T.StructField("purchases_cnt", T.LongType()),
            T.StructField("view_to_cart_rate", T.DoubleType()),
            T.StructField("cart_to_purchase_rate", T.DoubleType()),
            T.StructField("purchase_conversion_rate", T.DoubleType()),
            T.StructField("revenue", T.DoubleType()),
        ]
    ),
    "mart_retention": T.StructType(
        [
            T.StructField("cohort_month", T.DateType()),
            T.StructField("order_month", T.DateType()),
            T.StructField("months_since_first_purchase", T.LongType()),
            T.StructField("active_users", T.LongType()),
            T.StructField("cohort_size", T.LongType()),
            T.StructField("retention_rate", T.DoubleType()),
        ]
    ),
    "mart_product_conversion": T.StructType(
        [
            T.StructField("product_id", T.LongType()),
            T.StructField("category_code", T.StringType()),
            T.StructField("brand", T.StringType()),
            T.StructField("views_cnt", T.LongType()),
            T.StructField("carts_cnt", T.LongType()),
            T.StructField("purchases_cnt", T.LongType()),
            T.StructField("revenue", T.DoubleType()),
            T.StructField("conversion_rate", T.DoubleType()),
        ]
    ),
}

# ---------------------------------------------------------------------------
# Extract file names the dashboard datasets are built from.
# ---------------------------------------------------------------------------
BI_EXPORTS = {
    "mart_funnel_daily": "datalens_funnel_daily",
    "mart_retention": "datalens_retention",
    "mart_product_conversion": "datalens_product_conversion",
}
BI_SESSIONS_SUMMARY = "datalens_sessions_summary"
BI_SCORES = "datalens_propensity_scores"
BI_DECILES = "datalens_propensity_deciles"


def write_parquet(
    df: DataFrame, path: str, partition_by: list[str] | None = None, options: Mapping[str, str] | None = None
) -> str:
    """Replace a Parquet dataset once the new one is whole."""

    def write(folder: str) -> None:
        w = df.write.options(**(options or {}))
        (w.partitionBy(*partition_by) if partition_by else w).parquet(folder)

    return replace_path(df.sparkSession, path, write)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """UTF-8 CSV with header and ',' delimiter.

    ``single_file`` collapses to one part: use it for aggregates only."""
    writer = (df.coalesce(1) if single_file else df).write
    writer = writer.options(header="true", sep=",", encoding="UTF-8", quote='"', escape='"')
    return replace_path(df.sparkSession, path, writer.csv)


def save_table(df: DataFrame, name: str) -> str:
    """Create-or-replace a catalog table.  The new table is written beside the old one
    and takes its name when it is whole, so a job that fails leaves the old table."""
    spark, mark = df.sparkSession, uuid.uuid4().hex
    fresh, old = f"{name}_new_{mark}", f"{name}_old_{mark}"
    try:
        df.write.saveAsTable(fresh)
        held = table_exists(spark, name)
        if held:
            spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
        except Exception:
            if held:
                spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
            raise
        if held:
            spark.sql(f"DROP TABLE {old}")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    return name


def table_exists(spark: SparkSession, name: str) -> bool:
    """Catalog lookup (no data read)."""
    return bool(spark.catalog.tableExists(name))


def read_mart(spark: SparkSession, name: str, marts_dir: str | None = None) -> DataFrame | None:
    """Catalog table, else ``<dir>/<name>.parquet``, else
    ``<dir>/<name>.csv`` (typed by the mart schema), else None + warning."""
    if table_exists(spark, name):
        return spark.table(name)
    if marts_dir:
        pq = f"{marts_dir.rstrip('/')}/{name}.parquet"
        if path_exists(spark, pq):
            return spark.read.parquet(pq)
        csv = f"{marts_dir.rstrip('/')}/{name}.csv"
        if path_exists(spark, csv):
            reader = spark.read.options(**CSV_OPTIONS)
            if name in MART_SCHEMAS:
                reader = reader.schema(MART_SCHEMAS[name])
            return reader.csv(csv)
    log.warning("no mart found for export: %s", name)
    return None


def save_metrics(spark: SparkSession, metrics: Mapping[str, Mapping[str, float]], path: str) -> str:
    """Metrics {model: {metric: value}} as one JSON document."""
    doc = json.dumps(metrics, ensure_ascii=False, indent=2)
    return replace_path(spark, path, spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text)


def load_metrics(spark: SparkSession, path: str) -> dict:
    """Read back what ``save_metrics`` wrote."""
    text = "\n".join(r["value"] for r in spark.read.text(path).collect())
    return json.loads(text)


def metrics_frame(spark: SparkSession, metrics: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Model x metric table (one row per model)."""
    names = sorted({k for m in metrics.values() for k in m})
    rows = [(model, *[float(vals.get(k, 0.0)) for k in names]) for model, vals in metrics.items()]
    schema = "model string, " + ", ".join(f"{k} double" for k in names)
    return spark.createDataFrame(rows, schema)


def read_scores(spark: SparkSession, path: str) -> DataFrame | None:
    """The score dataset, or None (with a warning) when the path or the
    ``model_score`` column is missing."""
    if not path_exists(spark, path):
        log.warning("scores not found: %s; score export skipped", path)
        return None
    df = spark.read.parquet(path)
    if "model_score" not in df.columns:
        log.warning("no model_score column in %s; score export skipped", path)
        return None
    return df


def export_bi(
    spark: SparkSession,
    marts_dir: str,
    out_dir: str,
    sessions: DataFrame | None = None,
    scores_path: str | None = None,
) -> list[str]:
    """The dashboard extracts.

    Marts (table / Parquet / CSV fallback) -> CSV; the sessions summary when
    ``sessions`` is given; the score extract with deciles and the decile
    table when scores exist.  Raises FileNotFoundError if nothing was
    exported.
    """
    from cartflow.operators.deciles import decile_summary, export_scores, score_deciles
    from cartflow.operators.summary import sessions_summary

    out = out_dir.rstrip("/")
    written: list[str] = []
    for table, file_name in BI_EXPORTS.items():
        df = read_mart(spark, table, marts_dir)
        if df is None:
            continue
        written.append(write_csv(df, f"{out}/{file_name}.csv"))
    if sessions is not None:
        written.append(write_csv(sessions_summary(sessions), f"{out}/{BI_SESSIONS_SUMMARY}.csv",
                                 single_file=True))
    else:
        log.warning("sessions summary needs the session fact; skipped")
    if scores_path:
        scores = read_scores(spark, scores_path)
        if scores is not None:
            deciled = score_deciles(scores)
            written.append(write_csv(export_scores(deciled), f"{out}/{BI_SCORES}.csv"))
            written.append(write_csv(decile_summary(deciled), f"{out}/{BI_DECILES}.csv",
                                     single_file=True))
    if not written:
        raise FileNotFoundError("no marts found to export; build the marts first")
    return written


def require_path(spark: SparkSession, path: str, what: str) -> None:
    """Fail early with a clear message when an input is missing."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{what} not found: {path}")


MONTH = "event_month"
#: Columns by which the dashboard filters, besides the date.
FILTERED = ("category_code", "brand")


def with_event_month(df: DataFrame, col: str = "event_time") -> DataFrame:
    """Month partition column for partitioned event storage."""
    return df.withColumn(MONTH, F.date_format(F.to_date(col), "yyyy-MM"))


def write_by_month(df: DataFrame, path: str, col: str = "event_time", options: Mapping[str, str] | None = None) -> str:
    """S6 + P19: replace a Parquet dataset partitioned by month.  Rows are gathered by
    month first, so a month gets files of the advisory size instead of one from
    every task; large months are split over tasks.  Within a file they are ordered by
    category and brand, and both have bloom filters, so that a dashboard's filter leaves
    out row groups inside the months it reads."""
    rows = with_event_month(df, col).hint("rebalance", MONTH)
    keys = [c for c in FILTERED if c in df.columns]
    rows = rows.sortWithinPartitions(MONTH, *keys)
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in keys}
    return write_parquet(rows, path, [MONTH], blooms | dict(options or {}))
