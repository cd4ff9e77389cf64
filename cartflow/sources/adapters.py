"""Adapters from the driver's test tables to the canonical event model.

``commerce_events``      events LEFT JOIN part on the product key in props
``purchases_from_orders`` one purchase event per order (for cohorts)

Both are lazy projections; Catalyst prunes the unused columns and pushes
filters of downstream jobs into the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def commerce_events(events: DataFrame, part: DataFrame) -> DataFrame:
    """Canonical events (plus ``event_id``) from ``events`` and ``part``.

    The join is a plain LEFT join: the optimizer broadcasts ``part`` when its
    estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
    splits skewed product keys otherwise, so no hint is forced here.
    """
    ev = events.select(
        F.col("event_id"),
        F.col("ts").cast("timestamp_ntz").alias("event_time"),
        F.col("user_id"),
        F.when(F.col("event_type") == "click", F.lit("cart"))
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.col("value").alias("price"),
        F.from_json("props", "k bigint")["k"].alias("product_id"),
    )
    p = part.select("p_partkey", "p_type", "p_brand", "p_size")
    joined = ev.join(p, ev["product_id"] == p["p_partkey"], "left")
    session_kind = F.pmod(F.col("event_id"), F.lit(3))
    return joined.select(
        "event_id",
        "event_time",
        "event_type",
        "product_id",
        F.col("p_size").cast("bigint").alias("category_id"),
        F.when(F.pmod(F.col("product_id"), F.lit(10)) == 0, F.lit(None).cast("string"))
        .otherwise(F.col("p_type"))
        .alias("category_code"),
        F.col("p_brand").alias("brand"),
        "price",
        "user_id",
        F.when(session_kind == 0, F.lit(None).cast("string"))
        .when(session_kind == 1, F.lit("   "))
        .otherwise(
            F.concat(
                F.lit("src_"),
                F.col("user_id").cast("string"),
                F.lit("_"),
                F.regexp_replace(F.to_date("event_time").cast("string"), "-", ""),
            )
        )
        .alias("user_session"),
    )


def purchases_from_orders(orders: DataFrame) -> DataFrame:
    """One ``purchase`` event per order: user = customer, time = order date."""
    return orders.select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("event_time"),
        F.lit("purchase").alias("event_type"),
        F.lit(None).cast("bigint").alias("product_id"),
        F.lit(None).cast("bigint").alias("category_id"),
        F.lit(None).cast("string").alias("category_code"),
        F.lit(None).cast("string").alias("brand"),
        F.col("o_totalprice").cast("double").alias("price"),
        F.col("o_custkey").alias("user_id"),
        F.lit(None).cast("string").alias("user_session"),
    )


def untied_events(ce: DataFrame) -> DataFrame:
    """Distinct events without ``event_id``: every third time cut to the hour (so
    that events tie) and every eleventh missing."""
    k = F.col("event_id")
    time = F.when(F.pmod(k, F.lit(11)) == 0, F.lit(None).cast("timestamp_ntz")).when(
        F.pmod(k, F.lit(3)) == 0, F.date_trunc("hour", "event_time").cast("timestamp_ntz")
    )
    missing = F.pmod(k, F.lit(11)) == 0
    return ce.withColumn("event_time", F.when(~missing, F.coalesce(time, F.col("event_time")))).drop("event_id").distinct()


def load_commerce_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commerce_events(read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "part"))


def load_order_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases_from_orders(read_table(spark, sf_dir, "orders"))
