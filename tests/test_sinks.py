"""Replacement of outputs, and what the stored layout lets a filter leave out."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cartflow.sources import files, sinks
from cartflow.sources.raw import save_processed_events


def _frames(spark):
    good = spark.range(100).withColumn("x", F.lit("old"))
    fails = spark.range(0, 1000, 1, 4).withColumn("x", F.when(F.col("id") < 900, F.lit("new")).otherwise(F.raise_error(F.lit("half-way"))))
    return good, fails


@pytest.mark.parametrize("kind", ["parquet", "csv", "processed", "month"])
def test_a_job_that_fails_leaves_the_old_data(spark, tmp_path, kind):
    good, fails = _frames(spark)
    good, fails = (df.withColumn("event_time", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")) for df in (good, fails))
    write = {"parquet": sinks.write_parquet, "csv": sinks.write_csv, "processed": save_processed_events, "month": sinks.write_by_month}[kind]
    read = lambda: spark.read.option("header", True).csv(path) if kind == "csv" else spark.read.parquet(path)
    path = str(tmp_path / "out")
    write(good, path)
    with pytest.raises(Exception, match="half-way"):
        write(fails, path)
    assert read().count() == 100 and {r.x for r in read().select("x").distinct().collect()} == {"old"}
    assert glob.glob(f"{path}*") == [path]  # nothing is left beside it
    write(fails.where("id < 50"), path)
    assert read().count() == 50 and {r.x for r in read().select("x").distinct().collect()} == {"new"}
    assert glob.glob(f"{path}*") == [path]
    write(read().select("id", "x", F.col("event_time").cast("timestamp_ntz").alias("event_time")).where("id < 9"), path)  # reads what it replaces
    assert read().count() == 9


def test_a_table_that_fails_is_left(spark):
    good, fails = _frames(spark)
    name = "cartflow_test_replaced"
    try:
        sinks.save_table(good, name)
        with pytest.raises(Exception, match="half-way"):
            sinks.save_table(fails, name)
        assert spark.table(name).count() == 100
        sinks.save_table(fails.where("id < 50"), name)
        assert spark.table(name).count() == 50
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_swap_that_fails_is_undone(spark, tmp_path, monkeypatch):
    path, moves, move = str(tmp_path / "out"), [], files._move
    sinks.write_parquet(spark.range(5), path)

    def second_fails(spark_, source, target):
        moves.append(source)
        if len(moves) == 2:
            raise OSError("the store is away")
        move(spark_, source, target)

    monkeypatch.setattr(files, "_move", second_fails)
    with pytest.raises(OSError, match="away"):
        sinks.write_parquet(spark.range(7), path)
    assert spark.read.parquet(path).count() == 5 and glob.glob(f"{path}*") == [path]


def test_filters_leave_out_row_groups(spark, tmp_path):
    """Rows lie by category and brand inside a month, with bloom filters on both."""
    rows = spark.range(60_000).select(
        F.lit("2024-03-05 10:00:00").cast("timestamp_ntz").alias("event_time"),
        F.concat(F.lit("cat"), F.pmod(F.xxhash64("id"), F.lit(40))).alias("category_code"),
        F.concat(F.lit("brand"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(900))).alias("brand"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    path = sinks.write_by_month(rows, str(tmp_path / "out"), options={"parquet.block.size": str(1 << 18), "parquet.page.size": str(1 << 14)})
    groups = blooms = hits = 0
    for name in glob.glob(f"{path}/event_month=2024-03/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            column = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
            stats = column["category_code"].statistics
            groups += 1
            hits += stats.min <= "cat7" <= stats.max
        with open(name, "rb") as f:
            blooms += f.read().count(b"brand7") > 0
    assert groups >= 8 and hits <= 3 and blooms

    def read(condition):
        df = spark.read.parquet(path).where(condition)
        plan = df._jdf.queryExecution().executedPlan()
        n = df._jdf.queryExecution().toRdd().count()
        text = plan.toString()
        scan = plan
        while scan.children().size():
            scan = scan.children().head()
        return n, scan.metrics().apply("numOutputRows").value(), text

    n, seen, text = read("category_code = 'cat7'")
    assert n == rows.where("category_code = 'cat7'").count() and seen < 60_000 / 2 and "EqualTo(category_code,cat7)" in text
    n, seen, _ = read("brand = 'brand-without-rows-5'")  # inside the range of every row group: the bloom filters tell
    assert (n, seen) == (0, 0)
