"""Raw CSV events -> cleaned Parquet.

* Files: every ``*.csv`` directly under the input folder (not recursive),
  listed through the Hadoop FileSystem of the path, so HDFS/S3/ABFS work.
* Headers: only the first line of each file is read, through the Hadoop
  FileSystem API (a few concurrent short reads, no data scan); files are
  then grouped by header and each group is read with an all-STRING schema
  in that header's column order, quoted newlines included; files larger than a block
  are read in many splits (``csv_splits``).  Groups are combined with
  ``unionByName(allowMissingColumns)`` so a column is matched by name, never by
  position.  Rows with too few or too many fields are kept as far as they go, and can be
  told by a column of their text (``malformed_by_file`` counts them).
* Cleaning: nine canonical columns, ``try_cast`` of time and numbers (bad
  values become NULL), ``price >= 0``, DISTINCT over the nine columns.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartflow.functions.labels import REQUIRED_EVENT_COLUMNS
from cartflow.sources import csv_splits
from cartflow.sources.files import hadoop_path, replace_path
from cartflow.sources.schema import EventSchemaError, absent_fields, raw_string_schema

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "encoding": "UTF-8"}

_NUMBER = r"^[+-]?([0-9]+(_[0-9]+)*)?(\.([0-9]+(_[0-9]+)*)?)?([eE][+-]?[0-9]+)?$"
_TIME = r"^[0-9]{1,6}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{1,2}(:.*)?)?$"
_SPECIAL = r"(?i)^[+-]?(nan|inf|infinity)$"
BOM = "\ufeff"
#: Text of a row with too few or too many fields; name of the file a row is from.
MALFORMED, SOURCE = "_malformed", "_source_file"


def find_raw_files(spark: SparkSession, raw_dir: str) -> list[str]:
    """``*.csv`` files directly in ``raw_dir``, sorted by name."""
    fs, hpath = hadoop_path(spark, raw_dir)
    if not fs.exists(hpath):
        return []
    statuses = fs.globStatus(hpath.suffix("/*.csv")) or []
    return sorted(str(s.getPath().toString()) for s in statuses if s.isFile())


def _first_line(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    fs, hpath = hadoop_path(spark, path)
    stream = fs.open(hpath)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def read_headers(spark: SparkSession, files: Sequence[str], threads: int = 16) -> dict[str, list[str]]:
    """Header line of every file, parsed as CSV (file -> column names).

    One line of each file is read, never the data: a few files by concurrent
    short reads here, many by tasks (a one-line, unsplit text read that stops
    after the first line of each file)."""
    if len(files) <= 4 * threads:
        with ThreadPoolExecutor(max_workers=max(1, min(threads, len(files) or 1))) as pool:
            lines = dict(zip(files, pool.map(lambda f: _first_line(spark, f), files), strict=True))
    else:
        rows = (
            spark.read.text(list(files))
            .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
            .where("at = 0")
            .withColumn("n", F.monotonically_increasing_id())
            .groupBy("path")
            .agg(F.min_by("value", "n").alias("line"))
            .collect()  # one row for each file
        )
        plain = lambda p: p.split(":", 1)[-1].lstrip("/")
        by_path = {plain(r["path"]): r["line"] for r in rows}
        lines = {f: by_path.get(plain(f), "") for f in files}
    return {f: next(csv.reader(io.StringIO(line.lstrip(BOM))), []) for f, line in lines.items()}


def validate_raw_files(headers: dict[str, list[str]]) -> None:
    """Every file must carry the nine required columns; the error names
    the file and the missing columns in sorted order."""
    for path, columns in headers.items():
        missing = absent_fields(columns)
        if missing:
            raise EventSchemaError([f"{path.rsplit('/', 1)[-1]} lacks {', '.join(missing)}"])


def read_raw_events(
    spark: SparkSession,
    source: str | Sequence[str],
    validate: bool = True,
    multi_line: bool = True,
    with_source: bool = False,
    block_bytes: int = csv_splits.BLOCK_BYTES,
) -> DataFrame:
    """All raw CSV rows as STRING columns, union by name.

    ``source`` is a folder or a list of files.  Raises FileNotFoundError when
    there is no CSV file, ValueError when a file lacks required columns.
    With ``multi_line`` a quoted field may hold newlines; files larger than
    ``block_bytes`` are then cut at record ends (two passes over them), and smaller ones
    are one split each.  Without it Spark splits files itself, for sources known to have
    none.  ``with_source`` adds MALFORMED (the text of a row with too few or too many
    fields, else NULL) and SOURCE.
    """
    files = find_raw_files(spark, source) if isinstance(source, str) else list(source)
    if not files:
        raise FileNotFoundError(f"no CSV files found in {source}")
    headers = read_headers(spark, files)
    if validate:
        validate_raw_files(headers)
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, columns in headers.items():
        groups.setdefault(tuple(columns), []).append(path)
    listed = {}
    if multi_line:
        plain = lambda p: p.split(":", 1)[-1].lstrip("/")
        told = {plain(r["path"]): r["length"] for r in csv_splits.sizes(spark, files).collect()}  # one row a file
        listed = {f: told.get(plain(f), 0) for f in files}
    frames = []
    for cols, paths in groups.items():
        large = [p for p in paths if listed.get(p, 0) > block_bytes]
        small = [p for p in paths if p not in set(large)]
        if small:
            frames.append(_read_whole(spark, cols, small, multi_line))
        if large:
            frames.append(_read_split(spark, cols, [(p, listed[p]) for p in large], block_bytes))
    out = frames[0]
    for fr in frames[1:]:
        out = out.unionByName(fr, allowMissingColumns=True)
    return out if with_source else out.drop(MALFORMED, SOURCE)


def _read_whole(spark: SparkSession, columns: Sequence[str], paths: list[str], multi_line: bool) -> DataFrame:
    reader = spark.read.options(**CSV_OPTIONS, multiLine=str(multi_line).lower(), columnNameOfCorruptRecord=MALFORMED)
    rows = reader.schema(raw_string_schema([*columns, MALFORMED])).csv(paths)
    return rows.withColumn(SOURCE, F.col("_metadata.file_path"))


def _read_split(spark: SparkSession, columns: Sequence[str], files: list[tuple[str, int]], block: int) -> DataFrame:
    told = csv_splits.records(spark, spark.createDataFrame(files, "path string, length long"), block)
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"} | {"columnNameOfCorruptRecord": MALFORMED}
    fields = ", ".join(f"`{c}` string" for c in [*columns, MALFORMED])
    parsed = told.select(F.from_csv("record", F.lit(fields), options).alias("r"), F.col("path").alias(SOURCE))
    return parsed.select("r.*", SOURCE)


def malformed_by_file(raw: DataFrame) -> DataFrame:
    """Rows and malformed rows of every file, from ``read_raw_events(with_source=True)``."""
    # Spark reads the text of malformed rows only beside another column.
    read = F.length(F.concat_ws("", "event_time")) >= 0
    return raw.groupBy(SOURCE).agg(
        F.count(F.lit(1)).alias("rows_cnt"),
        F.count(F.when(F.col(MALFORMED).isNotNull() & read, F.lit(1))).alias("malformed_cnt"),
    )


def parse_price(c: Column) -> Column:
    """text -> DOUBLE with DuckDB's grammar: surrounding blanks allowed,
    digits may be grouped with '_', exponent allowed, nan/inf accepted;
    anything else (including Java suffixes like '12.5d') -> NULL."""
    s = F.trim(c.cast("string"))
    return (
        F.when(s.rlike(_SPECIAL), s.try_cast("double"))
        .when(s.rlike(_NUMBER) & s.rlike("[0-9]"), F.regexp_replace(s, "_", "").try_cast("double"))
        .otherwise(F.lit(None).cast("double"))
    )


def parse_time(c: Column) -> Column:
    """text -> wall-clock TIMESTAMP_NTZ, NULL when unparseable.

    A whole date is needed, and hours come with minutes ('2019', '2019-10' and
    '2019-10-01 10' are NULL).  A zone suffix such as ' UTC' or '+03' is accepted
    and ignored (wall clock kept).  'epoch' and 'infinity', which the SQL engine
    of the oracle reads as times, are NULL here."""
    s = F.trim(c.cast("string"))
    return F.when(s.rlike(_TIME), s.try_cast("timestamp_ntz"))


def parse_id(c: Column) -> Column:
    """text -> BIGINT in the grammar of numbers: '12.7' rounds half away from
    zero, '1e3' and '1_000' are 1000; anything else is NULL."""
    s = F.trim(c.cast("string"))
    plain = s.rlike(r"^[+-]?[0-9]+$")
    number = F.when(s.rlike(_NUMBER) & s.rlike("[0-9]"), F.regexp_replace(s, "_", "").try_cast("decimal(38,6)"))
    return F.when(plain, s.try_cast("bigint")).otherwise(F.round(number, 0).try_cast("bigint"))


def typed_events(raw: DataFrame) -> DataFrame:
    """The nine canonical columns with types applied (no row filter)."""
    missing = absent_fields(raw.columns)
    if missing:
        raise EventSchemaError([f"no field {name}" for name in missing])
    as_long = lambda name: parse_id(F.col(name))
    return raw.select(
        parse_time(F.col("event_time")).alias("event_time"),
        F.col("event_type").cast("string").alias("event_type"),
        as_long("product_id").alias("product_id"),
        as_long("category_id").alias("category_id"),
        F.col("category_code").cast("string").alias("category_code"),
        F.col("brand").cast("string").alias("brand"),
        parse_price(F.col("price")).alias("price"),
        as_long("user_id").alias("user_id"),
        F.col("user_session").cast("string").alias("user_session"),
    )


def clean_events(raw: DataFrame, finite_only: bool = False) -> DataFrame:
    """P1/P2 + U2: typed nine columns, ``price >= 0`` (NaN and +inf pass, as
    in SQL; ``finite_only`` drops them), DISTINCT rows."""
    typed = typed_events(raw)
    keep = F.col("price") >= F.lit(0.0)
    if finite_only:
        keep = keep & ~F.isnan("price") & (F.col("price") != F.lit(float("inf")))
    return typed.where(keep).distinct()


def event_quality(raw: DataFrame) -> DataFrame:
    """V5-style profile of raw text events in one row: rows, NULL count per
    required column, unparseable times, unparseable or negative prices, and
    exact duplicate rows (rows minus distinct rows)."""
    typed_time = parse_time(F.col("event_time"))
    typed_price = parse_price(F.col("price"))
    cols = [c for c in REQUIRED_EVENT_COLUMNS if c in raw.columns]
    prof = raw.agg(
        F.count(F.lit(1)).alias("rows_cnt"),
        *[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"{c}_nulls") for c in cols],
        F.count(F.when(F.col("event_time").isNotNull() & typed_time.isNull(), F.lit(1))).alias("bad_time_cnt"),
        F.count(F.when(F.col("price").isNotNull() & typed_price.isNull(), F.lit(1))).alias("bad_price_cnt"),
        F.count(F.when(typed_price < 0, F.lit(1))).alias("negative_price_cnt"),
    )
    distinct_rows = raw.distinct().agg(F.count(F.lit(1)).alias("_distinct"))
    from cartflow.operators.summary import side_by_side

    return side_by_side(prof, distinct_rows).withColumn(
        "duplicate_rows_cnt", F.col("rows_cnt") - F.col("_distinct")
    ).drop("_distinct")


def save_processed_events(events: DataFrame, output_path: str, partition_by: Sequence[str] | None = None) -> str:
    """Replace the processed Parquet dataset once the new one is whole.

    ``partition_by`` (e.g. a month column) enables partition pruning for
    later date-filtered jobs."""

    def write(folder: str) -> None:
        w = events.write
        (w.partitionBy(*partition_by) if partition_by else w).parquet(folder)

    return replace_path(events.sparkSession, output_path, write)


def observed_etl(raw: DataFrame, finite_only: bool = False) -> tuple[DataFrame, Observation, Observation]:
    """``clean_events`` with observations of what goes in (rows, malformed rows, bad
    times, bad and negative prices, rows kept) and of what comes out (rows)."""
    time, price = parse_time(F.col("event_time")), parse_price(F.col("price"))
    count = lambda fits, name: F.count(F.when(fits, F.lit(1))).alias(name)
    keep = price >= 0
    if finite_only:
        keep = keep & ~F.isnan(price) & (price != F.lit(float("inf")))
    before, after = Observation("etl_in"), Observation("etl_out")
    seen = raw.observe(
        before,
        F.count(F.lit(1)).alias("rows_in"),
        count(F.col(MALFORMED).isNotNull() if MALFORMED in raw.columns else F.lit(False), "malformed_rows"),
        count(F.col("event_time").isNotNull() & time.isNull(), "bad_times"),
        count(F.col("price").isNotNull() & price.isNull(), "bad_prices"),
        count(price < 0, "negative_prices"),
        count(keep, "rows_kept"),
    )
    return clean_events(seen, finite_only).observe(after, F.count(F.lit(1)).alias("rows_out")), before, after


def run_etl(spark: SparkSession, raw_dir: str, output_path: str, finite_only: bool = False) -> dict[str, int]:
    """Entry 1: discover, validate, clean and write; returns the counts that were observed
    while writing, without a second look at the data."""
    raw = read_raw_events(spark, raw_dir, with_source=True)
    events, before, after = observed_etl(raw, finite_only)
    save_processed_events(events, output_path)
    return {**before.get, **after.get}


def raw_text_from_events(ce: DataFrame) -> DataFrame:
    """Test adapter: canonical events back to raw text with injected faults.

    Every row is kept; by ``event_id`` some prices become '-1', 'abc', NULL,
    '1e3', ' x ' or 'x' + 'd' (a Java float suffix, not a number here) and some times 'bad', '<time> UTC', a month, a date and an hour, or a date, and some
    product ids 'x.7' or 'xe1'; the whole
    table is then appended to itself so every row has an exact duplicate.
    """
    k10 = F.pmod(F.col("event_id"), F.lit(10))
    k7 = F.pmod(F.col("event_id"), F.lit(7))
    price = F.col("price").cast("string")
    ts = F.col("event_time").cast("string")
    raw = ce.select(
        F.when(k7 == 0, F.lit("bad"))
        .when(k7 == 1, F.concat(ts, F.lit(" UTC")))
        .when(k7 == 2, F.substring(ts, 1, 7))  # a month
        .when(k7 == 3, F.substring(ts, 1, 13))  # a date and an hour
        .when(k7 == 4, F.substring(ts, 1, 10))  # a date
        .otherwise(ts)
        .alias("event_time"),
        "event_type",
        F.when(k7 == 5, F.concat(F.col("product_id").cast("string"), F.lit(".7")))
        .when(k7 == 6, F.concat(F.col("product_id").cast("string"), F.lit("e1")))
        .otherwise(F.col("product_id").cast("string"))
        .alias("product_id"),
        F.col("category_id").cast("string").alias("category_id"),
        "category_code",
        "brand",
        F.when(k10 == 0, F.lit("-1"))
        .when(k10 == 1, F.lit("abc"))
        .when(k10 == 2, F.lit(None).cast("string"))
        .when(k10 == 3, F.lit("1e3"))
        .when(k10 == 4, F.concat(F.lit(" "), price, F.lit(" ")))
        .when(k10 == 5, F.concat(price, F.lit("d")))
        .otherwise(price)
        .alias("price"),
        F.col("user_id").cast("string").alias("user_id"),
        "user_session",
    )
    return raw.unionByName(raw)
