"""Raw CSV ETL on files written by the test (two headers, dirty values)."""

import math
import os
import tempfile

import pytest

from cartflow.sources import raw

HEADER_A = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"
HEADER_B = "user_session,user_id,price,brand,category_code,category_id,product_id,event_type,event_time,extra"


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


@pytest.fixture()
def raw_dir():
    d = tempfile.mkdtemp(prefix="cartflow-etl-")
    _write(os.path.join(d, "a.csv"), [
        HEADER_A,
        "2019-10-01 00:00:00 UTC,view,1,10,beauty,brand_a,12.5,100,session_a",
        "2019-10-01 00:00:00 UTC,view,1,10,beauty,brand_a,12.5,100,session_a",
        "2019-10-01 00:01:00 UTC,cart,2,20,beauty,brand_b,-1,200,session_b",
        "bad,view,3,30,,brand_c,abc,300,",
        "2019-10-01 00:02:00,view,4,40,,brand_d,,400,x",
        "2019-10-01 00:03:00,view,5,50,,brand_e,nan,500,x",
    ])
    _write(os.path.join(d, "b.csv"), [
        HEADER_B,
        "session_z,900,1e3,brand_z,home,90,9,purchase,2019-10-02 10:00:00 UTC,junk",
        "session_y,901,1_000,brand_y,home,91,8,view,bad,junk",
    ])
    _write(os.path.join(d, "notes.txt"), ["not a csv"])
    return d


def test_find_raw_files(spark, raw_dir):
    files = raw.find_raw_files(spark, raw_dir)
    assert [f.rsplit("/", 1)[-1] for f in files] == ["a.csv", "b.csv"]


def test_union_by_name_and_clean(spark, raw_dir):
    events = raw.clean_events(raw.read_raw_events(spark, raw_dir))
    rows = {(r["user_id"], r["price"]) for r in events.collect() if not (r["price"] != r["price"])}
    # duplicate collapsed, -1 / abc / empty dropped, 1e3 and 1_000 parsed, columns matched by name
    assert rows == {(100, 12.5), (900, 1000.0), (901, 1000.0)}
    nan_rows = [r for r in events.collect() if r["price"] is not None and math.isnan(r["price"])]
    assert len(nan_rows) == 1  # 'nan' passes price >= 0 as in SQL
    z = [r for r in events.collect() if r["user_id"] == 900][0]
    assert z["event_time"].isoformat() == "2019-10-02T10:00:00" and z["brand"] == "brand_z"
    y = [r for r in events.collect() if r["user_id"] == 901][0]
    assert y["event_time"] is None


def test_finite_only(spark, raw_dir):
    events = raw.clean_events(raw.read_raw_events(spark, raw_dir), finite_only=True)
    assert all(r["price"] == r["price"] for r in events.collect())


def test_missing_column_error(spark):
    d = tempfile.mkdtemp(prefix="cartflow-etl-")
    _write(os.path.join(d, "bad.csv"), ["event_time,event_type", "x,y"])
    with pytest.raises(ValueError, match="bad.csv lacks brand, category_code, category_id"):
        raw.read_raw_events(spark, d)


def test_no_files_error(spark):
    d = tempfile.mkdtemp(prefix="cartflow-etl-")
    with pytest.raises(FileNotFoundError):
        raw.read_raw_events(spark, d)


def test_parquet_roundtrip(spark, raw_dir):
    out = os.path.join(tempfile.mkdtemp(prefix="cartflow-etl-out-"), "events_clean.parquet")
    raw.run_etl(spark, raw_dir, out)
    back = spark.read.parquet(out)
    assert back.count() == 4
    assert back.schema["event_time"].dataType.typeName() == "timestamp_ntz"


def test_quoted_newlines_and_many_files(spark):
    d = tempfile.mkdtemp(prefix="cartflow-etl-")
    for k in range(70):  # more files than are looked at from the driver
        header, row = HEADER_A, f"2019-10-01 00:{k % 60:02d}:00,view,1,10,c,\"two\nlines {k}\",1.5,{k},s"
        if k % 2:
            header, row = HEADER_B, f"s,{k},1.5,\"two\nlines {k}\",c,10,1,view,2019-10-01 00:{k % 60:02d}:00,j"
        _write(os.path.join(d, f"f{k:03d}.csv"), [header, row])
    headers = raw.read_headers(spark, raw.find_raw_files(spark, d))
    assert len(headers) == 70 and {len(h) for h in headers.values()} == {9, 10}
    events = raw.clean_events(raw.read_raw_events(spark, d)).collect()
    assert {(r["user_id"], r["brand"]) for r in events} == {(k, f"two\nlines {k}") for k in range(70)}


@pytest.mark.parametrize(("text", "want"), [
    ("2019-10-01", "2019-10-01T00:00:00"), ("2019-10-01 10:20", "2019-10-01T10:20:00"), (" 2019-10-01T10:20:30.5 ", "2019-10-01T10:20:30.500000"),
    ("2019", None), ("2019-10", None), ("2019-10-01 10", None), ("epoch", None), ("infinity", None), ("", None),
])
def test_time_grammar(spark, text, want):
    from pyspark.sql import functions as F

    got = spark.range(1).select(raw.parse_time(F.lit(text))).first()[0]
    assert (got.isoformat() if got else None) == want


@pytest.mark.parametrize(("text", "want"), [("12", 12), ("12.7", 13), ("-12.5", -13), ("1e3", 1000), ("1_000", 1000), ("x", None), ("", None), ("9223372036854775807", 2**63 - 1)])
def test_id_grammar(spark, text, want):
    from pyspark.sql import functions as F

    assert spark.range(1).select(raw.parse_id(F.lit(text))).first()[0] == want
