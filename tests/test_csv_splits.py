"""Large CSV files in many splits: the same rows as one reader gives, wherever the cuts fall."""

import random

import pytest
from pyspark.sql import functions as F

from cartflow.sources import csv_splits, raw

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"


def _field(rnd):
    kind = rnd.random()
    if kind < 0.3:
        return '"' + rnd.choice(["two\nlines", 'a ""quoted"" word', "a, comma", "\n", "ends\r\n here", ""]) + '"'
    return rnd.choice(["plain", "", "é ü", "x y", "12.5", "-"])


def _lines(rnd, n, end="\n"):
    rows = []
    for k in range(n):
        fields = [f"2024-01-0{k % 9 + 1} 10:00:00", "view", str(k), *[_field(rnd) for _ in range(5)], f"s{k}"]
        if k % 23 == 7:
            fields = fields[:6]
        if k % 29 == 11:
            fields += ["more", "fields"]
        rows.append(",".join(fields))
        if k % 31 == 3:
            rows.append("")  # an empty line
    return HEADER + end + end.join(rows) + (end if rnd.random() < 0.5 else "")


@pytest.fixture()
def folder(tmp_path):
    rnd = random.Random(11)
    for name, n, end in (("a", 400, "\n"), ("b", 3, "\n"), ("c", 150, "\r\n"), ("d", 0, "\n")):
        with open(tmp_path / f"{name}.csv", "w", encoding="utf-8", newline="") as f:
            f.write(_lines(rnd, n, end))
    other = ",".join(reversed(HEADER.split(",")))
    with open(tmp_path / "e.csv", "w", encoding="utf-8", newline="") as f:
        f.write(other + ",extra\n" + "\n".join(f's{k},1,"9\n9",b,c,2,{k},view,2024-02-01 00:00:00,x' for k in range(40)))
    return str(tmp_path)


def _rows(df):
    """Rows in an order; the text of a malformed row without carriage returns."""
    short = F.element_at(F.split(raw.SOURCE, "/"), -1)
    text = F.regexp_replace(raw.MALFORMED, "\r\n", "\n")
    return sorted(map(str, df.withColumns({raw.SOURCE: short, raw.MALFORMED: text}).collect()))


@pytest.mark.parametrize("block", [1, 7, 100, 1500, 40_000])
def test_rows_equal_those_of_one_reader(spark, folder, block):
    whole = raw.read_raw_events(spark, folder, with_source=True)
    split = raw.read_raw_events(spark, folder, with_source=True, block_bytes=block)
    assert _rows(split.select(*whole.columns)) == _rows(whole)
    assert raw.read_raw_events(spark, folder, block_bytes=block).columns == raw.read_raw_events(spark, folder).columns


def test_a_file_is_many_splits(spark, folder, monkeypatch):
    monkeypatch.setattr(csv_splits, "PIECE_BYTES", 64)  # records and quotes also lie across pieces
    files = csv_splits.sizes(spark, [f"{folder}/a.csv"])
    found = sorted(map(tuple, csv_splits.ranges(spark, files, 1000).select("begin", "end").collect()))
    assert len(found) > 10 and found[0][0] == 0 and found[-1][1] == files.first()["length"]
    assert all(a[1] == b[0] for a, b in zip(found, found[1:], strict=False))
    with open(f"{folder}/a.csv", "rb") as f:
        data = f.read()
    assert all(data[begin - 1 : begin] in (b"", b"\n") and data[:begin].count(b'"') % 2 == 0 for begin, _ in found)
    whole = raw.read_raw_events(spark, [f"{folder}/a.csv"], with_source=True)
    split = raw.read_raw_events(spark, [f"{folder}/a.csv"], with_source=True, block_bytes=1000)
    assert _rows(split) == _rows(whole)


def test_quotes_that_do_not_match(spark, tmp_path):
    """What follows the last open quote is one record, as it is to one reader."""
    body = "\n".join(f"2024-01-01 00:00:00,view,{k},1,c,b,1.0,1,s" for k in range(50))
    path = tmp_path / "x.csv"
    path.write_text(f'{HEADER}\n{body}\n2024-01-01 00:00:00,view,99,1,"open,b,1.0,1,s\n{body}')
    records = csv_splits.records(spark, csv_splits.sizes(spark, [str(path)]), 300).collect()
    assert len(records) == 51 and max(len(r.record) for r in records) > len(body)


def test_malformed_rows_are_counted_by_file(spark, folder):
    for block in (500, 1 << 20):
        told = raw.malformed_by_file(raw.read_raw_events(spark, folder, with_source=True, block_bytes=block)).collect()
        got = {r[raw.SOURCE].rsplit("/", 1)[-1]: (r.rows_cnt, r.malformed_cnt) for r in told}
        bad = lambda n: sum(k % 23 == 7 or k % 29 == 11 for k in range(n))
        assert got == {"a.csv": (400, bad(400)), "b.csv": (3, 0), "c.csv": (150, bad(150)), "e.csv": (40, 0)}


def test_etl_counts_without_a_second_look(spark, folder, tmp_path):
    out = str(tmp_path / "clean.parquet")
    counts = raw.run_etl(spark, folder, out)
    every = raw.read_raw_events(spark, folder)
    assert counts["rows_in"] == every.count() == 593
    assert counts["malformed_rows"] == sum(k % 23 == 7 or k % 29 == 11 for n in (400, 150) for k in range(n))
    profile = raw.event_quality(every).first()
    assert (counts["bad_times"], counts["bad_prices"], counts["negative_prices"]) == (
        profile.bad_time_cnt, profile.bad_price_cnt, profile.negative_price_cnt)
    kept = spark.read.parquet(out)
    assert counts["rows_out"] == kept.count() == raw.clean_events(every).count() <= counts["rows_kept"]
