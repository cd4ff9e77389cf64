import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartflow.llm.common import Words, cut, held_out, list_array, powers, slices, small, window_hashes
from llm_help import words

TEXT = st.text(alphabet="ab Z\t\n\x0b\x0c\r\x1c  éÉß✓", max_size=60)


@given(st.lists(st.none() | TEXT, max_size=8))
@settings(max_examples=150, deadline=None)
def test_words_are_runs_without_ascii_white_space(texts):
    found = Words([None if t is None else t.encode() for t in texts])
    for i, text in enumerate(texts):
        own = range(found.first[i], found.first[i + 1])
        assert [found.bytes[found.start[k] : found.end[k]] for k in own] == words(text)
    seen = {}
    for k in range(len(found.hash)):
        word = found.bytes[found.start[k] : found.end[k]]
        assert seen.setdefault(word, found.hash[k]) == found.hash[k]
    assert len(set(seen.values())) == len(seen)


def test_hashes_do_not_depend_on_the_neighbours():
    long = b"x" * 300_000  # longer than a stretch
    alone, among = Words([b"abc", long]), Words([b"de abc", b"", b"fg " * 100_000 + b"abc " + long + b" hi"])
    at = [among.bytes[s:e] for s, e in zip(among.start, among.end, strict=True)]
    assert among.hash[at.index(b"abc")] == alone.hash[0] and among.hash[at.index(long)] == alone.hash[1]


def test_folding():
    one = Words(["ABC ÀÉÞ ×÷ ẞ".encode()], lower=True, latin=True)
    two = Words(["abc àéþ ×÷ ẞ".encode()], lower=True, latin=True)
    assert (one.hash == two.hash).all()
    assert Words("ÀÉ".encode().split(), lower=True).hash.tolist() != Words("àé".encode().split(), lower=True).hash.tolist()
    marked = Words([b"a,b  (c)"], separators=b",()")
    assert [marked.bytes[s:e] for s, e in zip(marked.start, marked.end, strict=True)] == [b"a", b"b", b"c"]


def test_window_hashes_tell_order_and_content():
    x = np.array([1, 2, 3, 1, 2, 3, 2, 1], np.uint64)
    h = window_hashes(x, 3)
    assert len(h) == 6 and h[0] == h[3] and len(set(h.tolist())) == 5
    assert len(window_hashes(x[:2], 3)) == 0
    assert powers(3, 4).tolist() == [1, 3, 9, 27]


@given(st.lists(st.none() | st.text(max_size=30), max_size=30), st.integers(1, 60))
@settings(max_examples=100, deadline=None)
def test_slices_keep_all_rows_in_order(texts, limit):
    batch = pa.record_batch({"id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    got, ids = [], []
    for part, own in slices([batch], "text", limit):
        assert part.num_rows == len(own) > 0
        assert len(own) == 1 or sum(len(t or b"") for t in own) <= limit
        got += own
        ids += part.column(0).to_pylist()
    assert got == [None if t is None else t.encode() for t in texts] and ids == list(range(len(texts)))


def test_list_array():
    made = list_array(np.arange(5), np.array([2, 0, 3]), pa.int64())
    assert made.to_pylist() == [[0, 1], [], [2, 3, 4]]


def test_held_out_fold(spark):
    got = {r.id: r.h for r in spark.range(-20, 400).select("id", held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in got}
    assert spark.range(1).select(held_out(F.lit(None).cast("long"))).first()[0] is False


def test_small_and_cut(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    df = spark.range(10)
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(small(df, 10)) and not hinted(small(df, 9))
    assert "Range" not in plan(cut(df.selectExpr("id + 1 AS x")))
