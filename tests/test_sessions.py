import datetime as dt
import random

import pandas as pd
from pyspark.sql import types as T

from cartflow.operators.sessions import fct_sessions, session_keys, sessionize
from cartflow.plans import oracle
from cartflow.sources.adapters import load_commerce_events, untied_events
from duck import rows, run

SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)


def t(h, m, s=0):
    return dt.datetime(2020, 1, 1, h, m, s)


def frame(spark, data):
    full = [
        (i, tm, et, pid, pid, None, None, price, u, sess)
        for i, (u, tm, sess, et, pid, price) in enumerate(data)
    ]
    return spark.createDataFrame(full, SCHEMA)


FIXTURE = [
    # user, time, raw session, type, product, price
    (1, t(10, 0), None, "view", 1, 10.0),
    (1, t(10, 25), "s1", "view", 2, 5.0),
    (1, t(10, 50), None, "cart", 1, 10.0),
    (1, t(11, 20, 59), "  ", "view", 3, 7.0),
    (1, t(11, 51), None, "purchase", 3, 7.0),
    (2, t(9, 0), "s1", "view", 1, 1.0),
    (2, t(9, 5), "", "view", 1, 1.0),
    (None, t(8, 0), None, "view", 4, 2.0),
]


def test_fixture_session_ids(spark):
    out = sessionize(frame(spark, FIXTURE)).orderBy("event_id").select("session_id").collect()
    assert [r[0] for r in out] == [
        "derived_1_1", "s1", "derived_1_1", "derived_1_1", "derived_1_2",
        "s1", "derived_2_0", "derived__1",
    ]


def test_fixture_session_fact(spark):
    s = fct_sessions(sessionize(frame(spark, FIXTURE)))
    assert s.count() == 6
    r = s.where("session_id = 'derived_1_1' and user_id = 1").first()
    assert r["events_cnt"] == 3 and r["session_duration_minutes"] == 80


def _oracle_sessionized(pdf: pd.DataFrame) -> pd.DataFrame:
    sql = f"WITH {oracle.SESSIONIZED} SELECT event_id, source_session_id, " \
          "CAST(derived_session_start AS INTEGER) AS derived_session_start, session_id, " \
          "previous_event_time FROM sessionized"
    return run(sql, ce=pdf)


def _random_events(seed: int, n: int):
    rnd = random.Random(seed)
    base = dt.datetime(2020, 1, 1)
    data = []
    for i in range(n):
        user = rnd.choice([1, 2, 3, None])
        if rnd.random() < 0.15:
            tm = None
        else:
            tm = base + dt.timedelta(seconds=rnd.choice([0, 59, 60, 61, 1799, 1800, 1801, 1859,
                                                         1860, 1861, 3600]) * rnd.randint(0, 6)
                                     + rnd.randint(0, 3))
        sess = rnd.choice([None, "", "   ", "a", "b"])
        etype = rnd.choice(["view", "cart", "purchase", None])
        pid = rnd.choice([1, 2, None])
        data.append((i, tm, etype, pid, pid, None, None, 1.0, user, sess))
    return data


def test_random_against_duckdb(spark):
    for seed in range(6):
        data = _random_events(seed, 60)
        sdf = spark.createDataFrame(data, SCHEMA)
        got = sessionize(sdf, with_previous_time=True).select(
            "event_id", "source_session_id", "derived_session_start", "session_id",
            "previous_event_time")
        pdf = pd.DataFrame(data, columns=SCHEMA.fieldNames())
        pdf["event_time"] = pd.to_datetime(pdf["event_time"])
        for c in ("event_id", "product_id", "category_id", "user_id"):
            pdf[c] = pdf[c].astype("Int64")
        want = _oracle_sessionized(pdf)
        g = rows(got)
        w = [tuple(None if pd.isna(v) else (v.to_pydatetime() if hasattr(v, "to_pydatetime") else v)
                   for v in r) for r in want.itertuples(index=False)]
        w = sorted(w, key=lambda r: r[0])
        g = sorted(g, key=lambda r: r[0])
        assert g == w, f"seed {seed}"


def test_gap_parameter(spark):
    data = [(1, t(10, 0), None, "view", 1, 1.0), (1, t(12, 0), None, "view", 1, 1.0),
            (1, t(16, 0), None, "view", 1, 1.0)]
    ids = lambda g: [r[0] for r in sessionize(frame(spark, data), gap=g)
                     .orderBy("event_id").select("session_id").collect()]
    assert ids(30) == ["derived_1_1", "derived_1_2", "derived_1_3"]
    assert ids(180) == ["derived_1_1", "derived_1_1", "derived_1_2"]


def _untied(seed: int, n: int):
    """Distinct nine-column events with many tied and missing times."""
    rnd = random.Random(seed)
    base = dt.datetime(2020, 1, 1)
    rows = set()
    for _ in range(n):
        tm = None if rnd.random() < 0.25 else base + dt.timedelta(minutes=rnd.choice([0, 0, 20, 31, 62, 93, 124]))
        rows.add((tm, rnd.choice(["view", "cart", None]), rnd.choice([1, None]), rnd.choice([1, 2, None]), rnd.choice(["c", None]),
                  rnd.choice(["x", "y"]), rnd.choice([1.0, 2.0, None]), rnd.choice([1, 2, None]), rnd.choice([None, "", "a"])))
    return sorted(rows, key=str)


def test_total_order_without_event_id(spark):
    from cartflow.sources.schema import EVENT_SCHEMA

    order = ", ".join(f"{c} NULLS LAST" for c in ("event_type", "product_id", "category_id", "category_code", "brand", "price", "user_session"))
    names = EVENT_SCHEMA.fieldNames()
    columns = [*names, "source_session_id", "derived_session_start", "session_id", "previous_event_time"]
    for seed in range(5):
        data = _untied(seed, 80)
        got = sessionize(spark.createDataFrame(data, EVENT_SCHEMA), with_previous_time=True).select(*columns)
        pdf = pd.DataFrame(data, columns=names)
        pdf["event_time"] = pd.to_datetime(pdf["event_time"])
        for c in ("product_id", "category_id", "user_id"):
            pdf[c] = pdf[c].astype("Int64")
        want = run(f"WITH {oracle.sessionized(order)} SELECT {', '.join(columns)} FROM sessionized", ce=pdf)
        plain = lambda v: None if pd.isna(v) else v.to_pydatetime() if hasattr(v, "to_pydatetime") else v
        key = lambda r: tuple((v is None, str(v)) for v in r)
        w = sorted((tuple(plain(v) for v in r) for r in want.itertuples(index=False)), key=key)
        assert sorted(map(tuple, got.collect()), key=key) == w, f"seed {seed}"


def test_no_sort_based_minimum_in_the_plan(spark):
    fact = fct_sessions(sessionize(frame(spark, FIXTURE)))
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    assert "min(struct" not in plan and "min(named_struct" not in plan


def test_events_are_dealt_once(spark):
    """Plan: the stored events meet their block rows and the session groups without another
    exchange or sort of the events; only the block table moves."""
    shop = load_commerce_events(spark, "/root/testdata/sf0.001")
    rows = sessionize(shop)
    names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(n) for n in names]
    assert before[0] == "true"  # the checkpoint has put it back
    try:
        spark.conf.set(names[0], "false")
        spark.conf.set(names[1], "-1")
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.set(n, v)
    # By user for the window over the block table, by block for the join: none is left
    # for the events.
    assert plan.count("Exchange") == 2 and plan.count("Join") == 1 and "FileScan" not in plan
    assert plan.count("Exchange hashpartitioning(_user") == 2


def test_session_keys_are_those_of_the_events(spark):
    shop = untied_events(load_commerce_events(spark, "/root/testdata/sf0.001"))
    want = sessionize(shop).select("session_id", "user_id").distinct()
    got = session_keys(shop)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
