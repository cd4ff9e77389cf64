"""Feature table against the paired-session SQL in DuckDB on random events with
NULL times and NULL users."""

import datetime as dt
import random

import pandas as pd

from cartflow.functions.labels import FEATURE_COLUMNS, TARGET_COLUMN
from cartflow.operators.features import session_features
from cartflow.operators.sessions import sessionize
from cartflow.plans import oracle
from duck import run
from test_sessions import SCHEMA


def _events(seed, n=150):
    rnd = random.Random(seed)
    base = dt.datetime(2020, 1, 4, 22, 0)
    rows = []
    for i in range(n):
        user = rnd.choice([1, 1, 1, 2, 3, None])  # user 1 is hot
        tm = None if rnd.random() < 0.1 else base + dt.timedelta(minutes=rnd.randint(0, 600))
        sess = rnd.choice([None, "", "a", "b", "c"])
        etype = rnd.choice(["view", "cart", "purchase", "signup"])
        pid = rnd.choice([1, 2, 3, None])
        rows.append((i, tm, etype, pid, pid, None, None, float(rnd.randint(1, 50)), user, sess))
    return rows


COLS = ["session_id", "user_id", "session_start", *FEATURE_COLUMNS, TARGET_COLUMN]


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime()
    if isinstance(v, float):
        return round(v, 9)
    return int(v) if hasattr(v, "__int__") and not isinstance(v, (str, dt.datetime)) else v


def test_features_random_against_duckdb(spark):
    for seed in range(4):
        data = _events(seed)
        got = session_features(sessionize(spark.createDataFrame(data, SCHEMA))).select(*COLS)
        pdf = pd.DataFrame(data, columns=SCHEMA.fieldNames())
        pdf["event_time"] = pd.to_datetime(pdf["event_time"])
        for c in ("event_id", "product_id", "category_id", "user_id"):
            pdf[c] = pdf[c].astype("Int64")
        sql = (f"WITH {oracle.SESSIONIZED}, {oracle.SESSIONS}, {oracle.FEATURES} "
               f"SELECT {', '.join(COLS)} FROM features")
        want = run(sql, ce=pdf)
        key = lambda r: (str(r[0]), str(r[1]))
        g = sorted((tuple(_norm(v) for v in r) for r in got.collect()), key=key)
        w = sorted((tuple(_norm(v) for v in r) for r in want.itertuples(index=False)), key=key)
        assert g == w, f"seed {seed}"
