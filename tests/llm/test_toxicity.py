import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartflow.llm import toxicity
from cartflow.llm.common import held_out, table
from cartflow.llm.queries import op2_toxicity
from llm_help import make_docs, odd_pairs  # noqa: F401

BAD = ["vexoid", "grumbolt", "snarkle"]


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(7)
    plain = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(200)]
    pairs, toxic = [], []
    for i in range(900):
        own = [rnd.choice(plain) for _ in range(rnd.randint(5, 60))]
        bad = rnd.random() < 0.3
        if bad:
            for _ in range(2):
                own[rnd.randrange(len(own))] = rnd.choice(BAD)
        pairs.append((i, " ".join(own)))
        toxic.append((i, int(any(w in BAD for w in own))))
    return pairs, toxic


def test_held_out_accuracy(spark, make_docs, corpus):
    pairs, toxic = corpus
    docs = make_docs(pairs)
    labels = spark.createDataFrame(toxic, "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).withColumn("held", held_out(F.col("doc_id"))).collect()
    truth = dict(toxic)
    held = [r for r in got if r.held]
    assert 100 < len(held) < 260
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    # Labels of the held-out fold are never read.
    other = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.train(docs, other)
    assert again.bias == model.bias and (again.weight == model.weight).all()


def test_counts_cover_all_labelled_rows(spark, make_docs):
    pairs = [(i, f"text number {i % 5}") for i in range(50)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    rows = toxicity.training_rows(make_docs(pairs), labels)
    totals, counts = toxicity.feature_counts(rows)
    want = np.zeros_like(counts)
    for r in rows.collect():
        want[r.label, np.unique(toxicity.gram_features(r.text.encode()))] += 1
    assert (counts == want).all() and totals.sum() == rows.count()


def test_features_mark_repeats():
    once, twice = toxicity.gram_features(b"abcdef"), toxicity.gram_features(b"abcdef abcdef")
    half = 1 << (toxicity.BITS - 1)
    assert (once < half).all() and (twice >= half).any() and set(once) <= set(twice)
    assert len(toxicity.gram_features(None)) == len(toxicity.gram_features(b"")) == 0


def test_odd_rows(spark, make_docs, odd_pairs, corpus):
    pairs, toxic = corpus
    labels = spark.createDataFrame(toxic + [(None, 1), (3, None), (4, 1), (4, 0)], "doc_id long, toxic int")
    model = toxicity.train(make_docs(pairs + odd_pairs), labels)
    got = toxicity.score(make_docs(odd_pairs), model).collect()
    assert len(got) == len(odd_pairs) and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if not r.text}
    assert empty == {float(1 / (1 + np.exp(-model.bias)))}
    assert all(r.predicted == int(r.score >= 0.5) for r in got)


def test_without_labels_or_rows(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    docs = make_docs([(1, "a text")])
    assert toxicity.score(docs, toxicity.train(docs, labels)).first().predicted == 0
    only = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, toxic int")
    docs = make_docs([(i, "a text") for i in range(20)])
    assert {r.predicted for r in toxicity.score(docs, toxicity.train(docs, only)).collect()} == {1}
    assert toxicity.score(make_docs([]), toxicity.train(make_docs([]), labels)).count() == 0


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in op2_toxicity(spark, sf).collect()}
    marks = [(r.toxic, got[r.doc_id]) for r in table(spark, sf, "labels").collect() if got[r.doc_id].held_out]
    y, s = np.array([m for m, _ in marks]), np.array([r.score for _, r in marks])
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in s[y == 1] for n in s[y == 0]])
    assert auc > 0.95 and (y[s >= 0.5] == 1).mean() > 0.9
