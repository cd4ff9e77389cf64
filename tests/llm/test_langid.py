import random

import numpy as np
from pyspark.sql import functions as F

from cartflow.llm import langid
from cartflow.llm.common import held_out
from cartflow.llm.queries import op8_language
from llm_help import SF_SMALL, make_docs, odd_pairs  # noqa: F401


def _texts(seed, n=240):
    rnd = random.Random(seed)
    kinds = {"aa": ["the", "and", "ing", "tion"], "bb": ["der", "sch", "ung", "ß"], "cc": ["qué", "ción", "ñ", "el"]}
    rows = []
    for i in range(n):
        lang = rnd.choice(list(kinds))
        rows.append((i, " ".join("".join(rnd.choice(kinds[lang]) for _ in range(2)) for _ in range(rnd.randint(3, 200))), lang))
    return rows


def test_held_out_accuracy(spark):
    docs = spark.createDataFrame(_texts(1), "doc_id long, text string, lang string")
    net = langid.train(docs)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = langid.identify(docs, net).withColumn("held", held_out(F.col("doc_id"))).collect()
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.held]) > 0.97
    # Languages of the held-out fold are never read.
    other = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    again = langid.train(other)
    assert again.languages == net.languages and (again.dense == net.dense).all()


def test_tables_equal_the_convolution():
    rows = _texts(2, 60)
    net = langid.fit([t.encode()[: langid.WINDOW] for _, t, _ in rows], [x for _, _, x in rows], epochs=1)
    windows = np.concatenate([langid.window_rows(t.encode()) for _, t, _ in rows])
    e = net.embed[windows]
    pooled = []
    for w, bank, bias in zip(langid.WIDTHS, net.banks, net.bias, strict=True):
        out = np.stack([e[:, t : t + w].reshape(len(e), -1) @ bank for t in range(langid.WINDOW - w + 1)], axis=1)
        pooled.append(np.maximum(out.max(axis=1) + bias, 0))
    z = np.concatenate(pooled, axis=1) @ net.dense + net.offset
    z = np.exp(z - z.max(axis=1, keepdims=True))
    assert np.allclose(net.probabilities(windows, net.tables()), z / z.sum(axis=1, keepdims=True), atol=1e-4)


def test_whole_texts_count(spark):
    docs = spark.createDataFrame(_texts(3), "doc_id long, text string, lang string")
    net = langid.train(docs)
    mixed = "the ingand tion " * 20 + "derung schder " * 200  # the first window misleads
    got = langid.identify(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), net).first()
    assert got.lang_pred == "bb"


def test_odd_rows(spark, make_docs, odd_pairs):
    rows = [(i, t, None if k % 5 == 0 else "xy"[k % 2]) for k, (i, t) in enumerate(odd_pairs)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    got = langid.identify(docs, langid.train(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.lang_pred in ("x", "y", "und")
    no_letter = make_docs([(1, None), (2, ""), (3, "12 34 !?"), (4, "\n")])
    assert {(r.lang_pred, r.score) for r in langid.identify(no_letter, langid.train(docs)).collect()} == {("und", 0.0)}


def test_nothing_or_one_language_to_learn(spark, make_docs):
    none = make_docs([(1, "a text")], lang=None)
    assert langid.train(none) is None
    assert langid.identify(none, None).first().lang_pred == "und"
    assert langid.identify(make_docs([]), None).count() == 0
    one = make_docs([(i, f"a text {i}") for i in range(30)], lang="en")
    got = langid.identify(one, langid.train(one)).collect()
    assert {r.lang_pred for r in got} == {"en"} and all(r.score > 0.99 for r in got)


def test_query_on_held_out_documents(spark):
    got = op8_language(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.held_out]) > 0.97
    assert op8_language(spark, SF_SMALL).count() == 200


def _scripts(seed, each=40):
    """Made-up languages in several scripts, two of them in each."""
    rnd = random.Random(seed)
    starts = {"latin": 0x61, "greek": 0x3B1, "cyrillic": 0x430, "hebrew": 0x5D0, "devanagari": 0x915, "hangul": 0xAC00}
    rows, names = [], []
    for script, start in starts.items():
        for k in range(2):
            letters = [chr(start + c) for c in rnd.sample(range(22), 12)]
            stems = ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 4))) for _ in range(25)]
            names.append(f"{script}{k}")
            for _ in range(each):
                rows.append((len(rows), " ".join(rnd.choice(stems) + rnd.choice(stems) for _ in range(rnd.randint(5, 60))), names[-1]))
    return rows, names


def test_scripts_and_more_languages_than_the_sample(spark):
    rows, names = _scripts(8)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    truth = {i: lang for i, _, lang in rows}

    def accuracy(net):
        got = langid.identify(docs, net).withColumn("held", held_out(F.col("doc_id"))).collect()
        return np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.held])

    net = langid.train(docs)
    assert net.languages == sorted(names) and accuracy(net) > 0.9
    few = langid.train(docs, sample_windows=12)  # one window a language: the sample grows with the languages
    assert few.languages == sorted(names)


def test_every_byte_is_told_apart():
    rows = langid.window_rows(bytes(range(256)))
    assert rows.shape == (1, 256) and rows[0].tolist() == list(range(1, 257))
    assert langid.window_rows(b"")[0].tolist() == [0] * 256
