import random

import pytest

import corpus_pipeline
from cartflow.llm import decontam
from llm_help import make_docs, odd_pairs  # noqa: F401


@pytest.fixture()
def tables(spark, tmp_path):
    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


def _corpus():
    rnd = random.Random(11)
    vocabulary = [f"v{i}" for i in range(2000)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    docs = {i: "\n".join(text(rnd.randint(8, 30)) for _ in range(4)) for i in range(300)}
    labels = {i: 0 for i in docs}
    for i in range(0, 300, 4):
        docs[i] += "\n" + " ".join(rnd.choice(["vexoid", "grumbolt", "snarkle"]) for _ in range(4)) + " " + text(5)
        labels[i] = 1
    items = {k: text(40) for k in range(5)}
    for k in items:
        docs[300 + k] = docs[1][:200] + text(20) + "\n" + items[k] + "\n" + text(30)
    line = "this line stands in very many documents"
    for i in range(400, 410):
        docs[i] = text(60) + "\n" + line
    base = text(150)
    for i in range(500, 520):
        docs[i] = base + " " + text(1)
    return docs, labels, items, line


def test_stages_take_effect(spark, tables):
    docs, labels, items, line = _corpus()
    rows = [(i, t, "en", "ab"[i % 2], len(t), f"x{i}") for i, t in docs.items()]
    sf = tables(
        documents=spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, sid string"),
        labels=spark.createDataFrame([(i, 1, t) for i, t in labels.items()], "doc_id long, quality int, toxic int"),
        benchmark=spark.createDataFrame(list(items.items()), "item_id long, text string"),
    )
    current = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, current, sf)
        out.write.parquet(f"{sf}/stage-{name}")
        before, current = current, spark.read.parquet(f"{sf}/stage-{name}")
        if name != "source_mixing":
            assert current.columns == before.columns
            assert all(r.sid == f"x{r.doc_id}" and r.n_chars == len(r.text) for r in current.collect())
        seen[name] = {r.doc_id: r for r in current.collect()}
    toxic = {i for i, t in labels.items() if t}
    assert set(seen["toxicity"]) == set(docs) - toxic
    lines = [i for i in seen["line_dedup"] if line in seen["line_dedup"][i].text]
    assert lines == [409] and set(seen["line_dedup"]) == set(seen["toxicity"])
    near = set(seen["minhash_near_dedup"])
    assert near == set(seen["line_dedup"]) - set(range(501, 520))
    clean = set(seen["benchmark_decontamination"])
    assert clean == near - set(range(300, 305))
    mixed = seen["source_mixing"]
    assert set(mixed) == clean and all(0 <= r.taken <= 2 * r["size"] for r in mixed.values())
    total = sum(r["size"] for r in mixed.values())
    assert abs(sum(r.taken for r in mixed.values()) - 1.5 * total) < 0.02 * total
    again = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixed.values()))


def test_odd_rows(spark, tables, make_docs, odd_pairs):
    sf = tables(
        labels=spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int"),
        benchmark=spark.createDataFrame([(1, None)], "item_id long, text string"),
    )
    for pairs in (odd_pairs, []):
        docs = make_docs(pairs)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            if name == "minhash_near_dedup":
                ids = [r.doc_id for r in out.collect() if r.doc_id is not None]
                assert len(ids) == len(set(ids)) and 104 not in ids
                assert sum(r.doc_id is None for r in out.collect()) == sum(i is None for i, _ in pairs)
            else:
                assert out.count() == len(pairs)


def test_decontamination_uses_the_operator(spark, make_docs):
    docs = make_docs([(1, "a b c d e f g h i j k l m n o p"), (2, "q r s t")])
    bench = spark.createDataFrame([(7, "a b c d e f g h i j k l m n o p")], "item_id long, text string")
    assert [r.doc_id for r in decontam.clean(docs, bench).collect()] == [2]


def test_near_dedup_keeps_unlike_texts_of_one_doc_id(spark, make_docs):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "xy")
    docs = make_docs([(1, a), (1, b), (1, a), (2, a + " z"), (None, a)])
    kept = corpus_pipeline.near_dedup_stage(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, a), (1, a), (1, b)]
