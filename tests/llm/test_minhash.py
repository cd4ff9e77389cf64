import random

import pytest

from cartflow.llm.common import components, table
from cartflow.llm.minhash import near_duplicates
from llm_help import SF_SMALL, brute_components, make_docs, odd_pairs  # noqa: F401


def _edited(rnd, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rnd.randrange(len(out))] = f"z{rnd.random()}"
    return " ".join(out)


@pytest.mark.parametrize("width", [4, 5])
def test_groups_of_edited_copies(make_docs, width):
    rnd = random.Random(width)
    pairs = []
    for g in range(6):
        base = [f"g{g}w{rnd.randrange(200)}" for _ in range(rnd.choice([30, 90, 150]))]
        pairs += [(len(pairs) + k, _edited(rnd, base, k % 6)) for k in range(14)]
    rnd.shuffle(pairs)
    want = brute_components(pairs, width, 80)
    got = near_duplicates(make_docs(pairs), width=width, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(make_docs, odd_pairs):
    got = near_duplicates(make_docs(odd_pairs), width=4).collect()
    assert len(got) == len(odd_pairs)
    named = [(i, t) for i, t in odd_pairs if i is not None]
    want = brute_components(named, 4, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)


def test_one_hot_group(make_docs):
    same = " ".join(f"a{i}" for i in range(50))
    pairs = [(i, same) for i in range(300)] + [(300 + i, f"{same} b{i} c{i}") for i in range(100)]
    got = near_duplicates(make_docs(pairs), width=4).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1


def test_empty_table(make_docs):
    assert near_duplicates(make_docs([])).count() == 0


def test_documents_against_all_pairs(spark):
    docs = table(spark, SF_SMALL, "documents")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    got = near_duplicates(docs, width=4, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(pairs, 4, 80)


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (300, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[100 + i] for i in range(60)} == {100}
    assert got[300] == got[200] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
