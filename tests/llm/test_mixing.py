import collections
import random

import pytest

from cartflow.llm import mixing
from cartflow.llm.common import table
from llm_help import SF_SMALL, odd_pairs, words  # noqa: F401


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Water filling by rounds: full sources leave, the excess goes to the rest."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        rate = left / total if total else 0.0
        new = {s for s in names if s not in full and rate * weight[s] > most * sizes[s]}
        if not new:
            return {s: most * sizes[s] if s in full else rate * weight[s] for s in names}
        full |= new


def _check(pairs, got, near=0.02):
    sizes = collections.Counter()
    for _, source, text in pairs:
        sizes[source] += len(words(text))
    want = targets(sizes)
    by_id = collections.defaultdict(list)
    for i, source, text in pairs:
        by_id[i].append((source, len(words(text))))
    taken = collections.Counter()
    assert len(got) == len(pairs)
    for r in got:
        source = next(s for s, n in by_id[r.doc_id] if n == r["size"] and sizes[s] == r.source_size)
        assert abs(r.target - want[source]) <= 1e-6 * max(1, want[source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1 + near * t


@pytest.fixture()
def frame(spark):
    def make(rows):
        return spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, text string, sid int, at int")

    return make


def test_targets_and_taken(frame):
    rnd = random.Random(2)
    pairs = [(i, rnd.choice("ABCDEFG") * 2 if i % 3 else "AA", "w " * rnd.choice([0, 1, 5, 300])) for i in range(400)]
    docs = frame(pairs)
    one, two = mixing.taken(docs).collect(), mixing.taken(docs.repartition(5)).collect()
    _check(pairs, one)
    key = lambda r: (r.doc_id, r["size"])
    assert sorted(one, key=key) == sorted(two, key=key)


def test_pieces_are_the_mix(frame):
    pairs = [(i, "ABC"[i % 3], "w " * (i % 50)) for i in range(300)]
    placed, pieces = mixing.mix_documents(frame(pairs), block=64)
    by_slot = collections.defaultdict(list)
    total = collections.Counter()
    for p in pieces.collect():
        by_slot[p.t].append(p)
        total[p.doc_id] += p.words
        assert 0 <= p["first"] < p["first"] + p.words <= p["size"]
    assert sorted(by_slot) == list(range(len(by_slot)))
    sums = {t: sum(p.words for p in ps) for t, ps in by_slot.items()}
    assert max(sums.values()) - min(sums.values()) <= 4  # equal blocks
    # Low discrepancy: any stretch of slots has each source about in proportion.
    order = [by_slot[t][0].sid for t in sorted(by_slot)]
    for sid in set(order):
        share = order.count(sid) / len(order)
        for a in range(0, len(order) - 40, 7):
            assert abs(order[a : a + 40].count(sid) - 40 * share) <= 4
    assert {r.doc_id: r.taken for r in mixing.taken(frame(pairs), block=64).collect() if r.taken} == dict(total)


def test_odd_rows(frame, odd_pairs):
    pairs = [(i, (None, "b", "ä", "Z")[k % 4], t) for k, (i, t) in enumerate(odd_pairs)]
    _check(pairs, mixing.taken(frame(pairs)).collect())


def test_nothing_to_mix(frame):
    assert mixing.taken(frame([])).count() == 0
    got = mixing.taken(frame([(1, "a", None), (2, "b", "  ")])).collect()
    assert {(r.doc_id, r["size"], r.taken, r.target) for r in got} == {(1, 0, 0, 0.0), (2, 0, 0, 0.0)}


def test_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    _check([(r.doc_id, r.source, r.text) for r in docs.collect()], mixing.taken(docs).collect())
