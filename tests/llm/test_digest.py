import random

from cartflow.llm import digest
from cartflow.llm.common import table
from llm_help import SF_SMALL, make_docs, odd_pairs  # noqa: F401


def _check(pairs, got):
    """Rows in ascending doc_id (null first, ties by text): each meets its successor."""
    order = sorted(((i, t or "") for i, t in pairs), key=lambda p: (p[0] is not None, p[0] or 0, p[1].encode()))
    want = []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        one, two, three = (digest.digest(x.encode()) for x in (t, edited, after))
        want.append((i, len(t), t, edited, one.hex(), two.hex(), digest.likeness(one, two), digest.likeness(one, three)))
    key = lambda r: (str(r[0]), r[2], r[3])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    got = digest.fingerprints(docs).collect()
    _check([(r.doc_id, r.text) for r in docs.collect()], got)
    closer = sum(r.near_edited > r.near_next for r in got) / len(got)
    assert closer > 0.9


def test_odd_rows(make_docs, odd_pairs):
    _check(odd_pairs, digest.fingerprints(make_docs(odd_pairs)).collect())


def test_single_row_and_empty_table(make_docs):
    _check([(5, "abc def")], digest.fingerprints(make_docs([(5, "abc def")])).collect())
    _check([(None, None)], digest.fingerprints(make_docs([(None, None)])).collect())
    assert digest.fingerprints(make_docs([])).count() == 0


def test_difference_is_a_bounded_score():
    rnd = random.Random(3)
    text = lambda n: bytes(rnd.randrange(97, 123) for _ in range(n))
    marks = [digest.digest(text(n)) for n in (0, 1, 2, 3, 50, 500, 5000)]
    for a in marks:
        assert len(a) == 34 and digest.likeness(a, a) == 1.0
        for b in marks:
            assert 0 <= digest.difference(a, b) == digest.difference(b, a) <= digest.WORST
    base = text(4000)
    near = digest.digest(base[:3900] + text(100))
    assert digest.likeness(digest.digest(base), near) > digest.likeness(digest.digest(base), digest.digest(text(4000)))
