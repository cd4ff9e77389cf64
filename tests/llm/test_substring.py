import random

from pyspark.sql import functions as F

from cartflow.llm import substring
from cartflow.llm.common import Words, table, window_hashes
from cartflow.llm.substring import _Windows, crowded_cells, drop_repeats, sliding_min
from llm_help import SF_SMALL, make_docs, odd_pairs, words  # noqa: F401

import numpy as np


def brute(pairs, width):
    """doc_id -> (words, removed, kept text): windows seen at a smaller (doc_id, start)."""
    first = {}
    for i, t in pairs:
        own = words(t)
        for k in range(len(own) - width + 1):
            at = (1 << 62 if i is None else i, k)
            key = tuple(own[k : k + width])
            first[key] = min(first.get(key, at), at)
    out = {}
    for i, t in pairs:
        own = words(t)
        drop = set()
        for k in range(len(own) - width + 1):
            if first[tuple(own[k : k + width])] != (1 << 62 if i is None else i, k):
                drop.update(range(k, k + width))
        out[i] = (len(own), len(drop), b" ".join(w for k, w in enumerate(own) if k not in drop).decode())
    return out


def rows(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.text) for r in df.collect()}


def test_shared_passages(make_docs):
    rnd = random.Random(4)
    passages = [[f"p{rnd.randrange(50)}" for _ in range(rnd.randint(15, 70))] for _ in range(8)]
    pairs = []
    for i in range(80):
        own = []
        for _ in range(rnd.randint(0, 5)):
            own += rnd.choice(passages) if rnd.random() < 0.5 else [f"o{rnd.randrange(3000)}" for _ in range(rnd.randint(1, 40))]
        pairs.append((i, rnd.choice([" ", "\n", " \t"]).join(own)))
    rnd.shuffle(pairs)
    got = rows(drop_repeats(make_docs(pairs), width=20))
    assert got == brute(pairs, 20)
    assert rows(drop_repeats(make_docs(pairs), width=20, gram=3, buckets=3)) == got


def test_crowded_grams_are_passed_over(make_docs, spark):
    """A phrase that all texts hold, among other words each time."""
    rnd = random.Random(6)
    phrases = [f"released under the terms of licence {k} here" for k in range(500)]
    phrase = min(phrases, key=lambda t: window_hashes(Words([t.encode()]).hash, 4).min())  # a minimiser wherever it is
    pairs = [(i, f"{' '.join(f'a{rnd.randrange(10**6)}' for _ in range(30))} {phrase} {' '.join(f'b{rnd.randrange(10**6)}' for _ in range(30))}") for i in range(200)]
    pairs += [(300 + i, t) for i, t in pairs[::20]]
    docs = make_docs(pairs)
    crowded, buckets = crowded_cells(docs, 20, 4, 64)
    assert 0 < crowded.sum() <= 64 and buckets == 64
    plain = _Windows(Words([t.encode() for _, t in pairs]), 20, 4)
    spread = _Windows(Words([t.encode() for _, t in pairs]), 20, 4, crowded)
    top = lambda w: np.unique(w.key[w.heads()], return_counts=True)[1].max()
    assert top(plain) > 150 and top(spread) < top(plain) / 2
    assert rows(drop_repeats(docs, width=20)) == brute(pairs, 20)


def test_periodic_text_and_hot_copies(make_docs):
    same = " ".join(f"a{i % 7}" for i in range(200))
    pairs = [(i, same) for i in range(40)] + [(50, "x " * 100)]
    assert rows(drop_repeats(make_docs(pairs), width=20)) == brute(pairs, 20)


def test_windows_of_crowded_grams_only(make_docs, monkeypatch):
    """Where all grams are crowded, windows go alone, each by the hash of its words; more
    buckets are taken where they would be large."""
    rnd = random.Random(9)
    passage = " ".join(f"p{k}" for k in range(60))
    pairs = [(i, f"a{i} {passage} " + " ".join(f"b{rnd.randrange(10**6)}" for _ in range(8))) for i in range(120)]
    docs = make_docs(pairs)
    every = np.ones(substring.CELLS, bool)
    lone = _Windows(Words([passage.encode()] * 2), 20, 4, every)
    assert len(lone.heads()) == 82 and len(np.unique(lone.key)) == 41
    with monkeypatch.context() as patch:
        patch.setattr(substring, "crowded_cells", lambda *_, **__: (every, 16))
        assert rows(drop_repeats(docs, width=20)) == brute(pairs, 20)
    monkeypatch.setattr(substring, "BUCKET_RUNS", 2)
    assert crowded_cells(docs, 20, 4, 4)[1] > 100 and crowded_cells(docs, 20, 4, 4, fixed=True)[1] == 4
    assert rows(drop_repeats(docs, width=20)) == brute(pairs, 20)


def test_rows_without_id_and_of_one_id_are_documents(spark, make_docs):
    """Unlike texts under no id, or under one id, keep what occurs there only; equal ones
    are one document.  They come in the order of the hash of their text."""
    rnd = random.Random(12)
    word = lambda: f"w{rnd.randrange(10**6)}"
    lead, own = " ".join(word() for _ in range(30)), lambda n: " ".join(word() for _ in range(n))
    pairs = [(1, f"{lead} {own(9)}"), (None, f"{lead} {own(40)}"), (None, own(70)), (None, None), (5, f"{own(25)} {lead}"), (5, own(80))]
    pairs += [(None, pairs[2][1]), (5, pairs[5][1]), (6, f"{pairs[5][1]} end"), (None, f"{own(3)} {pairs[2][1]}")]
    docs = make_docs(pairs)
    number = {r.text: r.h for r in docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    # As documents with an id of their own, in the order that is defined.
    order = sorted({(i is None, i or 0, number[t], t) for i, t in pairs}, key=lambda x: x[:3])
    as_one = brute([(k, t) for k, (*_, t) in enumerate(order)], 20)
    want = {(None if none else i, t or ""): as_one[k] for k, (none, i, _, t) in enumerate(order)}
    got = drop_repeats(docs, width=20).collect()
    told = sorted((str(r.doc_id), r.n_words, r.n_removed, r.text) for r in got)
    assert told == sorted((str(i), *want[i, t or ""]) for i, t in pairs)
    assert sum(r.n_removed for r in got if r.doc_id is None) in (100, 170)  # lead, and one copy of the long text


def test_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    assert rows(drop_repeats(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()], 20)


def test_odd_rows(make_docs, odd_pairs):
    got = drop_repeats(make_docs(odd_pairs), width=20).collect()
    assert len(got) == len(odd_pairs)
    one = [p for p in odd_pairs if p[0] is not None]
    want = brute(one, 20)
    assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in got if r.doc_id is not None} == want


def test_empty_table(make_docs):
    assert drop_repeats(make_docs([])).count() == 0


def test_sliding_min():
    x = np.random.default_rng(0).integers(0, 1000, 200).astype(np.uint64)
    for width in (1, 2, 3, 7, 16, 17):
        assert sliding_min(x, width).tolist() == [int(x[i : i + width].min()) for i in range(len(x) - width + 1)]
