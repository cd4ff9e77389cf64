"""Helpers of the operators' tests."""

import random
import re

import pytest

SF_SMALL = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall((text or "").encode())


SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "begins string, keys long, score string, `part` int, rest int"
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with extra columns of clashing names."""

    def make(pairs, lang="en", source="a"):
        rows = [(i, t, lang, source, None if t is None else len(t), "x", 1, None, 2, 3) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_pairs():
    """Nulls, empty and blank texts, a very long text, repeated rows, ties."""
    rnd = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    long = " ".join(rnd.choice(vocabulary) for _ in range(30_000))
    plain = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 120))) for _ in range(20)]
    pairs = [(i, t) for i, t in enumerate(plain)]
    pairs += [(100, None), (101, ""), (102, " \n\t "), (103, long), (104, long), (5, plain[5]), (105, plain[7].upper())]
    pairs += [(None, plain[3]), (None, None), (106, "É x  ünï"), (107, "one")]
    return pairs


def brute_components(pairs, width, percent):
    """doc_id -> (set size, smallest linked doc_id), by comparing all texts."""
    sets = {}
    for i, text in pairs:
        own = [w.lower() for w in words(text)]
        grams = {tuple(own[k : k + width]) for k in range(len(own) - width + 1)} if len(own) >= width else ({tuple(own)} if own else set())
        sets[i] = grams
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}
