import hashlib
import random
import zlib

import pytest

from cartflow.llm import merkle
from cartflow.llm.common import table
from llm_help import SF_SMALL, make_docs, odd_pairs  # noqa: F401


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def grow(nodes, fanout):
    """All levels of a tree over digests, by the definition."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + fanout]) for i in range(0, len(last), fanout)])
    return levels


def path(levels, i, fanout):
    steps = []
    for level in levels[:-1]:
        first = i - i % fanout
        run = level[first : first + fanout]
        steps.append(("".join(run[: i - first]), "".join(run[i - first + 1 :])))
        i //= fanout
    return steps


def brute(rows, fanout=2):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of all rows."""
    groups = {}
    for r in rows:
        values = [r[c] for c in merkle.FIELDS]
        struck = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
        other = [v + 1 if c == "n_chars" and v is not None else v for c, v in zip(merkle.FIELDS, values, strict=True)]
        leaf = h(*map(field, values))
        groups.setdefault(r["lang"], []).append((r["doc_id"], leaf, h(*map(field, other)) if struck else leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        trees[g] = grow([x[1] for x in groups[g]], fanout)
    forest = grow([trees[g][-1][0] for g in order], fanout) if order else []
    out = []
    for k, g in enumerate(order):
        for i, (doc, leaf, told) in enumerate(groups[g]):
            steps = path(trees[g], i, fanout) + path(forest, k, fanout)
            folded = told
            for b, a in steps:
                folded = h(b, folded, a)
            root = forest[-1][0]
            out.append((doc, leaf, trees[g][-1][0], root, h(*[b + a for b, a in steps]), folded, folded == root))
    return out


def found(docs, **how):
    rows = merkle.verified(merkle.manifest(docs, **how)).collect()
    return [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in rows]


def same(docs, **how):
    want = brute([r.asDict() for r in docs.collect()], how.get("fanout", 2))
    assert sorted(map(str, found(docs, **how))) == sorted(map(str, want))


def test_documents_in_one_tier(spark):
    docs = table(spark, SF_SMALL, "documents")
    same(docs)
    got = found(docs)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 4


@pytest.mark.parametrize(("fanout", "levels"), [(2, 1), (2, 3), (3, 2), (5, 1)])
def test_many_tiers(spark, fanout, levels):
    """Small blocks: paths run through several tiers, with lone last nodes."""
    rnd = random.Random(fanout)
    rows = [(i, "t" * (i % 5), rnd.choice(["en", "de", None, "", "fr", "é"]), None if i % 9 == 0 else "s", i % 11) for i in range(333)]
    same(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), fanout=fanout, levels=levels)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9])
def test_sizes_about_a_block(make_docs, n):
    same(make_docs([(i, str(i)) for i in range(n)]), levels=2)


def test_odd_rows(make_docs, odd_pairs):
    same(make_docs(odd_pairs))
    same(make_docs([(None, None)]))
    same(make_docs([(1, "a"), (1, "b"), (1, "a"), (1, "a")], lang=None), levels=1)
    assert found(make_docs([])) == []


def test_hot_group_of_equal_rows(make_docs):
    """A third of the rows are one row repeated; the others share its lang."""
    same(make_docs([(7, "same")] * 100 + [(i, str(i)) for i in range(200)]), levels=3)


def test_extreme_count(spark):
    struck = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 0)
    rows = [(struck, None, None, None, 2**63 - 1), (101, None, "x", None, None)]
    same(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_sweeps_agree_with_the_definition():
    for n in range(1, 40):
        nodes = [h(str(i)) for i in range(n)]
        made = merkle.climb(nodes, 3, 99, True)
        assert made == grow(nodes, 3)
        assert [list(p) for p in merkle.descend(made, 3, ())] == [path(made, i, 3) for i in range(n)]
    with pytest.raises(ValueError, match="fanout"):
        merkle.tree(None, "a", "b", fanout=1)
