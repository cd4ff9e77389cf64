import math

import numpy as np
import pytest

from cartflow.llm import vectorcodes as vc
from cartflow.llm.common import table
from llm_help import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, ids int, trees string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", None, 1, "t") for i, v, label in rows], SCHEMA)


def nearest(points, book):
    """Index of the nearest entry and its squared distance, in Python integers."""
    out = []
    for p in points:
        far = [sum((int(a) - int(b)) ** 2 for a, b in zip(p, e, strict=True)) for e in book]
        out.append((far.index(min(far)), min(far)))
    return out


def brute(rows, parts=8, entries=16, rounds=6):
    """Rows as (vec_id, code, error, label_error) and the codebooks, by the definition."""
    fine = [(i, v, s) for i, v, s in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not fine:
        return [], None
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(fine[0][1]) // parts
    told = [[math.floor(4096 * float(np.float32(x))) for x in v] for _, v, _ in fine]
    books, codes, errors = [], [[] for _ in fine], [0] * len(fine)
    for part in range(parts):
        own = [v[part * width : (part + 1) * width] for v in told]
        book = [list(x) for x in own[:entries]]
        for _ in range(rounds):
            near = [e for e, _ in nearest(own, book)]
            for e in range(len(book)):
                mine = [x for x, k in zip(own, near, strict=True) if k == e]
                if mine:
                    book[e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
        for k, (e, d) in enumerate(nearest(own, book)):
            codes[k].append(f"{e:02x}")
            errors[k] += d
        books.append(book)
    by_label = {}
    for (_, _, s), e in zip(fine, errors, strict=True):
        by_label[s] = by_label.get(s, 0) + e
    return [(i, "".join(c), e, by_label[s]) for (i, _, s), c, e in zip(fine, codes, errors, strict=True)], books


def same(spark, rows, **how):
    got, books = vc.compress(frame(spark, rows), **how)
    want, told = brute(rows)
    assert sorted(map(str, map(tuple, got.select("vec_id", "code", "error", "label_error").collect()))) == sorted(map(str, want))
    assert told is None or books.tolist() == told
    return got, books


def test_embeddings(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, SF_SMALL, "embeddings").collect()]
    same(spark, rows)
    got, books = same(spark, rows, slice_rows=37)  # slices do not change the result
    one = got.orderBy("vec_id").first()
    near = vc.decode(one["code"], books)
    assert len(near) == 64 and abs(sum(((np.floor(np.array(rows[0][1]) * 4096) / 4096) - near) ** 2) * 4096**2 - one["error"]) < 1


def test_odd_rows(spark):
    rnd = np.random.default_rng(4)
    some = lambda: [float(np.float32(x)) for x in rnd.normal(size=16)]
    rows = [(i, some(), int(i % 3)) for i in range(60)]
    rows += [(100, None, 1), (101, [None] + some()[1:], 1), (102, [math.nan] + some()[1:], 1), (103, [math.inf] + some()[1:], None)]
    rows += [(104, some(), None), (None, some(), None), (3, rows[3][1], 0), (3, rows[3][1], 0), (105, [-0.0] * 16, 2)]
    same(spark, rows)


def test_copies_ties_and_few_rows(spark):
    """A third of the rows are one vector; entries tie and stay unused; fewer rows than entries."""
    hot = [0.5] * 8
    rows = [(i, hot, 1) for i in range(300)] + [(1000 + i, [float(i % 7 - 3)] * 4 + [0.25 * (i % 3)] * 4, i % 2) for i in range(600)]
    same(spark, rows, slice_rows=256)
    same(spark, [(i, [float(i), -1.0] + [0.0] * 6, None) for i in range(5)])
    same(spark, [(9, hot, None)])
    same(spark, [])
    same(spark, [(1, None, 1)])


def test_other_lengths_and_sizes(spark):
    rows = [(1, [1.0] * 8, 1), (2, [1.0] * 16, 1), (3, [], 2)]
    got = {r.vec_id: (r.code, r.error, r.label_error) for r in vc.compress(frame(spark, rows))[0].collect()}
    assert got == {1: ("00" * 8, 0, 0), 2: (None, None, 0), 3: (None, None, None)}
    with pytest.raises(ValueError, match="equal parts"):
        vc.compress(frame(spark, [(1, [1.0] * 9, 1)]))
    with pytest.raises(Exception, match="in size"):
        vc.compress(frame(spark, [(1, [40000.0] * 8, 1), (2, [1.0] * 8, 1)]))


def test_tree_covers_and_assigns_whole_subtrees():
    rnd = np.random.default_rng(7)
    centres = rnd.integers(-40_000, 40_000, (16, 8))
    points = np.unique(centres[rnd.integers(0, 16, 5000)] + rnd.integers(-900, 900, (5000, 8)), axis=0).astype(np.int32)
    counts = rnd.integers(1, 4, len(points))
    tree, place = vc.CoverTree.grow(points, counts)
    assert (tree.points[place] == points).all() and (tree.counts[place] == counts).all()
    for k in range(len(tree.lo)):
        own = tree.points[tree.lo[k] : tree.hi[k]].astype(float)
        assert np.sqrt(((own - own[0]) ** 2).sum(1)).max() <= tree.radius[k] + 1e-6
        if tree.width[k]:
            below = range(tree.child[k], tree.child[k] + tree.width[k])
            assert [tree.lo[j] for j in below] == [tree.lo[k], *[tree.hi[j] for j in below][:-1]] and tree.hi[below[-1]] == tree.hi[k]
            heads = np.array([tree.points[tree.lo[j]] for j in below], float)  # centres keep apart
            apart = np.sqrt(((heads[:, None] - heads[None]) ** 2).sum(-1)) + np.eye(len(heads)) * 1e12
            assert apart.min() > tree.radius[k] / 2 - 1e-6
            assert all(tree.radius[j] <= tree.radius[k] / 2 + 1e-6 for j in below)
    entries = centres.astype(np.int64)
    want = vc.squared(tree.points, entries).argmin(1)
    assert (tree.entry_of(entries) == want).all()
    told = tree.totals(entries)
    for e in range(16):
        assert told[e, 0] == tree.counts[want == e].sum()
        assert (told[e, 1:] == (tree.points[want == e].astype(np.int64) * tree.counts[want == e][:, None]).sum(0)).all()
    lo, hi, _, compared = tree.assign(entries)
    assert compared < len(points) / 10 and len(lo) < len(points) / 2  # most go as whole subtrees
