import collections
import random

from cartflow.llm import linededup
from cartflow.llm.common import table
from cartflow.llm.linededup import CuckooFilter, LineIndex, dedup_lines
from llm_help import SF_SMALL, make_docs, odd_pairs  # noqa: F401

SPACE = b" \t\n\x0b\x0c\r"


def _key(line):
    return line.encode().strip(SPACE).lower().decode()


def brute(pairs, present=None):
    """doc_id -> (lines, dropped, text), counting the documents of ``present``."""
    held = collections.defaultdict(set)
    for i, t in pairs if present is None else present:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(_key(line)) >= 20:
                    held[_key(line)].add(i)
    out = {}
    for i, t in pairs:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i is None or not (len(held.get(_key(x), ())) >= 3 and max(held[_key(x)]) != i)]
        out[i] = (len(lines), len(lines) - len(keep), "\n".join(keep))
    return out


def rows(df):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in df.collect()}


def _corpus(seed, first=0, n=60):
    rnd = random.Random(seed)
    pool = [f"a shared line number {i} of some length" for i in range(30)] + ["short", "", "ÄÖÜ äöü ßß éé çç êê ëë ññ"]
    case = lambda s: rnd.choice([s, s.upper(), f"  {s}\t"])
    return [
        (first + i, "\n".join(case(rnd.choice(pool)) if rnd.random() < 0.7 else f"own {seed} {i} {rnd.random()} line" for _ in range(rnd.randint(1, 9))))
        for i in range(n)
    ]


def test_against_brute_force(make_docs):
    pairs = _corpus(3)
    assert rows(dedup_lines(make_docs(pairs))) == brute(pairs)


def test_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    assert rows(dedup_lines(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(make_docs, odd_pairs):
    line = "the very same line in many documents"
    pairs = odd_pairs + [(200 + i, f"{line}\n{line}\nx") for i in range(5)] + [(None, line), (200, f"{line}\n{line}\nx")]
    got = dedup_lines(make_docs(pairs)).collect()
    assert len(got) == len(pairs)
    want = brute([p for p in pairs if p[0] is not None])
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in got if r.doc_id is not None} == want
    assert all(r.n_dropped == 0 for r in got if r.doc_id is None)


def test_empty_table(make_docs):
    assert dedup_lines(make_docs([])).count() == 0


def test_insertion_and_deletion_are_reversible(make_docs):
    one, two = _corpus(5), _corpus(6, first=100)
    index = LineIndex.build(make_docs(one))
    more = index.insert(make_docs(two + one[:3]))  # documents known already change nothing
    both = one + two
    assert rows(more.rewrite(make_docs(both))) == brute(both)
    less = more.delete(make_docs([(i, "") for i, _ in two] + [(999, "")]))
    assert rows(less.rewrite(make_docs(one))) == brute(one)
    as_rows = lambda df: sorted(map(tuple, df.collect()))
    assert as_rows(less.refs) == as_rows(index.refs)
    gone = [i for i, _ in one[:30]]
    last = less.delete(make_docs([(i, "") for i in gone]))
    assert rows(last.rewrite(make_docs(one[30:]))) == brute(one[30:])


def test_filters_grow_with_the_index(make_docs):
    """Twenty times the keys: shards are built anew, the stash stays under 1 % and few
    unknown keys pass."""
    lines = lambda first, n: [f"line number {k} that several documents hold" for k in range(first, first + n)]
    docs = lambda first, n: [(first + d, "\n".join(lines(first, n))) for d in range(3)]
    index = LineIndex.build(make_docs(docs(0, 60)), shards=2)
    before = {r.shard: r.room for r in index.filters.collect()}
    more, held = index, docs(0, 60)
    for first, n in ((1000, 300), (2000, 900)):
        held += docs(first, n)
        more = more.insert(make_docs(docs(first, n)))
    rnd = random.Random(3)
    found = more.filters.collect()
    assert len(found) == 2 and all(r.room > 4 * before[r.shard] for r in found)
    for r in found:
        own = CuckooFilter.from_bytes(bytes(r.body))
        keys = [bytes(x.key) for x in more.refs.where(f"shard = {r.shard}").collect()]
        assert own.maybe(keys).all() and len(own.table[own.table > 0]) + own.stash.total() == len(keys)
        assert own.stash.total() < 0.01 * len(keys) and len(keys) <= 0.9 * own.table.size
        assert own.maybe([rnd.randbytes(16) for _ in range(20_000)]).mean() < 0.001
    assert rows(more.rewrite(make_docs(held))) == brute(held)
    less = more.delete(make_docs([(i, "") for i, _ in held[3:]]))
    assert rows(less.rewrite(make_docs(held[:3]))) == brute(held[:3])


def test_known_id_with_another_text_adds_its_lines(make_docs):
    line = "a line that is long enough to count"
    index = LineIndex.build(make_docs([(1, line), (2, line), (3, "other")]))
    more = index.insert(make_docs([(3, line)]))
    assert more.refs.where("n_docs = 3").count() == 1
    assert rows(more.rewrite(make_docs([(1, line), (2, line), (3, line)]))) == {1: (1, 1, ""), 2: (1, 1, ""), 3: (1, 0, line)}


def test_shards_of_many_postings_are_probed_in_parts(make_docs, monkeypatch):
    monkeypatch.setattr(linededup, "PROBED", 5)
    pairs = _corpus(8) + [(500 + i, "the hot line that a third of all documents hold") for i in range(60)]
    assert rows(dedup_lines(make_docs(pairs))) == brute(pairs)


def test_stash_is_counted():
    own = CuckooFilter.sized(4)  # four buckets of four
    key = bytes(16)
    own.add([key] * 40)
    assert own.stash.total() + len(own.table[own.table > 0]) == 40 and own.stash.total() >= 32 and own.maybe([key]).all()
    own = CuckooFilter.from_bytes(own.to_bytes())
    own.remove([key] * 39)
    assert own.maybe([key]).all() and own.stash.total() + len(own.table[own.table > 0]) == 1
    own.remove([key])
    assert not own.maybe([key]).any()


def test_cuckoo_filter_has_no_false_negatives():
    rnd = random.Random(2)
    keys = [rnd.randbytes(16) for _ in range(3000)]
    own = CuckooFilter.sized(len(keys) // 2)  # overfull: the stash takes the rest
    own.add(keys)
    own = CuckooFilter.from_bytes(own.to_bytes())
    assert own.maybe(keys).all()
    own.remove(keys[:1500])
    assert own.maybe(keys[1500:]).all()
    small = CuckooFilter.sized(3000)
    small.add(keys)
    assert small.maybe([rnd.randbytes(16) for _ in range(5000)]).mean() < 0.01
    small.remove(keys)
    assert not small.table.any() and not small.stash
