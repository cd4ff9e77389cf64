import random

import numpy as np

from cartflow.llm import decontam
from cartflow.llm.common import table
from llm_help import make_docs, odd_pairs  # noqa: F401


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def test_lcs_against_the_plain_recurrence():
    rng = np.random.default_rng(2)
    for _ in range(20):
        item = rng.integers(0, 9, rng.integers(1, 20)).astype(np.uint64)
        rows = rng.integers(0, 9, (5, 30)).astype(np.uint64)
        assert decontam.common_lengths(item, rows).tolist() == [_lcs(item.tolist(), r.tolist()) for r in rows]


def test_latent_space_against_a_direct_svd(make_docs):
    rnd = random.Random(3)
    topics = [[f"t{k}w{i}" for i in range(12)] for k in range(6)]
    pairs = [(i, " ".join(rnd.choice(topics[i % 6]) for _ in range(64))) for i in range(120)]
    docs = make_docs(pairs)
    idf = decontam.inverse_frequencies(docs)
    space = decontam.latent_space(docs, idf)
    rows = np.zeros((len(pairs), 1 << decontam.FEATURE_BITS), np.float32)
    for n, (_, t) in enumerate(pairs):
        feature = decontam._features(decontam.scan([t.encode()]))
        np.add.at(rows[n], feature, idf[feature])
        rows[n] /= np.sqrt((idf[feature] ** 2).sum())
    _, s, v = np.linalg.svd(rows, full_matrices=False)
    basis = np.linalg.qr((space / np.maximum(idf, 1e-9)[:, None])[:, :6])[0]  # the leading six
    assert np.linalg.norm(v[:6] @ basis) ** 2 > 5.9  # the same six-dimensional space


def test_planted_items_and_paraphrases(make_docs, spark):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = {i: text(rnd.choice([16, 30, 45, 150])) for i in range(12)}
    pairs, want = [], set()
    for i in range(150):
        own = text(rnd.randint(20, 300))
        if i % 5 == 0:
            item = i // 5 % 12
            leak = list(items[item])
            if i % 10 == 0:  # reworded: a fifth of the words, but not the answer
                for _ in range(len(leak) // 5):
                    leak[rnd.randrange(len(leak) - 4)] = rnd.choice(vocabulary)
            at = rnd.randrange(len(own))
            own[at:at] = [w.upper() + "," if rnd.random() < 0.2 else w for w in leak]
            want.add((i, item))
        pairs.append((i, " ".join(own)))
    bench = spark.createDataFrame([(i, " ".join(w), "x") for i, w in items.items()], "item_id long, text string, at string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(make_docs(pairs), bench).collect()}
    assert got == want
    kept = decontam.clean(make_docs(pairs), bench)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in pairs} - {i for i, _ in want}
    assert kept.columns == make_docs(pairs).columns


def _accepted(item, text):
    """Whether a window of whole blocks and a block on either side passes the confirm
    step, by comparing all windows."""
    found, words = decontam.scan([item.encode()]).hash, decontam.scan([text.encode()]).hash
    count = -(-len(found) // (decontam.SCALES[-1] * decontam.BLOCK - decontam.BLOCK // 2))
    for j in range(count):
        own = found[j * len(found) // count : (j + 1) * len(found) // count]
        scale = min(max((len(own) + 12 + decontam.BLOCK // 2) // decontam.BLOCK, 1), decontam.SCALES[-1])
        for first in range(0, len(words), decontam.BLOCK):
            near = words[max(first - decontam.BLOCK, 0) : first + (scale + 1) * decontam.BLOCK]
            covered = decontam.common_lengths(own, near[None])[0] / len(own)
            if covered >= 0.7 or (covered >= 0.5 and len(near) >= 5 and decontam._runs(near[None], own[-5:])[0]):
                return True
    return False


def test_every_passage_that_the_confirm_step_accepts_is_a_candidate(spark, make_docs):
    sf, rnd = "/root/testdata/sf0.01", random.Random(7)
    bench = table(spark, sf, "benchmark").orderBy("item_id").limit(25)
    texts = [r.text.split() for r in table(spark, sf, "documents").where("text is not null").orderBy("doc_id").limit(300).collect()]
    pairs, planted = [(1000 + i, " ".join(t)) for i, t in enumerate(texts)], {}
    for hosts in ([t for t in texts if len(t) > 200], [t for t in texts if 30 < len(t) <= 200]):
        for part in (0.0, 0.3, 0.48):  # reworded with words of the host, but not the answer
            for r in bench.collect():
                host, leak = rnd.choice(hosts), r.text.split()
                for k in rnd.sample(range(len(leak) - 5), min(int(part * len(leak)), len(leak) - 5)):
                    leak[k] = rnd.choice(host)
                at = rnd.randrange(len(host) + 1)
                planted[len(planted)] = (r.item_id, r.text)
                pairs.append((len(planted) - 1, " ".join(host[:at] + leak + host[at:])))
    text_of = dict(pairs)
    want = {(d, i) for d, (i, t) in planted.items() if _accepted(t, text_of[d])}
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(make_docs(pairs), bench).collect()}
    assert len(want) > 0.9 * len(planted)
    assert want <= got
    items = {r.item_id: r.text for r in bench.collect()}
    assert all(_accepted(items[i], text_of[d]) for d, i in got)


def test_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    squeezed = {r.doc_id: " ".join(r.text.split()) for r in docs.collect()}
    want = {(d, r.item_id) for r in bench.collect() for d, t in squeezed.items() if " ".join(r.text.split()) in t}
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()}
    assert want and want <= got and len(got - want) <= len(want) // 10


def test_odd_rows(spark, make_docs, odd_pairs):
    words = odd_pairs[3][1]
    rows = [(1, words), (2, None), (3, ""), (4, " \n"), (None, words), (5, "one"), (1, words), (6, odd_pairs[23][1][:3000])]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(make_docs(odd_pairs), bench).collect()}
    assert {(3, 1), (None, 1), (103, 6), (104, 6)} <= got
    assert not [g for g in got if g[1] in (2, 3, 4) or g[0] in (100, 101, 102)]
    assert decontam.leaks(make_docs([]), bench).count() == 0
    assert decontam.leaks(make_docs(odd_pairs), bench.limit(0)).count() == 0
    assert decontam.clean(make_docs(odd_pairs), bench.limit(0)).count() == len(odd_pairs)


def test_rows_without_doc_id_are_judged_by_their_own_text(spark, make_docs):
    rnd = random.Random(9)
    text = lambda n: " ".join(f"w{rnd.randrange(900)}" for _ in range(n))
    item, plain = text(30), text(80)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    pairs = [(1, text(60)), (2, text(20) + " " + item), (None, text(40) + " " + item + " " + text(9)), (None, plain), (None, None)]
    kept = decontam.clean(make_docs(pairs), bench)
    assert {(r.doc_id, r.text) for r in kept.collect()} == {pairs[0], (None, plain), (None, None)}
    assert kept.columns == make_docs(pairs).columns
