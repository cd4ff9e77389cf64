"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over all passages (runs of ``PASSAGE``
   words) of all documents give the TF-IDF weights.
2. A distributed randomised SVD finds the latent space: with A the TF-IDF matrix
   of all passages and a fixed random test matrix G, every task sums its part of
   A'(A G); the sums (features x ``RANK`` numbers, whatever the corpus) give the
   leading singular vectors by the Nystrom formula.  They are divided by their
   squared singular values, so that what a language or a common topic shares does
   not outweigh the words that tell passages apart.
3. Every document is cut into blocks of ``BLOCK`` words.  Windows of one to four
   blocks at every block are compared by cosine in the latent space with the
   benchmark items of about their length; items come in groups of ``ITEMS``, each
   a pass over the documents.
4. The cosine misses passages (short, reworded, or off the blocks), so two exact
   bounds add every window that step 5 could accept: the windows with an item's
   answer in them, and those that hold as many of the item's rarest words as any
   passage that covers ``share`` of the item must.
5. Candidates are confirmed on words (those that hold too few of an item's words in
   any order are out at once): the longest common subsequence (LCS) of the item and
   the words around the window must cover ``share`` of the item, or
   ``paraphrase`` of it if the item's answer, its last ``ANSWER`` words, stands in
   the passage as well.

Items longer than the largest window are searched by pieces of that length and
confirmed piece by piece; an item counts as leaked by any of its pieces.

Words are runs of bytes other than ASCII white space and punctuation, with A-Z and
Latin-1 capitals lower-cased.  Defined results: null or empty texts and items match
nothing; items under ``MIN_WORDS`` words must occur in full; rows without doc_id
are searched and reported with null; repeated rows are reported once.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import Words, mix, per_slice, received, share, window_hashes

FEATURE_BITS = 14
RANK = 96
PASSAGE = 64
BLOCK = 16
SCALES = (1, 2, 3, 4)
ITEMS = 4096
ANSWER = 5
MIN_WORDS = 8
#: Cosine from which a window is a candidate, for pieces of ``FULL_WORDS`` words or
#: more; for a shorter piece other words weigh more in its window, and the cosine
#: falls by ``PER_WORD`` a word down to ``LEAST_COSINE``.
COSINE, FULL_WORDS, PER_WORD, LEAST_COSINE = 0.34, 37, 0.01, 0.17
SUM_BLOCK = 256
#: Low bits of a word's hash by which an item's words are looked up.
WORD_BITS = 12
#: Low bits of an answer's hash by which most other runs of words are passed over.
RUN_BITS = 16
_SLICE = 1 << 20
#: Windows that are compared with items at a time.
_SPAN = 1 << 14

PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def scan(texts: list[bytes | None]) -> Words:
    return Words(texts, lower=True, separators=PUNCTUATION, latin=True)


def _features(words: Words) -> np.ndarray:
    return (words.hash >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


@dataclass
class Blocks:
    """Runs of ``width`` words, none across texts: text and first word of each, the
    numbers of its words (the last block of a text is filled up with the number
    after the last word) and their features (of the filling: one more feature, whose
    vectors are zero)."""

    row: np.ndarray
    start: np.ndarray
    at: np.ndarray
    features: np.ndarray

    @classmethod
    def of(cls, words: Words, width: int) -> Blocks:
        count = np.diff(words.first)
        pieces = -(-count // width)
        row = np.repeat(np.arange(len(count)), pieces)
        start = words.first[row] + width * (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        at = start[:, None] + np.arange(width)
        feature = np.append(_features(words), 1 << FEATURE_BITS)
        at[at >= words.first[row + 1][:, None]] = len(feature) - 1
        return cls(row, start, at, feature[at])

    def sums(self, vectors: np.ndarray) -> np.ndarray:
        """Sum of the vectors of each block's words."""
        out = np.zeros((len(self.row), vectors.shape[1]), vectors.dtype)
        for column in np.ascontiguousarray(self.features.T):
            out += np.take(vectors, column, axis=0)
        return out


def _padded(vectors: np.ndarray) -> np.ndarray:
    return np.concatenate((vectors, np.zeros((1, vectors.shape[1]), vectors.dtype)))


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """IDF of each hashed feature over all passages of all documents."""

    def count(batches):
        seen, total = np.zeros(1 << FEATURE_BITS, np.int64), [0]

        def step(batch, texts):
            held = np.sort(Blocks.of(scan(texts), PASSAGE).features, axis=1)
            new = held < len(seen)
            new[:, 1:] &= held[:, 1:] != held[:, :-1]
            seen[:] += np.bincount(held[new], minlength=len(seen))
            total[0] += len(held)
            return ()

        for _ in per_slice(step, limit=_SLICE)(batches):
            pass
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(seen[some], total[0]))], ["feature", "n"]
        )

    # One row for each feature at most.
    got = (
        docs.select("doc_id", "text")
        .mapInArrow(count, "feature long, n long")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    feature, n = got.column("feature").to_numpy(), got.column("n").to_numpy()
    passages = n[feature < 0].sum()
    df = np.zeros(1 << FEATURE_BITS)
    df[feature[feature >= 0]] = n[feature >= 0]
    return np.log((1 + passages) / (1 + df)).astype(np.float32)


def latent_space(docs: DataFrame, idf: np.ndarray) -> np.ndarray:
    """Randomised SVD of the passages' TF-IDF matrix (rows of about unit length):
    features x RANK, leading right singular vectors over their squared singular
    values, times the IDF (rows to sum over the words of a text)."""
    size = 1 << FEATURE_BITS
    test = np.random.default_rng(9).standard_normal((size, RANK)).astype(np.float32)
    shared = share(docs.sparkSession, (idf, test))  # features x (RANK + 1) numbers

    def multiply(batches):
        idf, test = received(shared)
        weighted = _padded(np.concatenate((test * idf[:, None], idf[:, None] ** 2), axis=1))
        total = np.zeros((RANK, size + 1))  # the last column is the filling's

        def step(batch, texts):
            blocks = Blocks.of(scan(texts), PASSAGE)
            if not len(blocks.row):
                return ()
            image = blocks.sums(weighted)
            image = image[:, :RANK] / np.maximum(image[:, RANK:], 1e-9)  # A G, over the norms once more
            feature, held = blocks.features.ravel(), np.empty(blocks.features.shape)
            for column, own in zip(total, np.ascontiguousarray(image.T, np.float64), strict=True):  # A'(A G)
                held[:] = own[:, None]
                column += np.bincount(feature, held.ravel(), size + 1)
            return ()

        for _ in per_slice(step, limit=_SLICE)(batches):
            pass
        total = (total[:, :size].T * idf[:, None]).astype(np.float32)
        parts = total.reshape(-1, SUM_BLOCK * RANK)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array([parts[i].tobytes() for i in some], pa.binary())], ["part", "sums"]
        )

    def add(batches):
        now, held = None, None
        for batch in batches:
            for part, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part != now:
                    if now is not None:
                        yield _row(now, held)
                    now, held = part, np.zeros(SUM_BLOCK * RANK)
                held += np.frombuffer(sums, np.float32)
        if now is not None:
            yield _row(now, held)

    def _row(part, sums):
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["part", "sums"])

    parts = size // SUM_BLOCK
    got = (
        docs.select("doc_id", "text")
        .mapInArrow(multiply, "part int, sums binary")
        .repartition(min(parts, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "part")
        .sortWithinPartitions("part")
        .mapInArrow(add, "part int, sums binary")
        .toArrow()
    )
    image = np.zeros((parts, SUM_BLOCK * RANK))
    for part, sums in zip(got.column("part").to_pylist(), got.column("sums").to_pylist(), strict=True):
        image[part] = np.frombuffer(sums, np.float64)
    image = image.reshape(size, RANK)
    if not image.any():
        return np.zeros((size, RANK), np.float32)
    # Nystrom: A'A is about image (test' image)^-1 image'.
    shift = 1e-6 * np.linalg.norm(image)
    image = image + shift * test
    core = test.T.astype(np.float64) @ image
    w, v = np.linalg.eigh((core + core.T) / 2)
    good = w > w.max() * 1e-8
    root = image @ (v[:, good] / np.sqrt(w[good]))
    u, s, _ = np.linalg.svd(root, full_matrices=False)  # s: singular values of A
    out = np.zeros((size, RANK), np.float32)
    out[:, : u.shape[1]] = u * (s[0] / np.maximum(s, s[0] * 1e-3)) ** 2
    return out * idf[:, None]


@dataclass
class Items:
    """A group of benchmark pieces: item and words of each, its window scale, the
    cosine of its candidates, its latent vector, a table of its words by their
    low bits, the features of its rarest words and how many of them a window must
    hold, and the sorted hashes of the answers with their pieces."""

    ids: np.ndarray
    words: list[np.ndarray]
    scale: np.ndarray
    cosine: np.ndarray
    vectors: np.ndarray
    holds: np.ndarray
    rare: list[np.ndarray]
    least: np.ndarray
    answers: np.ndarray
    answer_of: np.ndarray

    def tables(self) -> dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """By scale: some pieces, for each feature which of them have it among their
        rarest words, and for each word (by its low bits) which have it at all (the last
        rows are those of the filling)."""
        out = {}
        for scale in SCALES:
            for some in _chunks(np.flatnonzero(self.scale == scale), 256):
                table = np.zeros(((1 << FEATURE_BITS) + 1, len(some)), np.uint8)
                for k, piece in enumerate(some):
                    table[self.rare[piece], k] = 1
                out.setdefault(scale, []).append((some, table, np.ascontiguousarray(self.holds[some].T, np.uint8)))
        return out


def _fewest(size: int, covered: float) -> int:
    """The fewest words that are ``covered`` of ``size`` words."""
    return next(k for k in itertools.count(max(int(size * covered) - 1, 0)) if k / size >= covered)


def _rarest(features: np.ndarray, idf: np.ndarray, scale: int, need: int) -> tuple[np.ndarray, int]:
    """Features of the rarest words of a piece and how many of them every window with
    ``need`` of its words holds: of r words at most ``len(features) - need`` are
    missing.  r is taken where chance windows are least likely to hold as many."""
    features = features[np.argsort(-idf[features], kind="stable")]
    new = np.zeros(len(features))
    new[np.unique(features, return_index=True)[1]] = 1
    chance = np.cumsum(new * np.exp(-idf[features].astype(np.float64))) * (scale + 2) * BLOCK / PASSAGE
    least = np.arange(1, len(features) + 1) - (len(features) - need)
    t = np.maximum(least, 1)
    gain = np.where(t > chance, t * np.log(t / chance) - t + chance, 0.0)  # Chernoff bound of a Poisson count
    r = int(np.argmax(np.where(least >= 1, gain, -1.0)))
    return np.unique(features[: r + 1]), int(least[r])


def _pieces(
    ids: list[int],
    texts: list[bytes | None],
    space: np.ndarray,
    idf: np.ndarray,
    cosine: float = COSINE,
    share_of_item: float = 0.7,
) -> Items:
    longest = SCALES[-1] * BLOCK - BLOCK // 2
    found, words, rows, own_features = [], [], [], []
    every = scan(texts)
    features = _features(every)
    for i, item in enumerate(ids):
        first, last = every.first[i], every.first[i + 1]
        n = last - first
        if not n:
            continue
        count = -(-n // longest)
        for j in range(count):
            a, b = first + j * n // count, first + (j + 1) * n // count
            found.append(item)
            words.append(every.hash[a:b])
            rows.append(space[features[a:b]].sum(axis=0))
            own_features.append(features[a:b])
    size = np.array([len(w) for w in words], np.int64)
    # The scale whose window best covers a piece at any offset to the blocks.
    scale = np.clip((size + 12 + BLOCK // 2) // BLOCK, SCALES[0], SCALES[-1])
    vectors = np.array(rows).reshape(-1, space.shape[1])
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    holds = np.zeros((len(words), (1 << WORD_BITS) + 1), bool)
    for own, table in zip(words, holds, strict=True):
        table[_low(own)] = True
    least = np.maximum(min(LEAST_COSINE, cosine), cosine - PER_WORD * np.maximum(FULL_WORDS - size, 0))
    rare = [
        _rarest(f, idf, k, _fewest(len(f), share_of_item if len(f) >= MIN_WORDS else 1.0))
        for f, k in zip(own_features, scale.tolist(), strict=True)
    ]
    long = np.flatnonzero(size >= MIN_WORDS)
    answers = np.array([window_hashes(words[k][-ANSWER:], ANSWER)[0] for k in long], np.uint64)
    order = np.argsort(answers)
    return Items(
        np.array(found, np.int64), words, scale, least.astype(np.float32), vectors.astype(np.float32), holds,
        [r for r, _ in rare], np.array([n for _, n in rare], np.int64), answers[order], long[order],
    )


def _chunks(values: np.ndarray, size: int) -> list[np.ndarray]:
    return [values[k : k + size] for k in range(0, len(values), size)]


def _low(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)


def common_lengths(item: np.ndarray, passages: np.ndarray) -> np.ndarray:
    """LCS length of one word sequence with each row of ``passages``."""
    best = np.zeros((len(passages), passages.shape[1] + 1), np.int16)
    for word in item:
        step = best.copy()
        step[:, 1:] = np.maximum(best[:, 1:], (best[:, :-1] + 1) * (passages == word))
        best = np.maximum.accumulate(step, axis=1)
    return best[:, -1]


def _runs(passages: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Whether each row holds ``run`` as consecutive words."""
    n = passages.shape[1] - len(run) + 1
    hit = np.ones((len(passages), max(n, 0)), bool)
    for j, word in enumerate(run):
        hit &= passages[:, j : j + n] == word
    return hit.any(axis=1)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    share_of_item: float = 0.7,
    paraphrase: float = 0.5,
    cosine: float = COSINE,
) -> DataFrame:
    """(doc_id, item_id, at, cosine, covered, answered): the best passage, from word
    ``at`` on, of every document and benchmark item that it leaks."""
    return _leaks(_plain(docs), benchmark, share_of_item, paraphrase, cosine)


def _leaks(
    docs: DataFrame, benchmark: DataFrame, share_of_item: float = 0.7, paraphrase: float = 0.5, cosine: float = COSINE
) -> DataFrame:
    """``leaks`` of rows (doc_id of any type, text)."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    idf = inverse_frequencies(docs)
    space = latent_space(docs, idf)
    sent = share(spark, space)  # features x RANK numbers
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("item_id is not null and text is not null").distinct()
    groups = -(-items.count() // ITEMS)
    found = None
    for g in range(max(groups, 1)):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(max(groups, 1))) == g).orderBy("item_id", "text").collect()
        texts = [r["text"].encode() for r in own]
        pieces = _pieces([r["item_id"] for r in own], texts, space, idf, cosine, share_of_item)
        part = docs.mapInArrow(
            _searcher(sent, share(spark, pieces), share_of_item, paraphrase),
            f"doc_id {kind}, item_id long, at int, cosine double, covered double, answered boolean",
        )
        found = part if found is None else found.unionByName(part)
    best = F.max_by(F.struct("at", "cosine", "covered", "answered"), F.struct("covered", "cosine", -F.col("at")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def _answered(words: Words, items: Items, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces whose answers stand in the texts, and the blocks of the first and the
    last word of each such place."""
    runs = window_hashes(words.hash, ANSWER)
    low = np.uint64((1 << RUN_BITS) - 1)
    known = np.zeros(1 << RUN_BITS, bool)
    known[(items.answers & low).astype(np.int64)] = True
    at = np.flatnonzero(known[(runs & low).astype(np.int64)])
    text = np.searchsorted(words.first, at, "right") - 1
    inside = at + ANSWER <= words.first[text + 1]
    at, text = at[inside], text[inside]
    begin = np.searchsorted(items.answers, runs[at], "left")
    count = np.searchsorted(items.answers, runs[at], "right") - begin
    piece = items.answer_of[np.repeat(begin, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
    head, word = np.searchsorted(row, text), at - words.first[text]
    return piece, np.repeat(head + word // BLOCK, count), np.repeat(head + (word + ANSWER - 1) // BLOCK, count)


def _held(table: np.ndarray, features: np.ndarray, row: np.ndarray, part: slice, scale: int) -> np.ndarray:
    """How many words of each piece's in ``table`` the windows of ``part`` hold, with a
    block on either side."""
    place = np.arange(len(row))[part]
    begin, end = max(place[0] - 1, 0), min(place[-1] + scale + 1, len(row))
    one = np.zeros((end - begin, table.shape[1]), np.uint8)
    for column in np.ascontiguousarray(features[begin:end].T):
        one += np.take(table, column, axis=0)
    total = np.zeros((len(place), table.shape[1]), np.uint8)
    for step in range(-1, scale + 1):
        near = np.clip(place + step, begin, end - 1)
        total += one[near - begin] * ((near == place + step) & (row[near] == row[place]))[:, None]
    return total


def _searcher(sent, group, share_of_item: float, paraphrase: float):
    names = ["doc_id", "item_id", "at", "cosine", "covered", "answered"]

    def search(batches):
        space, items = _padded(received(sent)), received(group)
        tables = items.tables()
        least = np.array([_least(len(w)) for w in items.words], np.int64)
        yield from per_slice(lambda batch, texts: _search(batch, texts, space, items, tables, least), limit=_SLICE)(batches)

    def _least(size: int) -> int:
        """Words of a piece of ``size`` words that every window which step 5 accepts holds."""
        fewest = _fewest(size, share_of_item if size >= MIN_WORDS else 1.0)
        return min(_fewest(size, paraphrase), fewest) if size >= MIN_WORDS else fewest

    def _search(batch, texts, space, items, tables, least):
        words = scan(texts)
        if not len(words.hash) or not len(items.ids):
            return
        blocks = Blocks.of(words, BLOCK)
        sums, row = blocks.sums(space), blocks.row
        # Words by block, and a block of no words for what lies outside a text.
        none = np.full((1, BLOCK), len(words.hash))
        at = np.concatenate((blocks.at, none))
        hashes = np.append(words.hash, np.uint64(0))[at]
        low = np.append(_low(words.hash), 1 << WORD_BITS)[at]
        total = sums.copy()
        with_answer = _answered(words, items, row)
        for scale in SCALES:
            if scale > 1:
                n = max(len(sums) - scale + 1, 0)
                total[:n] += sums[scale - 1 :] * (row[scale - 1 :] == row[:n])[:, None]
            if scale not in tables:
                continue
            norm = np.sqrt(np.einsum("ij,ij->i", total, total))
            # The windows that hold an answer, a block on either side included.
            mine = items.scale[with_answer[0]] == scale
            piece, begin, end = (x[mine] for x in with_answer)
            place = end[:, None] - scale + np.arange(scale + 2)
            fits = (place <= begin[:, None] + 1) & (place >= 0) & (place < len(row))
            fits &= row[np.clip(place, 0, len(row) - 1)] == row[begin][:, None]
            piece, place = np.repeat(piece, fits.sum(axis=1)), place[fits]
            for (some, table, every), first in itertools.product(tables[scale], range(0, len(total), _SPAN)):
                part = slice(first, first + _SPAN)
                near = items.vectors[some] @ total[part].T
                candidate = near >= items.cosine[some, None] * norm[part] + 1e-12
                candidate |= (_held(table, blocks.features, row, part, scale) >= items.least[some]).T
                sure = (piece >= some[0]) & (piece <= some[-1]) & (place >= first) & (place < first + _SPAN)
                candidate[np.searchsorted(some, piece[sure]), place[sure] - first] = True
                # What holds too few of the item's words in any order is out at once.
                candidate &= (_held(every, low[:-1], row, part, scale) >= least[some]).T
                which, at = np.nonzero(candidate)
                edge = np.flatnonzero(np.concatenate(([True], which[1:] != which[:-1], [True]))) if len(at) else []
                for i, j in zip(edge[:-1], edge[1:], strict=True):
                    item, here = some[which[i]], at[i:j] + first
                    ok, covered, answered = _confirm(hashes, low, row, here, scale, items, item)
                    if len(ok):
                        cosines = near[which[i], at[i:j][ok]] / np.maximum(norm[here[ok]], 1e-9)
                        here = here[ok]
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(pa.array(row[here])),
                                pa.array(np.full(len(here), items.ids[item])),
                                pa.array((blocks.start[here] - words.first[row[here]]).astype(np.int32)),
                                pa.array(cosines.astype(np.float64)),
                                pa.array(covered),
                                pa.array(answered),
                            ],
                            names,
                        )

    def _confirm(hashes, low, row, place, scale, items, item):
        """Places (by position) that hold the item, the share covered and whether
        its answer stands there."""
        own = items.words[item]
        need = share_of_item if len(own) >= MIN_WORDS else 1.0
        fewest = _fewest(len(own), need)
        least = _least(len(own))
        # The window and a block on either side, as far as they are of the same text.
        near = place[:, None] + np.arange(-1, scale + 1)
        inside = (near >= 0) & (near < len(row))
        near = np.clip(near, 0, len(row) - 1)
        inside &= row[near] == row[place][:, None]
        near[~inside] = len(row)
        # An LCS is no longer than the number of words that the item holds, nor than
        # the number of item words that the passage holds.
        found = items.holds[item][low[near]].reshape(len(place), -1).sum(axis=1)
        some = np.flatnonzero(found >= least)
        if len(some):
            held = np.zeros((len(some), (1 << WORD_BITS) + 1), bool)
            held[np.arange(len(some))[:, None], low[near[some]].reshape(len(some), -1)] = True
            found = np.minimum(found[some], held[:, _low(own)].sum(axis=1))
            answered = _runs(hashes[near[some]].reshape(len(some), -1), own[-ANSWER:])
            fewest = np.where(answered, least, fewest)
            keep = found >= fewest
            some, answered, fewest = some[keep], answered[keep], fewest[keep]
        if not len(some):
            return some, None, None
        covered = common_lengths(own, hashes[near[some]].reshape(len(some), -1))
        good = covered >= fewest
        return some[good], covered[good] / len(own), answered[good]

    return search


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` whose document leaks no benchmark item; a row without
    doc_id is judged by its own text."""
    # One search for all rows: a document's key is its id, or else a digest of its text.
    text, number = F.col("text").cast("string"), F.col("doc_id").cast("long").cast("string")
    key = F.coalesce(F.concat(F.lit("d"), number), F.concat(F.lit("t"), F.sha2(F.coalesce(text, F.lit("")), 256)))
    found = _leaks(docs.select(key.alias("doc_id"), text.alias("text")), benchmark, **how)
    return docs.join(found.select(F.col("doc_id").alias("_leaky")).distinct(), key == F.col("_leaky"), "left_anti")
