"""Exact removal of repeated word windows by super-k-mer partitioning.

A window is ``width`` consecutive words.  Its minimiser is the smallest hash
among its runs of ``gram`` words; consecutive windows with one minimiser form a
super-k-mer, whose words travel once, as one packed string, to the bucket of the
minimiser.  Equal windows have equal minimisers, so a bucket sees every copy of
its windows: it sorts their 128-bit hashes with (doc_id, start) and every window
but the first of its group is a repeat.

A gram that very many windows have in common (a phrase of a licence, say) would
send them all to one bucket.  So the windows of all documents are first counted by
the cell of their minimiser; grams of a cell that alone would fill an average
bucket are passed over, and their windows go by the smallest of their other grams.
Windows of nothing but such grams go alone, by the hash of all their words.  The
number of buckets follows from the same counts, so that a bucket stays small.

Packing works on slices of a few megabytes.  A super-k-mer that a slice holds
more than once is shipped once, in its earliest place; the later places are
repeats already, so a passage of very many copies costs each bucket one string
per slice and not one per copy.  Strings of one bucket and slice are compressed
together.

Defined results: a null text has no words; texts shorter than a window lose
nothing; rows of one doc_id and text are one document (repeated rows never remove
each other); rows of one doc_id and unlike texts are documents in the order of a hash
of their text (their twin number; 0 for ordinary rows), and so are rows without
doc_id, which come after all others.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import Words, cut, mix, per_slice, powers, slices, small, window_hashes

#: Stands for a missing doc_id: after all others.
LAST = (1 << 63) - 1
#: Cells by which minimisers are counted.
CELLS = 1 << 16
#: Bytes of text packed at a time; larger slices compress better and need more memory.
PACK_BYTES = 4 << 20
#: Super-k-mers of a bucket, about, at most: what a task holds of one, some 16 MB of words.
BUCKET_RUNS = 100_000
#: Doc_ids of unlike texts that are sent to all tasks; more are joined by a shuffle.
BROADCAST_TWINS = 1_000_000
#: zstd level of packed strings.
LEVEL = 6
_POLY = 0xD1342543DE82EF95
_POLY_INVERSE = pow(_POLY, -1, 1 << 64)
_SHIPPED = "bucket int, size long, body binary, doc_id long, twin long, begin int, end int"
_SPANS = "doc_id long, twin long, begin int, end int"


class _Runs:
    """128-bit hashes of runs of words, from prefix sums of word hashes."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.back = powers(_POLY_INVERSE, n + 1)
        up = powers(_POLY, n)
        self.sums = []
        for own in (hashes, mix(hashes ^ np.uint64(0xA5A5A5A5DEADBEEF))):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(own * up[:n], out=total[1:])
            self.sums.append(total)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = (end - begin).astype(np.uint64)
        one, two = (mix((s[end] - s[begin]) * self.back[begin] + size) for s in self.sums)
        return one, two


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` consecutive values."""
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    if span < width:
        out = np.minimum(out[: len(out) - (width - span)], out[width - span :])
    return out


class _Order:
    """Places of documents in the order of (doc_id, twin), as one number each."""

    def __init__(self, doc: np.ndarray, twin: np.ndarray):
        self.plain = not twin.any()
        if self.plain:  # doc_ids are that order
            self.place = doc
            return
        pairs = np.stack([doc, twin], axis=1)
        self.told, self.place = np.unique(pairs, axis=0, return_inverse=True)
        self.place = self.place.reshape(-1)

    def pairs(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.plain:
            return place, np.zeros(len(place), np.int64)
        return self.told[place, 0], self.told[place, 1]


def later_copies(doc: np.ndarray, start: np.ndarray, *hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of items with equal hashes: (index of each later copy, index of each first
    one, also of items that occur once); first by (doc, start)."""
    order = np.argsort(hashes[0], kind="stable")
    same = hashes[0][order][1:] == hashes[0][order][:-1]
    inside = np.concatenate((same, [False])) | np.concatenate(([False], same))
    alone, order = order[~inside], order[inside]
    if not len(order):
        return order, alone
    order = order[np.lexsort((start[order], doc[order], *(h[order] for h in hashes)))]
    new = np.ones(len(order), bool)
    new[1:] = np.any([h[order][1:] != h[order][:-1] for h in hashes], axis=0)
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = (doc[order] != doc[head]) | (start[order] != start[head])
    return order[later], np.concatenate((alone, order[new]))


def merge_spans(doc: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """Union of word spans, document by document."""
    if not len(doc):
        return doc, begin, end
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    # Ends are made comparable across documents by a running maximum per document.
    fresh = np.concatenate(([True], doc[1:] != doc[:-1]))
    group = np.cumsum(fresh) - 1
    lift = group * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift)
    head = fresh.copy()
    head[1:] |= (begin + lift)[1:] > reach[:-1]
    at = np.flatnonzero(head)
    return doc[at], begin[at], np.maximum.reduceat(end + lift, at) - lift[at]


class _Windows:
    """The windows of some texts: row, first word and minimiser of each."""

    def __init__(self, words: Words, width: int, gram: int, crowded: np.ndarray | None = None):
        windows = np.maximum(np.diff(words.first) - width + 1, 0)
        self.row = np.repeat(np.arange(len(windows)), windows)
        before = np.repeat(np.cumsum(windows) - windows, windows)
        self.at = np.arange(len(self.row)) - before + words.first[self.row]
        if not len(self.at):
            self.key = np.zeros(0, np.uint64)
            return
        grams = window_hashes(words.hash, gram)
        span = width - gram + 1
        if crowded is None:
            self.key = sliding_min(grams, span)[self.at]
            return
        none = np.uint64((1 << 64) - 1)
        self.key = sliding_min(np.where(crowded[_cell(grams)], none, grams), span)[self.at]
        if (lost := self.key == none).any():  # nothing but crowded grams
            at = self.at[lost]
            self.key[lost] = _Runs(words.hash)(at, at + width)[0]

    def heads(self) -> np.ndarray:
        """First windows of the super-k-mers."""
        row, key = self.row, self.key
        return np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (key[1:] != key[:-1]))))


def _cell(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64(CELLS - 1)).astype(np.int64)


def crowded_cells(keyed: DataFrame, width: int, gram: int, buckets: int, fixed: bool = False) -> tuple[np.ndarray, int]:
    """Which cells of minimisers hold more super-k-mers than an average bucket, and the
    number of buckets (``buckets``, or unless ``fixed`` more where they would hold more
    than BUCKET_RUNS each); ``CELLS`` counts reach the driver, over all rows."""

    def run(batches):
        total = np.zeros(CELLS, np.int64)
        for _, texts in slices(batches, "text"):
            own = _Windows(Words(texts), width, gram)
            if len(own.at):
                total += np.bincount(_cell(own.key[own.heads()]), minlength=CELLS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["cell", "n"])

    got = keyed.select("text").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CELLS, np.int64)
    counts[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    if not fixed:
        buckets = max(buckets, int(counts.sum()) // BUCKET_RUNS)
    return counts > counts.sum() / buckets, buckets


def _packer(width: int, gram: int, buckets: int, crowded: np.ndarray):
    def step(batch: pa.RecordBatch, texts):
        codec = pa.Codec("zstd", compression_level=LEVEL)
        words = Words(texts)
        order_of = _Order(*(batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1)))
        ids = order_of.place
        windows = _Windows(words, width, gram, crowded)
        if not len(windows.at):
            return
        head, at = windows.heads(), windows.at
        begin = at[head]
        end = at[np.concatenate((head[1:], [len(at)])) - 1] + width
        row, key = windows.row[head], windows.key[head]
        doc, start = ids[row], begin - words.first[row]
        later, first = later_copies(doc, start, *_Runs(words.hash)(begin, end))
        if len(later):
            of, a, b = merge_spans(doc[later], start[later], start[later] + (end - begin)[later])
            n = len(of)
            of, twin = order_of.pairs(of)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((mix(of.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.binary()),
                    pa.array(of),
                    pa.array(twin),
                    pa.array(a.astype(np.int32)),
                    pa.array(b.astype(np.int32)),
                ],
                _NAMES,
            )
        bucket = (mix(key[first]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        first, bucket = first[order], bucket[order]
        edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        low_byte, high_byte = words.start[begin], words.end[end - 1]
        data, bodies, sizes = words.bytes, [], []
        for i, j in itertools.pairwise(edge):
            own = first[i:j]
            packed = b"\n".join([data[x:y] for x, y in zip(low_byte[own].tolist(), high_byte[own].tolist(), strict=True)])
            of, twin = order_of.pairs(doc[own])
            twins = twin.tobytes() if twin.any() else b""
            body = b"".join(
                (
                    np.int64(i - j if twins else j - i).tobytes(),  # below 0: twin numbers follow
                    np.diff(of, prepend=0).tobytes(),
                    twins,
                    start[own].astype(np.int32).tobytes(),
                    (end - begin)[own].astype(np.int32).tobytes(),
                    packed,
                )
            )
            sizes.append(len(body))
            bodies.append(codec.compress(body, asbytes=True))
        n = len(bodies)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[edge[:-1]].astype(np.int32)),
                pa.array(sizes, pa.int64()),
                pa.array(bodies, pa.binary()),
                pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.int32()),
                pa.nulls(n, pa.int32()),
            ],
            _NAMES,
        )

    return per_slice(step, limit=PACK_BYTES)


_NAMES = ["bucket", "size", "body", "doc_id", "twin", "begin", "end"]


def _spans(doc, twin, begin, end) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(twin, pa.int64()), pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32))],
        _NAMES[3:],
    )


def _bucket_spans(bodies: list[tuple[int, bytes]], width: int) -> pa.RecordBatch:
    """The repeated windows of one bucket, as merged spans."""
    docs, twins, starts, sizes, texts = [], [], [], [], []
    for size, body in bodies:
        raw = pa.decompress(body, decompressed_size=size, codec="zstd", asbytes=True)
        told = int(np.frombuffer(raw, np.int64, 1)[0])
        n, at = abs(told), 8
        docs.append(np.cumsum(np.frombuffer(raw, np.int64, n, at)))
        at += 8 * n
        twins.append(np.frombuffer(raw, np.int64, n, at) if told < 0 else np.zeros(n, np.int64))
        at += 8 * n * (told < 0)
        starts.append(np.frombuffer(raw, np.int32, n, at))
        sizes.append(np.frombuffer(raw, np.int32, n, at + 4 * n))
        texts.append(raw[at + 8 * n :])
    order_of = _Order(np.concatenate(docs), np.concatenate(twins))
    doc, start, size = order_of.place, np.concatenate(starts).astype(np.int64), np.concatenate(sizes)
    hashes = Words([b"\n".join(texts)]).hash
    texts.clear()
    # The windows of all runs: first word in the bucket, document and start in it.
    count = size.astype(np.int64) - width + 1
    run = np.repeat(np.arange(len(doc), dtype=np.int32), count)
    inside = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(np.cumsum(size) - size, count) + inside
    doc, start = doc[run], start[run] + inside
    del run, inside
    later, _ = later_copies(doc, start, *_Runs(hashes)(at, at + width))
    doc, start = doc[later], start[later]
    doc, start, end = merge_spans(doc, start, start + width)
    return _spans(*order_of.pairs(doc), start, end)


def _bucket_step(width: int):
    def run(batches):
        now, held = None, []
        for batch in batches:
            body = batch.column(2)
            plain = batch.filter(body.is_null())
            if plain.num_rows:
                yield plain.select(_NAMES[3:])
            for i in np.flatnonzero(body.is_valid().to_numpy(zero_copy_only=False)).tolist():
                bucket = batch.column(0)[i].as_py()
                if bucket != now and held:
                    yield _bucket_spans(held, width)
                    held = []
                now = bucket
                held.append((batch.column(1)[i].as_py(), body[i].as_py()))
        if held:
            yield _bucket_spans(held, width)

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id (LAST for none), twin and text of every row."""
    plain = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    number = F.xxhash64(F.coalesce("text", F.lit("")))
    pairs = plain.where(F.col("doc_id") != LAST).select("doc_id", number.alias("number"))
    unlike = pairs.groupBy("doc_id").agg(F.min("number").alias("a"), F.max("number").alias("b")).where("a <> b")
    unlike = cut(unlike.select(F.col("doc_id").alias("_of")))
    keyed = plain.join(small(unlike, BROADCAST_TWINS), F.col("doc_id") == F.col("_of"), "left")
    twin = F.when((F.col("doc_id") == LAST) | F.col("_of").isNotNull(), number).otherwise(F.lit(0))
    return keyed.select("doc_id", twin.cast("long").alias("twin"), "text")


def _repeated_spans(keyed: DataFrame, width: int, gram: int, buckets: int | None) -> DataFrame:
    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    crowded, buckets = crowded_cells(keyed, width, gram, buckets or 8 * tasks, fixed=buckets is not None)
    return (
        keyed.mapInArrow(_packer(width, gram, buckets, crowded), _SHIPPED)
        .repartition(tasks, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_bucket_step(width), _SPANS)
    )


def repeated_spans(docs: DataFrame, width: int = 20, gram: int = 4, buckets: int | None = None) -> DataFrame:
    """Word spans (doc_id, twin, begin, end) covered by a window that starts earlier elsewhere.

    ``buckets``: number of minimiser buckets; a bucket is held in one task's
    memory.  By default eight for each shuffle partition, or more where they would be large.
    """
    return _repeated_spans(_keyed(docs), width, gram, buckets)


def drop_repeats(docs: DataFrame, width: int = 20, gram: int = 4, buckets: int | None = None) -> DataFrame:
    """Every document without its repeated words: doc_id, text (kept words joined
    by one blank), n_words, n_removed."""
    keyed = _keyed(docs)
    # A document's own spans only: bounded by its text.
    spans = (
        _repeated_spans(keyed, width, gram, buckets)
        .groupBy("doc_id", "twin")
        .agg(F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends"))
    )

    def step(batches):
        for batch, texts in slices(batches, "text"):
            begins, ends = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            kept, words, removed = [], [], []
            for text, first, last in zip(texts, begins, ends, strict=True):
                own = (text or b"").split()
                words.append(len(own))
                if first:
                    drop = np.zeros(len(own) + 1, np.int32)
                    np.add.at(drop, np.minimum(first, len(own)), 1)
                    np.add.at(drop, np.minimum(last, len(own)), -1)
                    own = [w for w, out in zip(own, np.cumsum(drop).tolist(), strict=False) if not out]
                removed.append(words[-1] - len(own))
                kept.append(b" ".join(own))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(words, pa.int64()),
                    pa.array(removed, pa.int64()),
                ],
                ["doc_id", "text", "n_words", "n_removed"],
            )

    out = keyed.join(spans, ["doc_id", "twin"], "left").mapInArrow(step, "doc_id long, text string, n_words long, n_removed long")
    return out.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(LAST)))
