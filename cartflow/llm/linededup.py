"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

A line's key is the line stripped of ASCII white space with A-Z lower-cased;
keys of ``min_chars`` code points or more count.  The index has three tables:

* ``postings``  (shard, key, doc_id): which documents hold a key, each pair once;
* ``refs``      (shard, key, n_docs, last_doc): exact reference counts;
* ``filters``   (shard, body, room): per shard, a cuckoo filter of the active keys,
  those that ``min_docs`` documents or more hold, and how many it has room for.

Inserting documents raises counts and adds the fingerprints of keys that become
active; deleting documents lowers them and takes fingerprints out again, so a
line comes back once too few documents hold it.  A shard whose active keys pass
``FULL`` of its room gets a filter of twice that size, filled anew from the exact
counts.  A filter has no false negatives: what its table cannot place goes to a
stash beside it.

Rewriting sends each line's key past its shard's filter; what passes is decided
by the exact table.  An active line is dropped from every document but the
largest doc_id that holds it.

Keys are 128-bit BLAKE2 digests.  When probed, a shard is spread over one task for
each ``PROBED`` of its postings, so a key that very many documents hold is too; it is
partially aggregated when counted, and split by the adaptive skew join when decided.

Defined results: a null or empty text is one empty line; rows without doc_id are
neither counted nor changed; rows that share a doc_id count as one document and
lose the same lines; inserting a known doc_id with another text adds that text's
lines to the document (delete it first to replace it).
"""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import WHITESPACE, cut, mix, per_slice, slices, small

#: Postings of a shard that one task probes, about.
PROBED = 2_000_000
#: Share of a filter's room from which it is built anew.
FULL = 0.9
#: Shards whose number of parts is sent to all tasks; more are joined by a shuffle.
BROADCAST_SHARDS = 1_000_000
SLOTS = 4
KICKS = 200
_FILTERS = "shard int, body binary, room long"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Digest of a line's key; None for a key that is too short."""
    key = line.strip(WHITESPACE).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


class CuckooFilter:
    """16-bit fingerprints in buckets of four, with a stash for what finds no place.

    Each key has two buckets, the second from the first and the fingerprint, so
    that entries can move and be deleted without their keys.
    """

    def __init__(self, table: np.ndarray, stash: Counter | None = None):
        self.table = table
        self.stash = Counter(stash)  # (lower bucket, fingerprint) and how often

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(keys, 1) / (SLOTS * 0.8)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def from_bytes(cls, body: bytes) -> CuckooFilter:
        stashed, buckets = np.frombuffer(body, np.int64, 2).tolist()
        stash = np.frombuffer(body, np.int64, 3 * stashed, 16).reshape(-1, 3).tolist()
        table = np.frombuffer(body, np.uint16, buckets * SLOTS, 16 + 24 * stashed).reshape(-1, SLOTS)
        return cls(table.copy(), Counter({(a, b): n for a, b, n in stash}))

    def to_bytes(self) -> bytes:
        head = np.array([len(self.stash), len(self.table)], np.int64)
        stash = [(a, b, n) for (a, b), n in sorted(self.stash.items())]
        return head.tobytes() + np.array(stash, np.int64).tobytes() + self.table.tobytes()

    def row(self, shard: pa.Array) -> pa.Table:
        """The filter as a row of the filters' table."""
        return pa.table({"shard": shard, "body": pa.array([self.to_bytes()], pa.binary()), "room": pa.array([self.table.size])})

    def _other(self, bucket, mark):
        return (bucket ^ mix(np.asarray(mark, np.uint64)).astype(np.int64)) & (len(self.table) - 1)

    def places(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint, first bucket and second bucket of 16-byte keys."""
        raw = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
        mark = (raw[:, 1] % np.uint64(65535)).astype(np.int64) + 1
        one = raw[:, 1].view(np.int64) >> 20 & (len(self.table) - 1)
        return mark, one, self._other(one, mark)

    def add(self, keys: list[bytes]) -> None:
        table = self.table
        for mark, one, two in zip(*(x.tolist() for x in self.places(keys)), strict=True):
            for bucket in (one, two):
                free = np.flatnonzero(table[bucket] == 0)
                if len(free):
                    table[bucket, free[0]] = mark
                    break
            else:
                bucket = two
                for kick in range(KICKS):
                    slot = (mark + kick) % SLOTS
                    mark, table[bucket, slot] = int(table[bucket, slot]), mark
                    bucket = int(self._other(bucket, mark))
                    free = np.flatnonzero(table[bucket] == 0)
                    if len(free):
                        table[bucket, free[0]] = mark
                        break
                else:
                    self.stash[min(bucket, int(self._other(bucket, mark))), mark] += 1

    def remove(self, keys: list[bytes]) -> None:
        for mark, one, two in zip(*(x.tolist() for x in self.places(keys)), strict=True):
            for bucket in (one, two):
                at = np.flatnonzero(self.table[bucket] == mark)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break
            else:
                at = (min(one, two), mark)
                if at in self.stash:
                    self.stash[at] -= 1
                    if not self.stash[at]:
                        del self.stash[at]

    def maybe(self, keys: list[bytes]) -> np.ndarray:
        mark, one, two = self.places(keys)
        found = ((self.table[one] == mark[:, None]) | (self.table[two] == mark[:, None])).any(axis=1)
        if self.stash:
            low = np.minimum(one, two)
            found |= np.array([(a, b) in self.stash for a, b in zip(low.tolist(), mark.tolist(), strict=True)], bool)
        return found


def postings(docs: DataFrame, min_chars: int, shards: int) -> DataFrame:
    """(shard, key, doc_id) for each counted line key of each document, each once."""

    def step(batch, texts):
        keys, rows = [], []
        for i, text in enumerate(texts):
            own = {line_key(line, min_chars) for line in (text or b"").split(b"\n")} - {None}
            keys.extend(own)
            rows.extend([i] * len(own))
        first = np.frombuffer(b"".join(keys), np.uint64)[0::2] if keys else np.zeros(0, np.uint64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array((first % np.uint64(shards)).astype(np.int32)),
                pa.array(keys, pa.binary()),
                batch.column(0).take(pa.array(rows, pa.int64())),
            ],
            ["shard", "key", "doc_id"],
        )

    plain = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return plain.mapInArrow(per_slice(step), "shard int, key binary, doc_id long").distinct()


@dataclass(frozen=True)
class LineIndex:
    """The index and its parameters; ``insert`` and ``delete`` return a new one."""

    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    min_chars: int
    min_docs: int
    shards: int

    @classmethod
    def build(cls, docs: DataFrame, min_chars: int = 20, min_docs: int = 3, shards: int | None = None) -> LineIndex:
        """``shards``: a shard's active keys fill one filter in one task's memory;
        by default four for each shuffle partition."""
        shards = shards or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        held = cut(postings(docs, min_chars, shards))
        refs = cut(_count(held))
        filters = cut(_filled(refs.where(F.col("n_docs") >= min_docs), 1))
        return cls(held, refs, filters, min_chars, min_docs, shards)

    def insert(self, docs: DataFrame) -> LineIndex:
        new = cut(
            postings(docs, self.min_chars, self.shards).join(self.postings, ["shard", "key", "doc_id"], "left_anti")
        )
        refs = cut(
            self.refs.unionByName(_count(new))
            .groupBy("shard", "key")
            .agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))
        )
        return self._changed(cut(self.postings.unionByName(new)), refs)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index without the documents named in column doc_id."""
        gone = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
        held = cut(self.postings.join(gone, "doc_id", "left_anti").select("shard", "key", "doc_id"))
        touched = self.postings.join(gone, "doc_id", "left_semi").select("key").distinct()
        same = self.refs.join(touched, "key", "left_anti").select("shard", "key", "n_docs", "last_doc")
        return self._changed(held, cut(same.unionByName(_count(held.join(touched, "key", "left_semi")))))

    def _changed(self, held: DataFrame, refs: DataFrame) -> LineIndex:
        """Bring the filters in line with the counts: only keys that crossed the
        threshold are added or taken out, but for shards that became too full."""
        active = F.col("n_docs") >= self.min_docs
        now, was = refs.where(active).select("shard", "key"), self.refs.where(active).select("shard", "key")
        load = now.groupBy("shard").agg(F.count(F.lit(1)).alias("keys"))
        full = load.join(self.filters.select("shard", "room"), "shard", "left")
        full = cut(full.where("room is null").union(full.where(F.col("keys") > FULL * F.col("room"))).select("shard"))
        full = small(full, BROADCAST_SHARDS)
        moves = (
            now.join(was, ["shard", "key"], "left_anti")
            .withColumn("up", F.lit(True))
            .unionByName(was.join(now, ["shard", "key"], "left_anti").withColumn("up", F.lit(False)))
            .join(full, "shard", "left_anti")
        )

        def move(key, old: pa.Table, new: pa.Table) -> pa.Table:
            up = new.column("up").to_pylist()
            keys = new.column("key").to_pylist()
            gain = [k for k, u in zip(keys, up, strict=True) if u]
            own = CuckooFilter.from_bytes(old.column("body")[0].as_py())
            own.remove([k for k, u in zip(keys, up, strict=True) if not u])
            own.add(gain)
            return own.row(pa.array([key[0].as_py()], pa.int32()))

        others = self.filters.join(full, "shard", "left_anti").groupBy("shard").cogroup(moves.groupBy("shard"))
        grown = _filled(now.join(full, "shard", "left_semi"), 2)
        filters = cut(others.applyInArrow(move, _FILTERS).unionByName(grown))
        return LineIndex(held, refs, filters, self.min_chars, self.min_docs, self.shards)

    def _passing(self) -> DataFrame:
        """Postings that their shard's filter lets through."""
        parts = self.refs.groupBy("shard").agg(F.ceil(F.sum("n_docs") / PROBED).cast("int").alias("parts"))
        parts = small(cut(parts), BROADCAST_SHARDS)  # a row a shard
        lines = self.postings.join(parts, "shard").select(
            "shard",
            F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int").alias("salt"),
            F.lit(1).alias("kind"),
            "key",
            "doc_id",
        )
        filters = self.filters.join(parts, "shard").select(
            "shard",
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"),
            F.lit(0).alias("kind"),
            F.col("body").alias("key"),
            F.lit(None).cast("long").alias("doc_id"),
        )

        def probe(batches):
            at, own = None, None
            for batch in batches:
                group = np.stack([batch.column(i).to_numpy() for i in (0, 1, 2)])
                edge = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
                edge = [0, *edge.tolist(), batch.num_rows]
                for i, j in zip(edge[:-1], edge[1:], strict=True):
                    if i == j:
                        continue
                    shard, salt, kind = group[:, i].tolist()
                    part = batch.slice(i, j - i)
                    if not kind:
                        at, own = (shard, salt), CuckooFilter.from_bytes(part.column(3)[0].as_py())
                    elif at == (shard, salt):
                        part = part.filter(pa.array(own.maybe(part.column(3).to_pylist())))
                        if part.num_rows:
                            yield part.select(["key", "doc_id"])

        tasks = int(self.postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return (
            filters.unionByName(lines)
            .repartition(tasks, "shard", "salt")
            .sortWithinPartitions("shard", "salt", "kind")
            .mapInArrow(probe, "key binary, doc_id long")
        )

    def dropped(self) -> DataFrame:
        """(doc_id, key) of every line key that the document must lose."""
        active = self.refs.where(F.col("n_docs") >= self.min_docs).select("key", "last_doc")
        return self._passing().join(active, "key").where("doc_id != last_doc").select("doc_id", "key")

    def rewrite(self, docs: DataFrame) -> DataFrame:
        """The indexed documents without their dropped lines: doc_id, text,
        n_lines (before), n_dropped; a struct column ``rest`` is carried along."""
        min_chars = self.min_chars
        carry = ["rest"] if "rest" in docs.columns else []
        plain = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry
        )
        lost = self.dropped().groupBy("doc_id").agg(F.collect_list("key").alias("keys"))

        def run(batches):
            for batch, texts in slices(batches, "text"):
                kept, lines, gone = [], [], []
                keys = batch.column(batch.schema.get_field_index("keys")).to_pylist()
                for text, own in zip(texts, keys, strict=True):
                    parts = (text or b"").split(b"\n")
                    lines.append(len(parts))
                    if own:
                        own = set(own)
                        left = [x for x in parts if line_key(x, min_chars) not in own]
                        gone.append(len(parts) - len(left))
                        kept.append(b"\n".join(left))
                    else:
                        gone.append(0)
                        kept.append(text)
                made = {
                    "doc_id": batch.column(0),
                    "text": pa.array(kept, pa.binary()).cast(pa.string()),
                    "n_lines": pa.array(lines, pa.int64()),
                    "n_dropped": pa.array(gone, pa.int64()),
                } | {c: batch.column(batch.schema.get_field_index(c)) for c in carry}
                yield pa.RecordBatch.from_arrays(list(made.values()), list(made))

        schema = "doc_id long, text string, n_lines long, n_dropped long"
        if carry:
            schema += f", rest {plain.schema['rest'].dataType.simpleString()}"
        return plain.join(lost, "doc_id", "left").mapInArrow(run, schema)


def _filled(active: DataFrame, spare: int) -> DataFrame:
    """A filter for each shard of active keys, with room for ``spare`` times as many."""

    def fill(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_pylist()
        own = CuckooFilter.sized(spare * len(keys))
        own.add(keys)
        return own.row(table.column("shard").slice(0, 1).combine_chunks())

    return active.select("shard", "key").groupBy("shard").applyInArrow(fill, _FILTERS)


def _count(held: DataFrame) -> DataFrame:
    return held.groupBy("shard", "key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Index all documents and rewrite them (see :class:`LineIndex`)."""
    return LineIndex.build(docs, min_chars, min_docs).rewrite(docs)
