"""MinHash near-duplicates with tensored banding.

A text's set is its distinct shingles of consecutive words (A-Z lower-cased).
Two small collections of ``side`` minhash pairs each are computed per text; the
table keys are all ``side * side`` combinations of one left and one right pair,
so ``4 * side`` minhash values serve ``side ** 2`` tables of four values each
(32 values for 64 tables).  Two texts with similarity s share a table with
probability ``(1 - (1 - s**2) ** side) ** 2``: 0.9994 at 0.8 for side 8.

Candidates come from table keys only and are confirmed on full sets:

* texts with equal sets are one class, stood for by its smallest doc_id;
* every class in a table is compared with the table's smallest class (a star,
  linear in the table's size), and the confirmed links give first components;
* in tables that still hold several components, the classes outside the table's
  own component are compared with the others, each pair in the first table that it
  shares, so that no link is lost and no table is expanded into all its pairs;
* before sets are fetched, an exact bound on the symmetric difference (the
  Hamming distance of 1,024-bit parity bitmaps never exceeds it) drops pairs
  that cannot reach the threshold.

Sets are held as 64-bit shingle hashes.

Defined results: a null or empty text, or one of white space, has an empty set
and links with nothing.  Rows that share a doc_id are reported row by row with
one component.  A row without doc_id is reported with null component and kept.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import Words, components, cut, list_array, mix, per_slice, window_hashes

BITMAP_LONGS = 16
SEED = 20240131


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(texts, lower=True)
    out = []
    for i in range(len(texts)):
        own = words.hash[words.first[i] : words.first[i + 1]]
        if len(own) >= width:
            out.append(np.unique(window_hashes(own, width)))
        elif len(own):
            out.append(window_hashes(own, len(own)) ^ np.uint64(len(own)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _signer(width: int, side: int):
    def step(batch: pa.RecordBatch, texts):
        rng = np.random.default_rng(SEED)
        factor = rng.integers(1, 1 << 63, 4 * side, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
        shift = rng.integers(1, 1 << 63, 4 * side, dtype=np.uint64)[:, None]
        sizes, marks, keys, bits = [], [], [], []
        for own in shingle_sets(texts, width):
            sizes.append(len(own))
            marks.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            if len(own):
                low = np.concatenate(
                    [
                        ((own[None, k : k + 4096] * factor + shift)).min(axis=1)[:, None]
                        for k in range(0, len(own), 4096)
                    ],
                    axis=1,
                ).min(axis=1)
                keys.append(mix(low[0::2] + mix(low[1::2])))
                place = (own >> np.uint64(54)).astype(np.int64)
                odd = np.bincount(place, minlength=64 * BITMAP_LONGS) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
        lengths = np.minimum(np.asarray(sizes, np.int64), 1)
        flat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(marks, pa.binary()),
                list_array(flat(keys).view(np.int64), lengths * 2 * side, pa.int64()),
                list_array(flat(bits), lengths * BITMAP_LONGS, pa.int64()),
            ],
            ["doc_id", "n_shingles", "mark", "halves", "bits"],
        )

    return per_slice(step)


def signatures(docs: DataFrame, width: int, side: int) -> DataFrame:
    """Per row: doc_id, n_shingles, mark (digest of the set), halves (left and
    right minhash pairs) and bits (parity bitmap); the last two empty without words."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _signer(width, side),
        "doc_id long, n_shingles long, mark binary, halves array<long>, bits array<long>",
    )


def _table_keys(reps: DataFrame, side: int) -> DataFrame:
    slot = F.explode(F.sequence(F.lit(0), F.lit(side * side - 1)))
    left = F.expr(f"halves[slot div {side}]")
    right = F.expr(f"halves[{side} + slot % {side}]")
    return (
        reps.where("n_shingles > 0")
        .select("doc_id", "halves", slot.alias("slot"))
        .select(F.xxhash64("slot", left, right).alias("key"), "slot", F.col("doc_id").alias("rep"))
    )


def _may_link(a: str, b: str, percent: int) -> F.Column:
    """Size and parity-bitmap bounds that every pair above the threshold meets."""
    na, nb = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    differ = sum(
        (F.bit_count(F.col(f"{a}.bits")[i].bitwiseXOR(F.col(f"{b}.bits")[i])) for i in range(BITMAP_LONGS)),
        F.lit(0),
    )
    return (
        (100 * na >= percent * nb)
        & (100 * nb >= percent * na)
        & ((100 + percent) * differ <= (100 - percent) * (na + nb))
    )


def _first_shared(a: str, b: str, side: int) -> F.Column:
    """Whether the row's table is the first one that the two texts share, so that a
    pair comes from one of its tables only."""
    before = lambda half, place: [
        (F.lit(i) < place) & (F.col(f"{a}.halves")[half + i] == F.col(f"{b}.halves")[half + i]) for i in range(side)
    ]
    left, right = F.expr(f"{a}.slot div {side}"), F.col(f"{a}.slot") % side
    return ~reduce(or_, before(0, left) + before(side, right))


def _confirm(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""

    def step(batch, texts):
        own = shingle_sets(texts, width)
        sizes = np.asarray([len(x) for x in own])
        flat = np.concatenate(own).view(np.int64) if own else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), list_array(flat, sizes, pa.int64())], ["doc_id", "own"])

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = cut(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(wanted, "doc_id", "left_semi")
        .mapInArrow(per_slice(step), "doc_id long, own array<long>")
    )
    common = F.size(F.array_intersect("x.own", "y.own"))
    return (
        pairs.join(sets.alias("x"), F.col("a") == F.col("x.doc_id"))
        .join(sets.alias("y"), F.col("b") == F.col("y.doc_id"))
        .where(100 * common >= percent * (F.size("x.own") + F.size("y.own") - common))
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, side: int = 8
) -> DataFrame:
    """Classes of near-duplicate texts: doc_id, n_shingles, component_id (the
    smallest doc_id reachable over links of at least ``percent`` % Jaccard
    similarity), kept (doc_id = component_id)."""
    signed = cut(signatures(docs, width, side))
    # Empty sets get a class each; equal sets share one, counted before the shuffle.
    # (Cut, so that no join inherits the partitioning by set: a set that very many
    # texts share would lie in one task.)
    some = signed.where("n_shingles > 0 and doc_id is not null")
    classes = cut(some.groupBy("mark").agg(F.min("doc_id").alias("rep")))
    member = cut(
        signed.where("doc_id is not null").select("doc_id", "n_shingles", "mark").join(classes, "mark", "left").drop("mark")
    )
    reps = signed.join(
        classes.select(F.col("rep").alias("doc_id"), "mark"), ["doc_id", "mark"], "left_semi"
    ).dropDuplicates(["doc_id", "mark"])
    sketch = cut(reps.select("doc_id", "n_shingles", "bits", "halves"))
    keys = _table_keys(reps, side)
    hubs = keys.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    tables = cut(keys.join(hubs, "key"))

    def bounded(pairs):
        return (
            pairs.join(sketch.alias("x"), F.col("a") == F.col("x.doc_id"))
            .join(sketch.alias("y"), F.col("b") == F.col("y.doc_id"))
            .where(_may_link("x", "y", percent))
            .select("a", "b")
        )

    # Different texts under one doc_id are linked as such.
    shared = member.where("rep is not null").groupBy("doc_id").agg(
        F.min("rep").alias("a"), F.max("rep").alias("b")
    ).where("a != b").select("a", "b")
    star = cut(bounded(tables.where("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()))
    first = cut(_confirm(star, docs, width, percent))
    label = cut(components(first))
    named = lambda df, col, out: df.join(
        label.select(F.col("node").alias(col), F.col("root").alias(out)), col, "left"
    ).withColumn(out, F.coalesce(out, col))
    placed = named(named(tables, "rep", "label"), "hub", "hub_label")
    open_keys = placed.where("label != hub_label").select("key").distinct()
    placed = cut(
        placed.join(open_keys, "key", "left_semi").join(sketch.withColumnRenamed("doc_id", "rep"), "rep")
    )
    x, y = placed.where("label != hub_label").alias("x"), placed.alias("y")
    outside = (F.col("y.label") == F.col("y.hub_label")) | (F.col("x.rep") < F.col("y.rep"))
    rest = (
        x.join(
            y,
            (F.col("x.key") == F.col("y.key"))
            & (F.col("x.label") != F.col("y.label"))
            & outside
            & _first_shared("x", "y", side)
            & _may_link("x", "y", percent),
        )
        .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))
        .distinct()
        .join(star, ["a", "b"], "left_anti")
    )
    second = cut(_confirm(cut(rest), docs, width, percent))
    root = components(first.union(second).union(shared))
    found = member.join(root.withColumnRenamed("node", "rep"), "rep", "left")
    found = found.withColumn("component_id", F.coalesce("root", "rep", "doc_id"))
    nameless = signed.where("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return (
        found.select("doc_id", "n_shingles", "component_id")
        .union(nameless)
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
