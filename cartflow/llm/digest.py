"""Locality-sensitive document fingerprints: quartile bucket digests.

Every five-byte window of a text adds six byte triplets to 128 hash buckets.
Each bucket's count becomes two bits, its quartile among the counts; the digest
is a byte for the logarithm of the length, a byte for the ratios of the
quartiles and the 32 bytes of bucket codes, as hexadecimal digits.  Two digests
differ by a bounded score: the distance of the bucket codes (an opposite
quartile counts double) plus bounded distances of length and ratios.

Each text meets its successor in ascending doc_id without a global sort in one
task: doc_id ranges of about equal size are shuffled once, sorted and streamed,
and the first text of the next range closes each range.

Defined results: null reads as the empty text, which has the digest of no
triplets; texts under three bytes are padded with zero bytes; rows without doc_id
come first; rows that share a doc_id are ordered by text; a single row is its own
successor; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import slices

BUCKETS = 128
#: Largest possible difference: 128 codes of 6 each, 32 for length, 24 for ratios.
WORST = 6 * BUCKETS + 32 + 24
_SALTS = (2, 3, 5, 7, 11, 13)
_PICKS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))


def _permutation() -> np.ndarray:
    return np.random.default_rng(128).permutation(256).astype(np.uint8)


def bucket_counts(data: bytes, hop: np.ndarray) -> np.ndarray:
    """Counts of the hashed triplets of one text."""
    raw = np.frombuffer(data + b"\0" * max(0, 3 - len(data)), np.uint8)
    counts = np.zeros(256, np.int64)
    n = len(raw)
    for salt, (a, b, c) in zip(_SALTS, _PICKS, strict=True):
        m = n - c
        if m > 0:
            mark = hop[raw[a : a + m] ^ np.uint8(salt)]
            mark = hop[mark ^ raw[b : b + m]]
            counts += np.bincount(hop[mark ^ raw[c : c + m]], minlength=256)
    return counts[:BUCKETS] + counts[BUCKETS:]


def digest(data: bytes, hop: np.ndarray | None = None) -> bytes:
    """34 bytes: length, quartile ratios, two bits for each bucket."""
    hop = _permutation() if hop is None else hop
    counts = bucket_counts(data, hop) if data else np.zeros(BUCKETS, np.int64)
    ordered = np.partition(counts, (31, 63, 95))
    q1, q2, q3 = ordered[31], ordered[63], ordered[95]
    code = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    length = min(255, int(np.log(max(len(data), 1)) / np.log(1.1)))
    ratio = (int(16 * q1 // max(q3, 1)) % 16) << 4 | int(16 * q2 // max(q3, 1)) % 16
    packed = code[0::4] << 6 | code[1::4] << 4 | code[2::4] << 2 | code[3::4]
    return bytes([length, ratio]) + packed.astype(np.uint8).tobytes()


def difference(one: bytes, two: bytes) -> int:
    """Bounded difference score of two digests, 0 to ``WORST``."""
    a, b = np.frombuffer(one, np.uint8).astype(np.int64), np.frombuffer(two, np.uint8).astype(np.int64)
    shifts = np.array([6, 4, 2, 0])
    apart = np.abs((a[2:, None] >> shifts & 3) - (b[2:, None] >> shifts & 3))
    ring = lambda x, y: min((x - y) % 16, (y - x) % 16)
    ratios = ring(a[1] >> 4, b[1] >> 4) + ring(a[1] & 15, b[1] & 15)
    return int(np.where(apart == 3, 6, apart).sum() + min(32, abs(a[0] - b[0])) + min(24, 2 * ratios))


def likeness(one: bytes, two: bytes) -> float:
    """1 for equal digests, 0 for the worst difference."""
    return 1.0 - difference(one, two) / WORST


def _ranges(docs: DataFrame) -> tuple[list[int], int]:
    """Bounds of doc_id ranges of about equal row counts, four for each shuffle
    partition, and the number of partitions."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / (4 * parts) for i in range(1, 4 * parts)]
    got = docs.agg(F.percentile_approx("doc_id", cuts, 40 * parts).alias("q")).first()["q"]
    return sorted(set(got or [])), parts


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, text, edited (the text whose second half is
    replaced by the beginning of the next one), fingerprint, edited_fingerprint,
    near_edited and near_next (likeness to the edited text, to the next text)."""
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    bounds, parts = _ranges(plain)
    part = F.lit(0)
    if bounds:
        # The number of bounds below the id.
        part = F.size(F.filter(F.lit(bounds), lambda b: b < F.col("doc_id")))
    plain = plain.withColumn("part", F.when(F.col("doc_id").isNull(), -1).otherwise(part))
    # The first row of every range, one row for each of the few ranges.
    heads = plain.groupBy("part").agg(F.min("doc_id").alias("doc_id"))
    starts = (
        plain.join(F.broadcast(heads.withColumnRenamed("doc_id", "least")), "part")
        .where(F.col("doc_id").eqNullSafe(F.col("least")))
        .groupBy("part")
        .agg(F.min("text").alias("text"))
    )
    order = sorted(r["part"] for r in heads.select("part").collect())
    follows = dict(zip(order, order[-1:] + order[:-1], strict=True))
    closing = starts.replace(follows, subset=["part"]) if len(order) > 1 else starts
    rows = plain.select("part", F.lit(0).alias("kind"), "doc_id", "text").union(
        closing.select("part", F.lit(1).alias("kind"), F.lit(None).cast("long"), "text")
    )

    def stream(batches):
        hop = _permutation()
        held = None  # the row whose successor has not come yet: part, id, text, digest
        for batch, texts in slices(batches, "text"):
            out = []
            parts_, kinds, ids = (batch.column(i).to_pylist() for i in (0, 1, 2))
            for at, kind, doc, raw in zip(parts_, kinds, ids, texts, strict=True):
                mark = digest(raw, hop)
                if held is not None and held[0] == at:
                    _, own, before, was = held
                    text, after = before.decode(), raw.decode()
                    n = len(text)
                    edited = (text[: n - n // 2] + after[: n // 2]).encode()
                    new = digest(edited, hop)
                    out.append((own, n, before, edited, was.hex(), new.hex(), likeness(was, new), likeness(was, mark)))
                held = None if kind else (at, doc, raw, mark)
            if out:
                cols = list(zip(*out, strict=True))
                kinds_ = [pa.int64(), pa.int64(), None, None, pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c, k) if k else pa.array(c, pa.binary()).cast(pa.string())
                        for c, k in zip(cols, kinds_, strict=True)
                    ],
                    _COLUMNS,
                )

    return (
        rows.repartition(parts, "part")
        .sortWithinPartitions("part", "kind", "doc_id", "text")
        .mapInArrow(
            stream,
            "doc_id long, n_chars long, text string, edited string, fingerprint string, "
            "edited_fingerprint string, near_edited double, near_next double",
        )
    )


_COLUMNS = ["doc_id", "n_chars", "text", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
