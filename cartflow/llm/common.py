"""Helpers shared by the training-data operators: table reads, lineage cuts,
bounded Arrow slices, the byte-level word scanner and graph components."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.session import checkpoint_dir

# Tasks get the functions of this subpackage by value, so executors need not
# have it on their import path.
cloudpickle.register_pickle_by_value(sys.modules["cartflow.llm"])

#: Bytes of text that one numpy step looks at; a longer text goes alone.
SLICE_BYTES = 4 << 20

#: ASCII white space: blank and \x09-\x0D.
WHITESPACE = b" \t\n\x0b\x0c\r"

#: Bytes of text that are hashed at a time, so that arrays stay in the cache.
_STRETCH = 1 << 17

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a Parquet table (all when none are named)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def located(address: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address; Hadoop writes local ones with one slash."""
    if address.startswith("file:/") and not address.startswith("file://"):
        address = "file://" + address[5:]
    return fs.FileSystem.from_uri(address) if "://" in address else (fs.LocalFileSystem(), address)


def remove(folder: str) -> None:
    """Delete a folder of the shared store."""
    store, path = located(folder)
    store.delete_dir(path)


def share(spark: SparkSession, value):
    """Send a model to all tasks; ``received`` reads it there.  Its class travels
    by value, like the functions of this subpackage."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared):
    return pickle.loads(shared.value)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it is seen to have ``rows`` rows at most;
    else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() <= rows else df


def held_out(doc_id) -> F.Column:
    """Rows that no learner may see: crc32 of the id's text divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def slices(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Cut Arrow batches into row runs of at most ``limit`` bytes of text (one
    row at least); yields the run and its texts as UTF-8 (None for null)."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        size = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        begin, end = 0, np.cumsum(size)
        while begin < batch.num_rows:
            before = end[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(end, before + limit, "right")))
            part = batch.slice(begin, stop - begin)
            yield part, part.column(at).cast(pa.binary()).to_pylist()
            begin = stop


def per_slice(step: Callable, text: str = "text", limit: int = SLICE_BYTES, once: Callable | None = None) -> Callable:
    """A ``mapInArrow`` function that applies ``step(batch, texts)`` to each
    slice; ``step`` returns a record batch, or yields several.  What ``once()`` returns,
    once a task, is its third argument."""

    def run(batches):
        state = (once(),) if once else ()
        for batch, texts in slices(batches, text, limit):
            made = step(batch, texts, *state)
            if isinstance(made, pa.RecordBatch):
                yield made
            else:
                yield from made

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):  # products are modulo 2**64; numpy warns of scalars
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of every run of ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = (out + values[j : j + n]) * _MULT
        out ^= out >> np.uint64(29)
    return mix(out)


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts laid end to end.

    ``start``/``end``: byte offsets in ``bytes``; ``first[i]:first[i + 1]`` are
    the words of text i; ``hash``: 64-bit hash of each word's bytes.
    """

    def __init__(
        self, texts: list[bytes | None], lower: bool = False, separators: bytes = b"", latin: bool = False
    ):
        """``lower`` folds A-Z, ``latin`` also the two-byte capitals of Latin-1;
        ``separators``: bytes that divide words besides white space."""
        data = b"\n".join([t or b"" for t in texts]) + b"\n"
        self.bytes = data
        buffer = np.frombuffer(data, np.uint8)
        if lower:
            fold = np.arange(256, dtype=np.uint8)
            fold[65:91] += 32
            buffer = fold[buffer]
        if latin:
            second = (buffer >= 0x80) & (buffer <= 0x9E) & (buffer != 0x97)
            second[1:] &= buffer[:-1] == 0xC3
            second[:1] = False
            buffer = buffer + (second * np.uint8(0x20))
        blank = np.zeros(256, bool)
        blank[list(WHITESPACE + separators)] = True
        space = blank[buffer]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t or b"") + 1 for t in texts], out=at[1:])
        self.first = np.searchsorted(self.start, at)
        self.hash = self._hashes(buffer)

    def _hashes(self, buffer: np.ndarray) -> np.ndarray:
        """Polynomial hashes from prefix sums, over short stretches of whole words."""
        out = np.zeros(len(self.start), np.uint64)
        if not len(out):
            return out
        heads = np.unique(np.searchsorted(self.start, np.arange(0, len(buffer), _STRETCH)))
        heads = np.append(heads[heads < len(out)], len(out))
        longest = int((self.end[heads[1:] - 1] - self.start[heads[:-1]]).max())
        up, back = powers(_BASE, longest), powers(_BASE_INVERSE, longest)
        for i, j in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
            low = self.start[i]
            own = buffer[low : self.end[j - 1]].astype(np.uint64)
            own += np.uint64(1)
            own *= up[: len(own)]
            total = np.zeros(len(own) + 1, np.uint64)
            np.cumsum(own, out=total[1:])
            start, end = self.start[i:j] - low, self.end[i:j] - low
            out[i:j] = (total[end] - total[start]) * back[start]
        return mix(out)


def list_array(flat: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge table as (node, root), root
    the smallest node; nodes without an edge have no row.

    Alternates "larger neighbours to the smallest neighbour" and "smaller
    neighbours to the smallest" until the edges form stars.  A node's minimum is
    partially aggregated before the shuffle and joined back, so a hub with very
    many neighbours is never gathered in one row.
    """
    now = (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    now = cut(now)
    seen = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (
            both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        now = cut(
            small.where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000003)).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
