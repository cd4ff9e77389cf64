"""Vector code compression: product codes from Lloyd rounds over cover trees.

Every vector is cut into equal parts, and a codebook of a few entries is learned for
each part position by Lloyd's rounds in integers.  The rows of a task are cut into
slices; for each slice and part position the distinct parts (with their counts) go into
a cover tree, once: the parts within a ball of half a node's radius are a child, whose
centre is the first of them.  The parts are laid out so that each subtree is one run,
and cumulative sums over that order give any subtree's sum and count by a difference.
The trees are written to the shared folder; each round reads them.

A round walks a tree from its root with the entries that may be nearest.  By the
triangle inequality, an entry farther from the centre than the nearest one by more than
twice the radius is nearest to no part below it.  Where one entry is left, the whole
subtree is its; only the parts of ambiguous end nodes are compared one by one, in exact
integers.  A task adds up counts and sums by entry; the driver gets one row for each
entry and component.  Copies are one part with a count, so a hot vector costs no more
than another.

Defined results: rows whose vector is null or holds null, NaN or infinite components are
left out; vectors without components, and of another length than that of the least
vec_id's vector, cannot be cut alike and get a null code and error; rows without vec_id come last when the first
entries are chosen, and equal vec_ids ascend by vector; with fewer rows than entries, a
codebook has as many entries as there are rows; a component of 2**27 / scale or more in
size ends the job with an ArithmeticError, since squared distances might pass 64 bits;
repeated rows are coded alike; an empty table gives no row.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartflow.llm.common import cut, remove, small
from cartflow.session import checkpoint_dir

#: Rows of a slice, and parts of an end node of a tree.
SLICE_ROWS = 4096
BUCKET = 16
#: Integer components stay below this, so that sums of squares fit 64 bits.
LARGEST = 1 << 27
#: Labels whose sums are sent to all tasks; more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000
#: Share by which float distances are trusted less in the triangle inequality.
_SLACK = 1e-9
_FAR = np.iinfo(np.int64).max


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, points by entries."""
    apart = points[:, None, :].astype(np.int64) - entries[None, :, :]
    return np.einsum("pew,pew->pe", apart, apart)


@dataclass
class CoverTree:
    """A cover tree over distinct points; node k covers ``points[lo[k]:hi[k]]``, its
    first point is its centre, and its children are nodes ``child[k]:child[k] + width[k]``
    (none at an end node)."""

    points: np.ndarray
    counts: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    width: np.ndarray

    @classmethod
    def grow(cls, points: np.ndarray, counts: np.ndarray, bucket: int = BUCKET) -> tuple[CoverTree, np.ndarray]:
        """The tree, and the place of each given point in its order."""
        where = points.astype(np.float64)
        order = np.arange(len(points))
        lo, hi, radius, child, width = [0], [len(points)], [0.0], [0], [0]
        # Nodes in breadth-first order; a node's points are order[lo:hi], centre first.
        node = 0
        while node < len(lo):
            begin, end = lo[node], hi[node]
            own = order[begin:end]
            apart = np.sqrt(((where[own] - where[own[0]]) ** 2).sum(1))
            radius[node] = float(apart.max(initial=0.0))
            if len(own) > bucket:
                half, runs, first = radius[node] / 2, [], len(lo)
                near = apart <= half
                while True:
                    runs.append(own[near])
                    lo.append(begin)
                    begin += len(runs[-1])
                    hi.append(begin)
                    own = own[~near]
                    if not len(own):
                        break
                    near = ((where[own] - where[own[0]]) ** 2).sum(1) <= half * half
                    near[0] = True
                order[lo[node] : end] = np.concatenate(runs)
                child[node], width[node] = first, len(runs)
                radius += [0.0] * len(runs)
                child += [0] * len(runs)
                width += [0] * len(runs)
            node += 1
        place = np.empty(len(points), np.int64)
        place[order] = np.arange(len(points))
        ints = [np.array(x, np.int32) for x in (lo, hi, child, width)]
        return cls(points[order], counts[order], ints[0], ints[1], np.array(radius), ints[2], ints[3]), place

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Runs of points as (lo, hi, entry index), whole subtrees or single points, that
        cover all points; and the number of points compared one by one."""
        runs, compared = [], 0
        nodes, may = np.zeros(min(1, len(self.points)), np.int32), np.ones((1, len(entries)), bool)
        while len(nodes):
            exact = np.where(may, squared(self.points[self.lo[nodes]], entries), _FAR)
            apart = np.where(may, np.sqrt(exact.astype(np.float64)), np.inf)
            reach = 2 * self.radius[nodes]
            limit = apart.min(1) + reach
            may = apart <= (limit + _SLACK * (1 + limit))[:, None]
            best = exact.argmin(1)
            # A node of radius 0 is one point, whose distances are exact.
            sure = (may.sum(1) == 1) | (reach == 0)
            runs.append((self.lo[nodes[sure]], self.hi[nodes[sure]], best[sure]))
            nodes, may = nodes[~sure], may[~sure]
            last = self.width[nodes] == 0
            if last.any():
                at, row = _spread(self.lo[nodes[last]], self.hi[nodes[last]] - self.lo[nodes[last]])
                exact = np.where(may[last][row], squared(self.points[at], entries), _FAR)
                runs.append((at, at + 1, exact.argmin(1)))
                compared += len(at)
            nodes, may = nodes[~last], may[~last]
            nodes, row = _spread(self.child[nodes], self.width[nodes])
            may = may[row]
        if not runs:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), 0
        lo, hi, best = (np.concatenate([r[i] for r in runs]).astype(np.int64) for i in range(3))
        return lo, hi, best, compared

    def entry_of(self, entries: np.ndarray) -> np.ndarray:
        """The nearest entry of each point, in the tree's order."""
        lo, hi, best, _ = self.assign(entries)
        order = np.argsort(lo)
        return np.repeat(best[order], (hi - lo)[order])

    def cumulative(self) -> np.ndarray:
        """Count and component sums of all points before each place."""
        weighted = np.column_stack([np.ones(len(self.points), np.int64), self.points]).astype(np.int64)
        out = np.zeros((len(self.points) + 1, weighted.shape[1]), np.int64)
        np.cumsum(weighted * self.counts[:, None], axis=0, out=out[1:])
        return out

    def totals(self, entries: np.ndarray) -> np.ndarray:
        """For each entry: count and component sums of the points nearest to it."""
        lo, hi, best, _ = self.assign(entries)
        out = np.zeros((len(entries), 1 + self.points.shape[1]), np.int64)
        sums = self.cumulative()
        np.add.at(out, best, sums[hi] - sums[lo])
        return out


def _spread(begin: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges begin .. begin + width, and the range of each."""
    row = np.repeat(np.arange(len(begin)), width)
    ahead = np.cumsum(width) - width
    return (np.arange(len(row)) - ahead[row] + begin[row]).astype(np.int32), row


def whole_parts(vectors: np.ndarray, scale: int, parts: int) -> np.ndarray:
    """floor(scale * x) of (rows, components), as (rows, parts, components of a part)."""
    told = np.floor(vectors.astype(np.float64) * scale)
    if len(told) and np.abs(told).max(initial=0) >= LARGEST:
        raise ArithmeticError(f"a vector component is {LARGEST / scale:g} or more in size")
    return told.astype(np.int32).reshape(len(told), parts, -1)


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has finite components only."""
    inf = float("inf")
    fine = lambda x: F.coalesce(~F.isnan(x) & (x < F.lit(inf)) & (x > F.lit(-inf)), F.lit(False))
    return vectors.where(F.col(vector).isNotNull() & F.forall(F.col(vector).cast("array<double>"), fine))


def first_entries(rows: DataFrame, parts: int, entries: int, scale: int) -> tuple[int, np.ndarray]:
    """The vectors' length and the first codebooks (part, entry, component): a few rows,
    found without a global sort."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    told = rows.orderBy(*order).limit(entries).collect()
    if not told:
        return 0, np.zeros((parts, 0, 0), np.int64)
    length = len(told[0]["vector"])
    if length % parts:
        raise ValueError(f"{length} components cannot be cut into {parts} equal parts")
    if any(len(r["vector"]) != length for r in told):
        told = rows.where(F.size("vector") == length).orderBy(*order).limit(entries).collect()
    first = whole_parts(np.array([r["vector"] for r in told], np.float64).reshape(len(told), length), scale, parts)
    return length, first.transpose(1, 0, 2).astype(np.int64)


def _flat(column: pa.Array, length: int) -> np.ndarray:
    """The vectors of a batch as rows of an array."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def _written_trees(rows: DataFrame, path: str, length: int, parts: int, scale: int, slice_rows: int) -> DataFrame:
    """One row for each slice: its ids, labels and pickled (tree, place of each row's part
    in the tree's order) of every part position, written to ``path``."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    out = T.StructType(
        [
            T.StructField("ids", T.ArrayType(kinds["vec_id"])),
            T.StructField("labels", T.ArrayType(kinds["label"])),
            T.StructField("trees", T.BinaryType()),
        ]
    )

    def grown(batch: pa.Table) -> pa.RecordBatch:
        told = whole_parts(_flat(batch.column("vector").combine_chunks(), length), scale, parts)
        trees = []
        for part in range(parts):
            points, back, counts = np.unique(told[:, part], axis=0, return_inverse=True, return_counts=True)
            tree, place = CoverTree.grow(points, counts)
            trees.append((tree.__dict__, place[back.reshape(-1)].astype(np.int32)))
        ids, labels = (batch.column(c).combine_chunks() for c in ("vec_id", "label"))
        ends = pa.array([0, len(told)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(ends, ids),
                pa.ListArray.from_arrays(ends, labels),
                pa.array([pickle.dumps(trees, 5)], pa.binary()),
            ],
            ["ids", "labels", "trees"],
        )

    def slices(batches):
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, slice_rows - n))
                n += held[-1].num_rows
                batch = batch.slice(held[-1].num_rows)
                if n == slice_rows:
                    yield grown(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield grown(pa.Table.from_batches(held))

    rows.mapInArrow(slices, out).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _trees(batches) -> Iterator[tuple[pa.Array, pa.Array, list[tuple[CoverTree, np.ndarray]]]]:
    for batch in batches:
        at = batch.schema.get_field_index("trees")
        named = {c: batch.schema.get_field_index(c) for c in ("ids", "labels")}
        for i in range(batch.num_rows):
            told = [(CoverTree(**fields), place) for fields, place in pickle.loads(batch.column(at)[i].as_py())]
            ids, labels = (batch.column(k)[i].values if k >= 0 else None for k in named.values())
            yield ids, labels, told


def _totals(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """Counts and sums (part, entry, 1 + components) over all trees."""

    def added(batches):
        total = np.zeros((len(books), books.shape[1], 1 + books.shape[2]), np.int64)
        for _, _, told in _trees(batches):
            for part, (tree, _) in enumerate(told):
                total[part] += tree.totals(books[part])
        part, entry, at = (x.reshape(-1) for x in np.indices(total.shape))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(at), pa.array(total.reshape(-1))], ["part", "entry", "at", "total"]
        )

    long = trees.select("trees").mapInArrow(added, "part long, entry long, at long, total long")
    out = np.zeros((len(books), books.shape[1], 1 + books.shape[2]), np.int64)
    for r in long.groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).collect():
        out[r["part"], r["entry"], r["at"]] = r["total"]
    return out


def lloyd(trees: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """Codebooks after the rounds: each entry the componentwise floor(sum / count) of the
    parts nearest to it; an entry without parts stays."""
    for _ in range(rounds):
        total = _totals(trees, books)
        count = total[:, :, :1]
        books = np.where(count > 0, total[:, :, 1:] // np.maximum(count, 1), books)
    return books


def encode(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hexadecimal digits for each part) and error of every row."""
    kinds = {f.name: f.dataType.elementType for f in trees.schema.fields if isinstance(f.dataType, T.ArrayType)}
    out = T.StructType(
        [
            T.StructField("vec_id", kinds["ids"]),
            T.StructField("label", kinds["labels"]),
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
        ]
    )

    def coded(batches):
        for ids, labels, told in _trees(batches):
            codes = np.zeros((len(ids), len(books)), np.uint8)
            error = np.zeros(len(ids), np.int64)
            for part, (tree, place) in enumerate(told):
                entry = tree.entry_of(books[part])
                apart = tree.points.astype(np.int64) - books[part][entry]
                codes[:, part] = entry[place]
                error += (apart * apart).sum(1)[place]
            digits = codes.tobytes().hex()
            step = 2 * len(books)
            told = pa.array([digits[i : i + step] for i in range(0, len(digits), step)], pa.string())
            yield pa.RecordBatch.from_arrays([ids, labels, told, pa.array(error)], ["vec_id", "label", "code", "error"])

    return trees.mapInArrow(coded, out)


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of the components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    vector: str = "embedding",
    slice_rows: int = SLICE_ROWS,
) -> tuple[DataFrame, np.ndarray]:
    """Codes of all usable rows (vec_id, label, code, error, label_error) and the final
    codebooks (part, entry, component)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    rows = usable(vectors, vector).select("vec_id", "label", F.col(vector).alias("vector"))
    length, books = first_entries(rows, parts, entries, scale)
    alike = rows.where((F.size("vector") == length) & (F.size("vector") > 0))
    path = f"{checkpoint_dir(vectors.sparkSession)}/covertrees-{uuid.uuid4().hex}"
    trees = _written_trees(alike, path, length, parts, scale, slice_rows)
    books = lloyd(trees, books, rounds) if books.size else books
    others = rows.where((F.size("vector") != length) | (F.size("vector") == 0)).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    )
    coded = cut(encode(trees, books).union(others))
    remove(path)
    by_label = coded.groupBy(F.col("label").alias("_of")).agg(F.sum("error").alias("label_error"))
    same = F.col("label").eqNullSafe(F.col("_of"))
    return coded.join(small(by_label, BROADCAST_LABELS), same).drop("_of"), books


def decode(code: str, books: np.ndarray, scale: int = 4096) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([books[part][entry] for part, entry in enumerate(bytes.fromhex(code))]) / scale
