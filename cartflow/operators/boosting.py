"""Histogram gradient boosting for a binary label (M7), as Spark aggregates.

* Bin edges once: midpoints of the distinct values, or of the quantiles of a column with
  more values than bins, exact over all fitted rows.
* The rows become blocks of bin numbers (one byte a value), written to the shared folder
  and kept in executors' storage.
* A pass over the blocks sums counts, gradients and Hessians by (node, feature, bin) in
  each task and adds them up; the driver reads one histogram a node and finds the best
  splits.  Of two leaves of one split only the one with fewer rows is summed; the other's
  histogram is their parent's without it.
* A tree grows best first to ``max_leaves`` leaves: the open leaf with the largest gain is
  split next.  A pass serves all leaves that may be needed: the growth is played through
  with the gains known so far, and what it reaches without a gain is asked for at once.
* Scores after a tree are added to the blocks in storage by the next tree's first pass, and
  go to the shared folder every few trees.

Gradients and Hessians are summed as fixed-point integers, so that the sums, and with
them the trees, do not depend on how rows are dealt to tasks.

Growth, leaf values and stopping follow the histogram method with its usual defaults:
log loss, L2 on leaf values, 20 rows a leaf at least; above 10,000 rows a tenth is held
back and boosting ends after 10 rounds without a fall of its log loss by 1e-7.
"""

from __future__ import annotations

import heapq
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow.operators.ranks import cumulative
from cartflow.session import checkpoint_dir
from cartflow.sources.files import remove_path

# Tasks get this module's functions by value, so executors need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block, and bits behind the point of the sums: a block's sums stay below 2**53.
BLOCK_ROWS = 1 << 16
UNIT_BITS = 36
MAX_BINS = 255
MIN_LEAF_ROWS = 20
MIN_LEAF_HESSIAN = 1e-3
#: Above this many rows some are held back and boosting may stop early.
EARLY_STOP_ROWS = 10_000
HELD_SHARE = 10
#: Rounds without a fall of the held-back log loss by more than the tolerance after
#: which boosting ends.
PATIENCE, TOLERANCE = 10, 1e-7
#: Trees after which the blocks' scores are written to the shared folder; until then what
#: storage loses is made anew from the last ones there.
REFRESH = 5
#: Rows of a task at least, and tasks from which histograms are added up in Spark first.
TASK_ROWS, MANY_TASKS = 1 << 13, 32

#: A split as (node, feature, last bin of the left child, left child, right child).
Split = tuple[int, int, int, int, int]


@dataclass
class Tree:
    """Splits in the order they were made, from node 0, and the value of each leaf."""

    splits: list[Split]
    values: dict[int, float]

    def rows(self, bins: np.ndarray, nodes: Sequence[int]) -> dict[int, np.ndarray]:
        """The rows of ``bins`` (features, rows) in each of ``nodes`` (leaves)."""
        above = {child: at for at, _, _, left, right in self.splits for child in (left, right)}
        way = set()
        for node in nodes:
            while node not in way:
                way.add(node)
                node = above.get(node, node)
        found = {0: np.arange(bins.shape[1])}
        for at, feature, last, left, right in self.splits:
            if left in way or right in way:
                own = found.pop(at)
                beyond = bins[feature][own] > last
                if left in way:
                    found[left] = own[~beyond]
                if right in way:
                    found[right] = own[beyond]
        return found

    def add_to(self, raw: np.ndarray, bins: np.ndarray) -> None:
        for leaf, own in self.rows(bins, list(self.values)).items():
            raw[own] += self.values[leaf]


@dataclass
class BoostedTrees:
    """A fitted model: medians for missing values, bin edges, log odds and trees."""

    features: tuple[str, ...]
    medians: dict[str, float]
    edges: list[np.ndarray]
    start: float
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def bins(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        return np.array([np.searchsorted(e, c, "left") for e, c in zip(self.edges, columns, strict=True)], np.uint8)

    def predict(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Probabilities of rows without missing values."""
        bins = self.bins(columns)
        raw = np.full(bins.shape[1], self.start)
        for tree in self.trees:
            tree.add_to(raw, bins)
        return 1 / (1 + np.exp(-raw))

    def score_column(self) -> Column:
        """The probability as a column over the feature columns (Arrow batches)."""
        model = self

        @F.pandas_udf("double")
        def probability(*columns: pd.Series) -> pd.Series:
            return pd.Series(model.predict([c.to_numpy(np.float64) for c in columns]))

        return probability(*[filled(c, self.medians[c]) for c in self.features])


def filled(column: str, median: float) -> Column:
    """A feature with its missing values (null or NaN) replaced."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(value.isNull() | F.isnan(value), F.lit(float(median))).otherwise(value)


def bin_edges(rows: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Ascending edges of every column (DOUBLE, without missing values): a value's bin is
    the number of edges below it.  Midpoints of neighbouring values of a column of at most
    ``max_bins`` of them, else midpoint quantiles k / max_bins.

    Values are counted first, so a value that most rows share is one row; the driver reads
    ``max_bins`` rows a column at most."""
    long = rows.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").alias("value")) for i, c in enumerate(features)]))
    )
    # -0.0 and 0.0 are one value.
    counts = long.withColumn("value", F.col("value") + F.lit(0.0)).groupBy("i", "value").agg(F.count(F.lit(1)).alias("n"))
    run = cumulative(counts, [F.col("i").asc(), F.col("value").asc()], ["n"])
    per = run.groupBy("i").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("values"), F.min(F.col("cum_n") - F.col("n")).alias("ahead")
    )
    run = run.join(F.broadcast(per), "i")  # one row a column
    first = F.col("cum_n") - F.col("n") - F.col("ahead")
    # Quantile k stands at (total - 1) * k / max_bins; a value holds the places first ..
    # first + n - 1, and with them a run of the k whose lower (or upper) place is there.
    last = F.col("total") - 1

    def held(upper: bool) -> Column:
        """Numbers k whose floor (ceiling) place is one of the value's."""
        if upper:  # first - 1 < place * last <= first + n - 1
            begin = F.floor((first - 1) * max_bins / last) + 1
            end = F.floor((first + F.col("n") - 1) * max_bins / last)
        else:  # first <= place * last < first + n
            begin = F.ceil(first * max_bins / last)
            end = F.ceil((first + F.col("n")) * max_bins / last) - 1
        begin, end = F.greatest(begin, F.lit(1)), F.least(end, F.lit(max_bins - 1))
        return F.when(begin <= end, F.sequence(begin.cast("int"), end.cast("int")))

    few = run.where(F.col("values") <= max_bins).select("i", F.lit(0).alias("k"), "value")
    many = run.where(F.col("values") > max_bins)
    parts = [many.select("i", F.explode(held(upper)).alias("k"), "value") for upper in (False, True)]
    got: dict[int, list[tuple[int, float]]] = {}
    for r in few.union(parts[0]).union(parts[1]).collect():
        got.setdefault(r["i"], []).append((r["k"], r["value"]))
    edges = []
    for i in range(len(features)):
        told = sorted(got.get(i, []))
        values = np.array([v for _, v in told], float)
        if told and told[0][0] == 0:
            found = (values[:-1] + values[1:]) / 2
        else:  # two rows a quantile: its lower and its upper place
            found = (values[0::2] + values[1::2]) / 2
        edges.append(np.unique(found))
    return edges


def _blocks(rows: DataFrame, model: BoostedTrees) -> DataFrame:
    """Blocks of rows: bins (features x n bytes), label, held (a byte a row each), raw."""
    wide = len(model.features)

    def block(columns: list[np.ndarray]) -> pa.RecordBatch:
        bins = model.bins(columns[:wide])
        label, held = (columns[wide + k].astype(np.uint8) for k in range(2))
        raw = np.full(len(label), model.start)
        return _block_batch(bins, label, held, raw)

    def pack(batches):
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, BLOCK_ROWS - n))
                n += held[-1].num_rows
                batch = batch.slice(held[-1].num_rows)
                if n == BLOCK_ROWS:
                    yield block([c.to_numpy() for c in pa.Table.from_batches(held).columns])
                    held, n = [], 0
        if n:
            yield block([c.to_numpy() for c in pa.Table.from_batches(held).columns])

    return rows.mapInArrow(pack, "bins binary, label binary, held binary, raw binary")


def _block_batch(bins, label, held, raw) -> pa.RecordBatch:
    told = [pa.array([x.tobytes()], pa.binary()) for x in (bins, label, held, raw)]
    return pa.RecordBatch.from_arrays(told, ["bins", "label", "held", "raw"])


Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _read(blocks: DataFrame, wide: int) -> RDD:
    """Stored blocks as arrays: bins (features, rows), label, held and raw."""

    def unpacked(row) -> Block:
        bins, label, held, raw = row
        label = np.frombuffer(label, np.uint8)
        return np.frombuffer(bins, np.uint8).reshape(wide, len(label)), label, np.frombuffer(held, np.uint8), np.frombuffer(raw)

    return blocks.rdd.map(unpacked)


@dataclass
class Node:
    """What is known of a node: rows, gradient and Hessian sums (fixed point), and once
    it was looked at its best split as (gain, feature, last bin, rows, gradient, Hessian
    of the left child), or None if it cannot be split."""

    rows: int
    gradient: int
    hessian: int
    asked: bool = False
    best: tuple[float, int, int, int, int, int] | None = None


def best_splits(sums: np.ndarray, sizes: Sequence[int], unit: float, l2: float) -> list[tuple[float, int, int, int, int] | None]:
    """Best split of a node by each feature from its histogram ``sums`` (features, 3, bins) of
    integers: rows, gradients and Hessians; ``sizes``: bins that a feature has.  Gain, last
    bin of the left child and its sums; the first of equal gains."""
    left = np.cumsum(sums, axis=2)
    total = left[:, :, -1:]
    right = total - left
    score = lambda s: (s[:, 1] / unit) ** 2 / (s[:, 2] / unit + l2)
    fits = np.arange(sums.shape[2]) < np.array(sizes)[:, None] - 1
    fits &= (left[:, 0] >= MIN_LEAF_ROWS) & (right[:, 0] >= MIN_LEAF_ROWS)
    fits &= (left[:, 2] / unit >= MIN_LEAF_HESSIAN) & (right[:, 2] / unit >= MIN_LEAF_HESSIAN)
    gain = np.where(fits, score(left) + score(right) - score(total), -np.inf)
    at = gain.argmax(axis=1)
    best = gain[np.arange(len(gain)), at]
    return [(float(g), int(k), *(int(x) for x in left[f, :, k])) if g > 0 else None for f, (g, k) in enumerate(zip(best, at, strict=True))]


def _played(known: dict[tuple, Node], max_leaves: int, unit: float) -> tuple[list[tuple], list[tuple], bool]:
    """Best-first growth with the gains known so far: nodes in the order they are split,
    leaves that were not looked at, and whether no other gain could change the growth.
    A node is named by its path of sides (0 left, 1 right) from the root."""
    order: list[tuple] = []
    heap: list[tuple[float, int, tuple]] = []
    unknown: list[tuple] = []
    made, leaves, sure = 0, 1, True

    def opened(path: tuple) -> None:
        nonlocal made
        node = known[path]
        made += 1
        if not node.asked:
            unknown.append(path)
        elif node.best:
            heapq.heappush(heap, (-node.best[0], made, path))

    opened(())
    while heap and leaves < max_leaves:
        sure &= not unknown
        _, _, path = heapq.heappop(heap)
        order.append(path)
        leaves += 1
        node = known[path]
        _, _, _, rows, gradient, hessian = node.best
        for side, told in enumerate(((rows, gradient, hessian), (node.rows - rows, node.gradient - gradient, node.hessian - hessian))):
            child = known.setdefault((*path, side), Node(*told))
            if child.rows < 2 * MIN_LEAF_ROWS or child.hessian / unit < 2 * MIN_LEAF_HESSIAN:
                child.asked = True
            opened((*path, side))
    return order, unknown, sure and (leaves == max_leaves or not unknown)


def _numbered(order: list[tuple], known: dict[tuple, Node]) -> tuple[list[Split], dict[tuple, int]]:
    ids, splits = {(): 0}, []
    for path in order:
        left, right = 2 * len(splits) + 1, 2 * len(splits) + 2
        ids[(*path, 0)], ids[(*path, 1)] = left, right
        _, feature, last, *_ = known[path].best
        splits.append((ids[path], feature, last, left, right))
    return splits, ids


def _look(blocks: RDD, splits: list[Split], nodes: list[int], start: _Start) -> tuple[np.ndarray, int, int]:
    """One pass: the histograms (nodes, features, 3, bins) of ``nodes`` (leaves of the tree so
    far), and without splits the held-back rows and their loss."""
    unit, wide = start.unit, len(start.sizes)
    growing = Tree(splits, {})

    def summed(blocks):
        total = np.zeros((len(nodes), wide, 3, MAX_BINS + 1), np.int64)
        held_rows, held_loss = 0, 0
        for bins, label, held, raw in blocks:
            if not splits:  # the first pass of a tree also judges the trees before it
                out = held == 1
                loss = np.logaddexp(0, raw[out]) - label[out] * raw[out]
                held_rows += int(out.sum())
                held_loss += int(np.rint(loss * unit).sum())
            own = growing.rows(bins, nodes)
            for slot, node in enumerate(nodes):
                use = own[node][held[own[node]] == 0]
                p = 1 / (1 + np.exp(-raw[use]))
                gradient, hessian = np.rint((p - label[use]) * unit), np.rint(p * (1 - p) * unit)
                for f in range(wide):
                    cell = bins[f][use].astype(np.intp)
                    for k, weight in enumerate((None, gradient, hessian)):
                        total[slot, f, k] += np.bincount(cell, weight, MAX_BINS + 1).astype(np.int64)
        yield total, held_rows, held_loss

    def added(one, other):
        return tuple(a + b for a, b in zip(one, other, strict=True))

    return blocks.mapPartitions(summed).treeReduce(added, 1 if start.tasks <= MANY_TASKS else 2)


def _grown(look, max_leaves: int, start: _Start, l2: float, rate: float) -> tuple[Tree, tuple[int, int]]:
    """One tree, by as many passes as its growth needs, and the held-back rows and loss
    before it.  ``look`` takes splits and node numbers."""
    unit = start.unit
    known = {(): Node(0, 0, 0)}
    sums: dict[tuple, np.ndarray] = {}
    held = (0, 0)
    while True:
        order, unknown, sure = _played(known, max_leaves, unit)
        splits, ids = _numbered(order, known)
        if sure and known[()].asked:
            break
        other = lambda path: (*path[:-1], 1 - path[-1])
        few = {p if not p or known[p].rows <= known[other(p)].rows else other(p): None for p in unknown}
        found, *loss = look(splits, [ids[p] for p in few])
        held = held if splits else tuple(loss)
        sums.update(zip(few, found, strict=True))
        for path in unknown:
            if path not in sums:
                sums[path] = sums[path[:-1]] - sums[other(path)]
            if not path:
                known[path] = Node(*(int(x) for x in sums[path][0].sum(axis=1)))
            node = known[path]
            node.asked = True
            splitting = [(s[0], -f, s) for f, s in enumerate(best_splits(sums[path], start.sizes, unit, l2)) if s]
            if splitting:
                _, feature, (gain, last, *left) = max(splitting)
                node.best = (gain, -feature, last, *left)
    leaves = set(ids) - set(order)
    value = lambda n: -rate * (n.gradient / unit) / (n.hessian / unit + l2) if n.rows else 0.0
    return Tree(splits, {ids[p]: value(known[p]) for p in leaves}), held


def is_over(losses: Sequence[float], patience: int = PATIENCE, tolerance: float = TOLERANCE) -> bool:
    """Whether the last ``patience`` losses are all no more than ``tolerance`` below the one
    before them; ``losses`` begins with the one before the first round."""
    n = len(losses)
    return n > patience and min(losses[n - patience :]) >= losses[n - patience - 1] - tolerance


@dataclass
class _Start:
    """What all rounds share: blocks (in ``folder``), bins of each feature, the unit of the
    fixed-point sums and the number of tasks."""

    blocks: RDD
    folder: str
    sizes: list[int]
    unit: float
    tasks: int


def _begun(
    rows: DataFrame, features: Sequence[str], medians: dict[str, float], label: str, held: Column | None
) -> tuple[BoostedTrees, _Start | None]:
    """The model before its first round, and the blocks to fit it on (None without rows)."""
    spark = rows.sparkSession
    folder = f"{checkpoint_dir(spark)}/boosting-{uuid.uuid4().hex}"
    flag = F.coalesce(held, F.lit(False)) if held is not None else F.lit(False)
    data = rows.select(
        *[filled(c, medians[c]).alias(c) for c in features], F.col(label).cast("double").alias("_label"), flag.cast("double").alias("_held")
    ).checkpoint()
    fitted = data.where("_held = 0")
    fits = F.col("_held") == 0
    every, n, positives = data.agg(F.count(F.lit(1)), F.count(F.when(fits, 1)), F.sum(F.when(fits, F.col("_label")))).first()
    share = min(max((positives or 0) / max(n, 1), 1e-12), 1 - 1e-12)
    model = BoostedTrees(tuple(features), dict(medians), bin_edges(fitted, features), float(np.log(share / (1 - share))))
    if not n:
        return model, None
    # Sums of one unit a row at most stay below 2**62 for any number of rows.
    unit = float(1 << min(UNIT_BITS, 62 - (n - 1).bit_length()))
    tasks = min(spark.sparkContext.defaultParallelism, -(-every // TASK_ROWS))
    _blocks(data.coalesce(tasks), model).write.parquet(folder)
    blocks = _read(spark.read.parquet(folder), len(features)).coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    return model, _Start(blocks, folder, [len(e) + 1 for e in model.edges], unit, blocks.getNumPartitions())


def fit(
    rows: DataFrame,
    features: Sequence[str],
    medians: dict[str, float],
    label: str,
    held: Column | None = None,
    max_iter: int = 100,
    rate: float = 0.08,
    l2: float = 0.1,
    max_leaves: int = 31,
) -> BoostedTrees:
    """Fit on ``rows``; those where ``held`` is true only judge when to stop (None: no
    rows are held back and all rounds are made)."""
    model, start = _begun(rows, features, medians, label, held)
    if start is None:
        return model
    blocks, before, saved = start.blocks, None, start.folder
    while len(model.trees) < max_iter:
        look = lambda splits, nodes: _look(blocks, splits, nodes, start)  # noqa: B023, E731
        tree, (held_rows, held_loss) = _grown(look, max_leaves, start, l2, rate)
        if before is not None:
            before.unpersist()
        if blocks.isCheckpointed():  # what it was made from is no longer needed
            remove_path(rows.sparkSession, saved)
            saved = blocks.getCheckpointFile()
        if held_rows:
            model.losses.append(held_loss / start.unit / held_rows)
            if is_over(model.losses):
                break
        model.trees.append(tree)
        before, blocks = blocks, _scored(blocks, tree)
        if len(model.trees) % REFRESH == 0:
            blocks.checkpoint()
    for stored in (before, blocks):
        if stored is not None:
            stored.unpersist()
    remove_path(rows.sparkSession, saved)
    return model


def first_splits(
    rows: DataFrame, features: Sequence[str], medians: dict[str, float], label: str, l2: float = 0.1
) -> list[tuple]:
    """Per feature: name, bins, and threshold, gain, rows, gradient and Hessian sums of the
    left child of its best split of the first tree's root (None where it has none)."""
    model, start = _begun(rows, features, medians, label, None)
    best: dict[int, tuple] = {}
    if start is not None:
        (sums,), *_ = _look(start.blocks, [], [0], start)
        best = {f: s for f, s in enumerate(best_splits(sums, start.sizes, start.unit, l2)) if s}
        start.blocks.unpersist()
        remove_path(rows.sparkSession, start.folder)
    out = []
    for f, name in enumerate(features):
        edges = model.edges[f]
        if f in best:
            gain, last, n, gradient, hessian = best[f]
            out.append((name, len(edges) + 1, float(edges[last]), gain, n, gradient / start.unit, hessian / start.unit))
        else:
            out.append((name, len(edges) + 1, None, None, None, None, None))
    return out


def _scored(blocks: RDD, tree: Tree) -> RDD:
    """Blocks whose scores have the tree added, kept in storage."""

    def added(block: Block) -> Block:
        bins, label, held, raw = block
        raw = raw.copy()
        tree.add_to(raw, bins)
        return bins, label, held, raw

    return blocks.map(added).persist(StorageLevel.MEMORY_AND_DISK)
