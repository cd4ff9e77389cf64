"""Merkle dataset manifest by time-forward processing.

Every row is a leaf, the SHA-256 of its length-prefixed fields.  The leaves of a
group ascend by their order; while several nodes remain, every ``fanout``
consecutive ones (the last run may have fewer, even one) become the SHA-256 of
their joined digests.  What remains is the group's subroot; the subroots, in the
order of the groups, make one more tree, whose top is the root.

Time-forward processing sends digests along the tree's edges through a priority
queue ordered by node label, so that a node's messages are there when its turn
comes.  Labels are (tier, block, level, index): ``fanout**LEVELS`` consecutive nodes
are a block.  What a block's nodes send each other waits in a queue of one block's
size; what blocks send each other goes through Spark's sorted shuffle, which is the
queue's external part and spills to disk.  The tops of the blocks are the next
tier's nodes, so 10 levels take one shuffle, and no task holds more than a block.
The sweep is then reversed, tier by tier: a node gets the steps of the path above it
(its proof's suffix), adds its children's siblings and hands them on, down to the
leaves.

Defined results: null fields are ``-``; rows without a group form a group of their own,
which comes first; rows without an order value come last in their group; rows of equal
order value ascend by leaf, and rows equal in all of these are interchangeable; a lone
leaf is its own subroot and has an empty proof where its group is alone; an empty
table has no row; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartflow.llm.common import cut, small
from cartflow.operators.ranks import frozen_ranges

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a tier: a block is fanout**LEVELS nodes.
LEVELS = 10
#: Rows of (range, group) counts that are sent to all tasks; more are shuffled.
BROADCAST_RUNS = 100_000

Step = tuple[str, str]


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values, each ``-`` or its UTF-8 byte count, ``:`` and itself."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _join(digests: Sequence[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def climb(digests: Sequence[str], fanout: int, levels: int, stop: bool) -> list[list[str]]:
    """The digests of a block's nodes by level, the given ones first: ``levels``
    levels above them, or with ``stop`` only until one node remains.

    The queue holds (label, child number, digest); all messages of the least label
    have come when it is taken, since children have lower labels."""
    widths = [len(digests)]
    while len(widths) <= levels and not (stop and widths[-1] == 1):
        widths.append(-(-widths[-1] // fanout))
    made: list[list[str]] = [list(digests)] + [[] for _ in widths[1:]]
    queue = [((1, i // fanout), i % fanout, d) for i, d in enumerate(digests)] if len(widths) > 1 else []
    heapq.heapify(queue)
    while queue:
        label, *_ = queue[0]
        come = []
        while queue and queue[0][0] == label:
            come.append(heapq.heappop(queue)[2])
        level, index = label
        digest = _join(come)
        made[level].append(digest)
        if level + 1 < len(widths):
            heapq.heappush(queue, ((level + 1, index // fanout), index % fanout, digest))
    return made


def descend(made: list[list[str]], fanout: int, above: tuple[Step, ...]) -> list[tuple[Step, ...]]:
    """For each lowest node of a block: the steps from it to the root, each the joined
    siblings before and after it.  ``above``: the steps above the block's top.

    The sweep of ``climb`` reversed: the greatest label is taken first and sends each
    child its sibling step and the steps above."""
    found: list[tuple[Step, ...]] = [()] * len(made[0])
    queue = [(-(len(made) - 1), 0, above)]
    while queue:
        level, index, steps = heapq.heappop(queue)
        level, index = -level, -index
        if level == 0:
            found[index] = steps
            continue
        first = index * fanout
        run = made[level - 1][first : first + fanout]
        for i in range(len(run)):
            step = ("".join(run[:i]), "".join(run[i + 1 :]))
            heapq.heappush(queue, (-(level - 1), -(first + i), (step, *steps)))
    return found


def _runs(batch: pa.RecordBatch, *keys: str) -> Iterator[tuple[tuple, int, int]]:
    """Runs of equal keys as (keys, first row, end)."""
    columns = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
    rows = list(zip(*columns, strict=True))
    begin = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or rows[i] != rows[begin]:
            yield rows[begin], begin, i
            begin = i


def _blocks(batches) -> Iterator[tuple[tuple[str, int], pa.Table]]:
    """The rows of each (grp, block), which the sort brings one after another."""
    key, held = None, []
    for batch in batches:
        for own, begin, end in _runs(batch, "grp", "block"):
            if own != key and held:
                yield key, pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(begin, end - begin))
    if held:
        yield key, pa.Table.from_batches(held)


def _alone(key: tuple[str, int], n: int, size: int) -> bool:
    """A first block that is not full has no other beside it: its tree ends at one
    node.  (A full one has one node left after all levels, with or without others.)"""
    return key[1] == 0 and n < size


def _in_blocks(nodes: DataFrame, size: int, *order: str) -> DataFrame:
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = nodes.withColumn("block", F.floor(F.col("pos") / size)) if "block" not in nodes.columns else nodes
    return nodes.repartition(parts, "grp", "block").sortWithinPartitions("grp", "block", *order)


def _tops(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The top digest of every block of (grp, pos, digest), as nodes of the next tier."""
    size = fanout**levels

    def up(batches):
        for key, rows in _blocks(batches):
            digests = rows.column("digest").to_pylist()
            made = climb(digests, fanout, levels, _alone(key, len(digests), size))
            yield pa.RecordBatch.from_pylist([{"grp": key[0], "pos": key[1], "digest": made[-1][0]}], _NODE)

    return _in_blocks(nodes.select("grp", "pos", "digest"), size, "pos").mapInArrow(up, "grp string, pos long, digest string")


_NODE = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("digest", pa.string())])


def _tiers(nodes: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """The nodes of every tier; the last has one node (pos 0) a group."""
    tiers = [nodes]
    while True:
        tiers.append(cut(_tops(tiers[-1], fanout, levels)))
        if tiers[-1].where("pos > 0").isEmpty():
            return tiers


def _suffixes(nodes: DataFrame, above: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` (grp, pos, digest, others) with ``before``, ``after`` (a path step each)
    and ``subroot``; ``above`` holds them for the tops of blocks, by (grp, pos)."""
    size = fanout**levels
    others = [c for c in nodes.columns if c not in ("grp", "pos")]
    steps = ("before", "after", "subroot")
    both = nodes.withColumns({"block": F.floor(F.col("pos") / size), "before": F.lit(None).cast("array<string>"),
                              "after": F.lit(None).cast("array<string>"), "subroot": F.lit(None).cast("string")})
    heads = above.select("grp", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), *steps)
    merged = both.unionByName(heads, allowMissingColumns=True)
    out = T.StructType([*nodes.schema.fields, *[both.schema[c] for c in steps]])

    def down(batches):
        for key, rows in _blocks(batches):
            head, rows = rows.slice(0, 1), rows.slice(1)
            before, after, subroot = (head.column(c)[0].as_py() for c in steps)
            digests = rows.column("digest").to_pylist()
            made = climb(digests, fanout, levels, _alone(key, len(digests), size))
            paths = descend(made, fanout, tuple(zip(before, after, strict=True)))
            found = pa.table(
                {
                    **{c: rows.column(c) for c in ("grp", "pos", *others)},
                    "before": pa.array([[s[0] for s in p] for p in paths], pa.list_(pa.string())),
                    "after": pa.array([[s[1] for s in p] for p in paths], pa.list_(pa.string())),
                    "subroot": pa.array([subroot] * len(paths), pa.string()),
                }
            ).select(out.names)
            yield from found.combine_chunks().to_batches()

    return _in_blocks(merged, size, "pos").mapInArrow(down, out)


def _proofs(tiers: list[DataFrame], above: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The reversed sweep over all tiers; ``above``: grp, pos, before, after, subroot of
    the last tier's nodes."""
    for k in range(len(tiers) - 2, -1, -1):
        above = _suffixes(tiers[k], above, fanout, levels)
        if k:
            above = above.drop("digest")
    return above


def _positions(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` with ``pos``, their 0-based place in their ``grp``, by the total order
    ``order``, and computed once.  No task sorts a whole group: ranges of (grp, order)
    are sorted and frozen, and a group's place in a range follows from the counts of
    its rows in earlier ranges."""
    nodes = nodes.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col("grp").asc(), *[F.col(c).asc_nulls_last() for c in order], F.col("_tie").asc()]
    ranged = frozen_ranges(nodes, keys).drop("_tie")
    runs = ranged.groupBy("grp", "_range").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("grp").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = cut(runs.withColumn("_ahead", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"))
    placed = ranged.join(small(runs, BROADCAST_RUNS), ["grp", "_range"])
    return placed.withColumn("pos", F.col("_ahead") + F.col("_pos") - F.col("_first")).drop("_range", "_pos", "_ahead", "_first")


def tree(leaves: DataFrame, group: str, order: str, fanout: int = 2, levels: int = LEVELS) -> DataFrame:
    """``leaves`` (with a string column ``leaf``) and, for each: ``before`` and ``after``
    (arrays of the joined siblings before and after the node, level by level from the
    leaf to the root), ``subroot`` and ``root``."""
    if fanout < 2 or levels < 1:
        raise ValueError("fanout must be 2 or more and levels 1 or more")
    spark = leaves.sparkSession
    # A prefix keeps the bytewise order and lets the null group come before the empty name.
    grp = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    nodes = leaves.select(grp.alias("grp"), F.col(order).alias("at"), F.col("leaf").alias("digest"), F.struct("*").alias("row"))
    nodes = _positions(nodes, "at", "digest").drop("at")
    tiers = _tiers(nodes, fanout, levels)

    tops = tiers[-1].select(F.lit("").alias("grp"), F.col("grp").alias("at"), "digest")
    forest = _tiers(_positions(tops, "at"), fanout, levels)
    top = forest[-1].first()  # one row: the root
    root = top["digest"] if top else None
    none = F.array().cast("array<string>")
    start = spark.range(1).select(
        F.lit("").alias("grp"), F.lit(0).cast("long").alias("pos"), none.alias("before"), none.alias("after"),
        F.lit(None).cast("string").alias("subroot"),
    )
    if root is None:
        start = start.limit(0)
    subroots = _proofs(forest, start, fanout, levels)
    above = cut(
        subroots.select(F.col("at").alias("grp"), F.lit(0).cast("long").alias("pos"), "before", "after", F.col("digest").alias("subroot"))
    )
    found = _proofs(tiers, above, fanout, levels)
    return found.select("row.*", "before", "after", "subroot", F.lit(root).cast("string").alias("root"))


def fold(leaf: Column, before: Column, after: Column) -> Column:
    """The root that a leaf and its path's siblings lead to."""
    return F.aggregate(
        F.arrays_zip(before.alias("before"), after.alias("after")),
        leaf,
        lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]), 256),
    )


def proof_digest(before: Column, after: Column) -> Column:
    """SHA-256 of a path's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(before, after, lambda b, a: F.concat(b, a)), ""), 256)


def manifest(docs: DataFrame, fanout: int = 2, levels: int = LEVELS) -> DataFrame:
    """Per document: doc_id, leaf, tampered (the leaf after one is added to n_chars, for
    the documents whose id's crc32 is divisible by 7; else null), before, after, subroot
    and root, one tree for each lang."""
    own = {c: F.col(c) for c in FIELDS}
    more = own | {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaves = docs.select(
        "doc_id", "lang",
        leaf_digest(list(own.values())).alias("leaf"),
        F.when(struck, leaf_digest(list(more.values()))).alias("tampered"),
    )
    return tree(leaves, "lang", "doc_id", fanout, levels).drop("lang")


def verified(rows: DataFrame) -> DataFrame:
    """``manifest`` rows with ``proof_sha256``, ``folded_root`` (of the tampered leaf where
    there is one) and ``verified``."""
    path = (F.col("before"), F.col("after"))
    folded = fold(F.coalesce("tampered", "leaf"), *path)
    return rows.withColumns({"proof_sha256": proof_digest(*path), "folded_root": folded}).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )
