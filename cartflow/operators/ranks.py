"""Exact global ranks, cumulative sums and quantiles without a one-task sort.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
Instead:

1. ``repartitionByRange(n, *order)``: Spark samples the key and cuts it into
   ``n`` ordered ranges (the order must be total, so ties on the score are
   spread by the tie-breakers and no range is hot);
2. sort inside each range and tag rows with ``monotonically_increasing_id``
   (partition index in the high bits, position in the low 33 bits);
3. ``checkpoint()`` to the shared checkpoint folder: the sampled bounds and
   the ids are frozen, so a lost executor cannot make a recomputation see a
   different layout;
4. per-range row counts (``n`` rows) -> exclusive prefix -> broadcast join
   (bounded by ``n``) -> rank = prefix + position.

Cumulative sums use the same frozen layout: per-range totals give the
offset; the running sum inside a range is a window partitioned by range.

Quantiles need no order of all values: a sketch brackets them and exact counts
place the brackets (``quantile_values``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartflow.session import checkpoint_dir

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _num_ranges(df: DataFrame, num_ranges: int | None) -> int:
    if num_ranges:
        return num_ranges
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)


def frozen_ranges(df: DataFrame, order: Sequence[Column], num_ranges: int | None = None) -> DataFrame:
    """Range-partition by ``order``, sort inside ranges, tag ``_range`` and
    ``_pos`` (0-based position in range) and checkpoint the result."""
    checkpoint_dir(df.sparkSession)
    n = _num_ranges(df, num_ranges)
    # Sampling and shuffling both read the input; what lies before its last
    # shuffle is computed once, since that shuffle's files serve both.
    return (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright(F.col("_mid"), _POS_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_POS_MASK)))
        .drop("_mid")
        .checkpoint(eager=True)
    )


def _range_offsets(tagged: DataFrame, sums: Sequence[str] = ()) -> DataFrame:
    """Exclusive prefix of row counts (and of ``sums``) over ranges.

    One row per range, so the single-task window here is bounded by the
    number of ranges."""
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.sum(c).alias(f"_s_{c}") for c in sums]
    per = tagged.groupBy("_range").agg(*aggs)
    w = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    cols = [F.col("_range"), F.coalesce(F.sum("_rows").over(w), F.lit(0)).alias("_off_rows"),
            F.sum("_rows").over(everything).alias("_total_rows")]
    cols += [F.coalesce(F.sum(f"_s_{c}").over(w), F.lit(0)).alias(f"_off_{c}") for c in sums]
    cols += [F.sum(f"_s_{c}").over(everything).alias(f"_total_{c}") for c in sums]
    return per.select(*cols)


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    rank_col: str = "rank",
    num_ranges: int | None = None,
    total_col: str | None = None,
) -> DataFrame:
    """Add a 1-based position ``rank_col`` in the total order ``order`` (and
    the row count as ``total_col`` when named)."""
    tagged = frozen_ranges(df, order, num_ranges)
    offsets = _range_offsets(tagged)
    out = tagged.join(F.broadcast(offsets), "_range")
    out = out.withColumn(rank_col, F.col("_off_rows") + F.col("_pos") + F.lit(1))
    if total_col:
        out = out.withColumnRenamed("_total_rows", total_col)
    return out.drop("_range", "_pos", "_off_rows", "_total_rows")


def cumulative(
    df: DataFrame,
    order: Sequence[Column],
    cols: Sequence[str],
    num_ranges: int | None = None,
) -> DataFrame:
    """Add ``rank``, inclusive running sums ``cum_<c>`` along ``order`` and
    the grand totals ``total_<c>``."""
    tagged = frozen_ranges(df, order, num_ranges)
    offsets = _range_offsets(tagged, cols)
    # By range, so that each task keeps one range and none meets another.
    tagged = tagged.repartitionByRange(_num_ranges(df, num_ranges), "_range")
    out = tagged.join(F.broadcast(offsets), "_range")
    in_range = Window.partitionBy("_range").orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    adds = {"rank": F.col("_off_rows") + F.col("_pos") + F.lit(1)}
    for c in cols:
        adds[f"cum_{c}"] = F.col(f"_off_{c}") + F.sum(c).over(in_range)
        adds[f"total_{c}"] = F.col(f"_total_{c}")
    out = out.withColumns(adds)
    return out.drop("_range", "_pos", "_off_rows", "_total_rows", *[f"_off_{c}" for c in cols],
                    *[f"_total_{c}" for c in cols])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n, cum_n, total_n) for the distinct non-NULL values of ``col``
    in ascending order.  Equal values are one row before any ordering, so a
    value that many rows share is no hot range."""
    values = df.select(F.col(col).cast("double").alias("value")).where(F.col("value").isNotNull())
    counts = values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return cumulative(counts, [F.col("value").asc()], ["n"]).drop("rank")


#: Relative accuracy of the sketch is one in this; values that the driver reads a place.
SKETCH, FEW = 10_000, 5_000


@dataclass
class _Place:
    """A 0-based place in the order of a column's values, and what is known of the value
    there: it lies strictly between ``low`` and ``high`` (None: no bound), with ``before``
    values up to ``low`` and ``upto`` values before ``high``."""

    column: str
    place: int
    before: int
    upto: int
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def inside(self) -> Column:
        v = F.col(self.column)
        fits = v.isNotNull()
        if self.low is not None:
            fits = fits & (v > F.lit(self.low))
        return fits & (v < F.lit(self.high)) if self.high is not None else fits

    @property
    def open(self) -> bool:
        return self.value is None


def _numbers(rows: DataFrame, aggregates: list[Column]) -> list:
    """One row of numbers (none for no aggregates)."""
    return list(rows.agg(*[c.alias(f"_{i}") for i, c in enumerate(aggregates)]).first()) if aggregates else []


def _neighbours(places: Sequence[_Place]) -> list[list[_Place]]:
    """Runs of neighbouring places of a column with the same bounds: one bracket serves all."""
    runs: list[list[_Place]] = []
    for p in sorted(places, key=lambda p: (p.column, p.place)):
        last = runs[-1][-1] if runs else None
        if last and (last.column, last.place + 1, last.low, last.high) == (p.column, p.place, p.low, p.high):
            runs[-1].append(p)
        else:
            runs.append([p])
    return runs


def _settle(rows: DataFrame, places: list[_Place]) -> None:
    """Find the values at the places.  A sketch brackets each, one exact count places the
    bracket's two ends; a place that is neither end's goes on strictly between them, until
    a few thousand values are left, whose counts the driver reads."""
    while wide := [p for p in places if p.open and p.upto - p.before > FEW]:
        ends, near = [], _neighbours(wide)
        for run in near:
            p, margin = run[0], 2 / SKETCH
            first, last = ((x.place - p.before) / (p.upto - p.before) for x in (p, run[-1]))
            ends.append(F.percentile_approx(F.when(p.inside(), F.col(p.column)), [max(0.0, first - margin), min(1.0, last + margin)], SKETCH))
        brackets = _numbers(rows, ends)
        counts = []
        for run, (low, high) in zip(near, brackets, strict=True):
            v = F.col(run[0].column)
            counts += [F.count(F.when(fits, 1)) for fits in (v < F.lit(low), v <= F.lit(low), v < F.lit(high), v <= F.lit(high))]
        told = _numbers(rows, counts)
        of = [(p, k) for k, run in enumerate(near) for p in run]
        for p, k in of:
            (low, high), (below_low, to_low, below_high, to_high) = brackets[k], told[4 * k : 4 * k + 4]
            if below_low <= p.place < to_low:
                p.value = low
            elif below_high <= p.place < to_high:
                p.value = high
            elif p.place < below_low:  # the sketch missed it: between the old end and the new
                p.high, p.upto = low, below_low
            elif p.place >= to_high:
                p.low, p.before = high, to_high
            else:
                p.low, p.before, p.high, p.upto = low, to_low, high, below_high
    left = [p for p in places if p.open]
    if not left:
        return
    per = [F.when(p.inside(), F.struct(F.lit(i).alias("i"), F.col(p.column).alias("value"))) for i, p in enumerate(left)]
    long = rows.select(F.inline(F.filter(F.array(*per), lambda x: x.isNotNull())))
    values: dict[int, list[tuple[float, int]]] = {}
    for r in long.groupBy("i", "value").agg(F.count(F.lit(1)).alias("n")).collect():  # FEW rows a place at most
        values.setdefault(r["i"], []).append((r["value"], r["n"]))
    for i, p in enumerate(left):
        at = p.before
        for value, n in sorted(values[i]):
            at += n
            if p.place < at:
                p.value = value
                break


def quantile_values(df: DataFrame, probs: dict[str, Sequence[float]]) -> dict[str, tuple[list[float | None], int]]:
    """For each column its linear-interpolation quantiles (NULLs ignored, NaN last; None
    without values) and its number of distinct values, 3 standing for three or more.

    Exact, without ordering or shuffling the values: a few aggregates in one pass each."""
    rows = df.select(*[(F.col(f"`{c}`").cast("double") + F.lit(0.0)).alias(c) for c in probs])  # -0.0 is 0.0
    firsts = []
    for c in probs:
        number = F.when(~F.isnan(c), F.col(c))
        firsts += [F.count(number), F.count(c), F.min(number), F.max(number)]
    told = _numbers(rows, firsts)
    size = {c: told[4 * k : 4 * k + 4] for k, c in enumerate(probs)}
    plain = rows.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in probs])
    between = _numbers(plain, [F.count(F.when((F.col(c) > F.lit(size[c][2])) & (F.col(c) < F.lit(size[c][3])), 1)) for c in probs])
    places: dict[tuple[str, int], _Place] = {}
    for c, wanted in probs.items():
        n, every = size[c][:2]
        for p in wanted:
            h = (every - 1) * float(p)
            for at in {math.floor(h), math.ceil(h)}:
                if 0 <= at < n:
                    places[c, at] = _Place(c, at, 0, n)
    _settle(plain, list(places.values()))

    out = {}
    for k, (c, wanted) in enumerate(probs.items()):
        n, every, low, high = size[c]
        got: list[float | None] = []
        for p in wanted:
            h = (every - 1) * float(p)
            a, b = (places[c, at].value if (c, at) in places else math.nan for at in (math.floor(h), math.ceil(h)))
            got.append(None if not every else a if a == b else a + (b - a) * (h - math.floor(h)))
        distinct = (n > 0) + (n > 0 and low != high) + (between[k] > 0)
        out[c] = (got, min(3, distinct + (every > n)))
    return out


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], prefix: str = "q") -> DataFrame:
    """One row with the linear-interpolation quantiles of ``col`` (NULLs
    ignored), ``<prefix>_0 .. <prefix>_{k-1}`` (NULL when there are no values),
    and ``<prefix>_kinds``, the number of distinct values (3: three or more).

    Same definition as ``percentile`` / ``quantile_cont``: h = (n-1)p,
    value = v[floor h] + (h - floor h) * (v[ceil h] - v[floor h]).
    """
    values, distinct = quantile_values(df, {col: probs})[col]
    names = ", ".join(f"{prefix}_{i} double" for i in range(len(probs)))
    return df.sparkSession.createDataFrame([(*values, distinct)], f"{names}, {prefix}_kinds long")


def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Median of each column (NULLs ignored): all columns in the same passes."""
    return {c: values[0] for c, (values, _) in quantile_values(df, {c: [0.5] for c in cols}).items()}
