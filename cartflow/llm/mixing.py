"""Mixing sources to target weights with a low-discrepancy schedule.

The mix has ``share`` times the words of all documents.  Sources, in code-point
order (null last), weigh ``weights`` repeating; a target stops at ``most`` times
its source's words and the excess goes to the others by weight.

Slot t of the schedule is the point frac(t * golden ratio); cumulative target
weights map it to a source, and its rank among the source's slots is the block it
takes.  A source's documents, in hash order, form a stream of words that repeats;
the stream up to the target is cut into as many equal blocks as the source has
slots, and blocks join slots on (source, rank).

Running sums and ranks are two-level (chunk totals, then rows within a chunk), so
a source with a third of all rows spreads over tasks.  DataFrame functions only.

Defined results: a null or blank text has no words and is never taken; empty
tables give empty results; a source without a slot of its own gets one at the end
of the schedule; repeated rows are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartflow.llm.common import cut

WORD = r"[^\x20\x09-\x0D]+"
#: frac(golden ratio) as a decimal; products with slot numbers stay exact.
GOLDEN = "0.618033988749894848"
ORDER_BITS, CHUNK_BITS = 60, 10
SLOT_CHUNK = 4096


def source_targets(sized: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Per source: sid (1 ..), source, source_size, target."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # one row for each source
    per = per.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("double")).withColumn("most", most * F.col("source_size"))
    # Sources that fill up first come first.  Taking sources before a row as full
    # and the others as open gives a rate; the largest such rate is the right one.
    filling = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    before = F.coalesce(F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    wanted = share * F.sum("source_size").over(every)
    per = per.withColumn("rate", (wanted - before) / open_weight)
    per = per.withColumn("target", F.least("most", F.max("rate").over(every) * F.col("weight")))
    return per.select("sid", "source", "source_size", "target")


def _streams(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Each document's first word position (``at``) in its source's stream."""
    rows = sized.join(
        sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))
    ).drop("name")
    rows = rows.withColumn("chunk", F.shiftrightunsigned("order", ORDER_BITS - CHUNK_BITS))
    totals = rows.groupBy("sid", "chunk").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("sid", "chunk", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("sid", "chunk").orderBy("order", "doc_id", "size")
    inner = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    return rows.withColumn("inner", inner).join(totals, ["sid", "chunk"]).withColumn("at", F.col("base") + F.col("inner"))


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """Slots (t, sid, rank) of the mix, in the order of t."""
    spark = sources.sparkSession
    total, count = sources.agg(F.sum("target"), F.count("*")).first()
    total = total or 0.0
    n = int(-(-total // block))
    cells = 4 * count + 1024
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = sources.where("target > 0").select("sid", "target", (F.sum("target").over(upto) / (total or 1.0)).alias("high"))
    spans = spans.withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("sid")), F.lit(0.0)))
    spans = spans.withColumn("high", F.when(F.lead("sid").over(Window.orderBy("sid")).isNull(), 1.5).otherwise(F.col("high")))
    cell = lambda x: F.least(F.floor(x * cells), F.lit(cells - 1))
    spans = spans.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.least(F.col("high"), F.lit(1.0))))))
    point = ((F.col("id") + 1).cast("decimal(18,0)") * F.lit(GOLDEN).cast("decimal(18,18)")) % 1
    slots = spark.range(n).select(F.col("id").alias("t"), point.cast("double").alias("point"))
    slots = (
        slots.withColumn("cell", cell(F.col("point")))
        .join(spans.select("sid", "low", "high", "cell"), "cell")
        .where("point >= low and point < high")
        .select("t", "sid", F.expr(f"t div {SLOT_CHUNK}").alias("part"))
    )
    slots = cut(slots)
    missed = sources.where("target > 0").join(slots, "sid", "left_anti")
    last = (n // SLOT_CHUNK) + 1
    slots = slots.unionByName(missed.select(F.lit(n).alias("t"), "sid", F.lit(last).alias("part")))
    totals = slots.groupBy("sid", "part").agg(F.count("*").alias("slots"))
    ahead = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("sid", "part", F.coalesce(F.sum("slots").over(ahead), F.lit(0)).alias("base"))
    inner = F.row_number().over(Window.partitionBy("sid", "part").orderBy("t")) - 1
    return slots.withColumn("inner", inner).join(totals, ["sid", "part"]).select(
        "t", "sid", (F.col("base") + F.col("inner")).alias("rank")
    )


def mix_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    block: int = 1024,
    seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces).  Documents: doc_id, source, size, source_size, target
    and sid, at (place in the stream).  Pieces, the mix itself: slot t, sid, rank,
    doc_id, size, at, first (word of the document), words."""
    # Sixty bits of a digest that other engines have too.
    told = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit("")))
    sized = cut(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.conv(F.substring(F.md5(told), 1, 15), 16, 10).cast("long").alias("order"),
        )
    )
    sources = cut(source_targets(sized, weights, share, most))
    placed = cut(
        _streams(sized, sources).select("doc_id", "source", "size", "source_size", "target", "sid", "at")
    )
    slots = cut(schedule(sources, block))
    counts = slots.groupBy("sid").agg(F.count("*").alias("blocks"))
    # Words of a block; borders are multiples of it, the same on either side.
    step = F.col("limit") / F.col("blocks")
    rows = (
        placed.where("size > 0")
        .join(counts, "sid")
        .withColumn("limit", F.floor("target"))
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(int(-(-most // 1)) - 1))))
        .withColumn("begin", F.col("pass") * F.col("source_size") + F.col("at"))
        .withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("limit")))
        .where("begin < end")
    )
    first, last = F.floor(F.col("begin") / step) - 1, F.floor(F.col("end") / step) + 1
    rows = rows.withColumn(
        "rank", F.explode(F.sequence(F.greatest(first, F.lit(0)), F.least(last, F.col("blocks") - 1)))
    )
    border = lambda r: F.when(r >= F.col("blocks"), F.col("limit")).otherwise(F.floor(r * step))
    rows = rows.withColumn("low", F.greatest("begin", border(F.col("rank")))).withColumn(
        "high", F.least("end", border(F.col("rank") + 1))
    )
    pieces = (
        rows.where("low < high")
        .join(slots, ["sid", "rank"])
        .select(
            "t", "sid", "rank", "doc_id", "size", "at",
            (F.col("low") - F.col("begin")).alias("first"), (F.col("high") - F.col("low")).alias("words"),
        )
    )
    return placed, pieces


def taken(docs: DataFrame, **how) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words that the mix
    takes, repeats counted) and first_slot (of the schedule; null if never)."""
    placed, pieces = mix_documents(docs, **how)
    sums = pieces.groupBy("sid", "at", "doc_id", "size").agg(F.sum("words").alias("taken"), F.min("t").alias("first_slot"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("sid", "at", "doc_id", "size")]
    return (
        placed.alias("p")
        .join(sums.alias("s"), same, "left")
        .select(
            "p.doc_id", "p.size", "p.source_size", "p.target", F.coalesce("s.taken", F.lit(0)).alias("taken"), "s.first_slot"
        )
    )
