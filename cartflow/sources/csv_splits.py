"""Large CSV files in many splits, quoted newlines included.

Whether a newline ends a record depends on the quotes before it.  A first pass over the
blocks of all files counts their quotes and finds, for both cases (a quoted field is open
at the block's start, or not), where the block's first record begins.  The running parity
of quotes (a window over a file's blocks) tells which case holds, so every block knows its
records: from its own first one to the next block's.  A second pass reads those ranges and
cuts them into records, which Spark's own CSV parser takes apart.

A quote inside a quoted field is doubled, so it does not change the parity.  Where a
file's first line ends with a carriage return, such line ends read as newlines inside
quotes too, as the parser has it for a whole file.  A file whose
quotes do not match reads as one reader from its start would read it: what follows the
last open quote is one record.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartflow.sources.files import located

# Tasks get this module's functions (and those of files) by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a block, and of a piece that a task holds at a time.
BLOCK_BYTES, PIECE_BYTES = 64 << 20, 1 << 20
_QUOTE, _NEWLINE = ord('"'), ord("\n")


def sizes(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """path and length of every file, from the listing alone."""
    return spark.read.format("binaryFile").load(list(files)).select("path", "length")


def _pieces(file, begin: int, end: int) -> Iterator[bytes]:
    while begin < end:
        piece = file.read_at(min(PIECE_BYTES, end - begin), begin)
        if not piece:
            return
        begin += len(piece)
        yield piece


def look(pieces: Iterator[bytes], begin: int) -> tuple[int, int, int]:
    """Quotes of a block, and where its first record begins if no quoted field is open at
    its start, and if one is (-1: no record begins in it)."""
    quotes, first = 0, [-1, -1]
    for piece in pieces:
        if min(first) < 0:
            raw = np.frombuffer(piece, np.uint8)
            lines = np.flatnonzero(raw == _NEWLINE)
            open_ = (np.searchsorted(np.flatnonzero(raw == _QUOTE), lines) + quotes) % 2
            for case in (0, 1):
                ends = lines[open_ == case]
                if first[case] < 0 and len(ends):
                    first[case] = begin + int(ends[0]) + 1
        quotes += piece.count(b'"')
        begin += len(piece)
    return quotes, first[0], first[1]


def cut(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a range that begins with one."""
    held: list[bytes] = []  # what the open record has so far
    odd = False
    for piece in pieces:
        *lines, rest = piece.split(b"\n")
        for line in lines:
            held.append(line)
            odd ^= line.count(b'"') % 2 == 1
            if not odd:
                yield b"".join(held)
                held = []
            else:
                held.append(b"\n")
        held.append(rest)
        odd ^= rest.count(b'"') % 2 == 1
    if any(held):
        yield b"".join(held)


def _returns(file) -> bool:
    """Whether the first line ends with a carriage return."""
    for piece in _pieces(file, 0, file.size()):
        at = piece.find(b"\n")
        if at >= 0:
            return piece[max(0, at - 1) : at] == b"\r"
    return False


def ranges(spark: SparkSession, files: DataFrame, block: int = BLOCK_BYTES) -> DataFrame:
    """(path, begin, end) of whole records, one for each block in which a record begins,
    from ``files`` (path, length)."""
    last = F.greatest(F.col("length") - 1, F.lit(0))
    blocks = files.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0), last, F.lit(block))).alias("at"))

    def step(batches):
        for batch in batches:
            out = []
            for path, length, at in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                store, place = located(path)
                with store.open_input_file(place) as file:
                    out.append((path, length, at, *look(_pieces(file, at, min(at + block, length)), at)))
            names = ["path", "length", "at", "quotes", "closed", "open"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = "path string, length long, at long, quotes long, closed long, open long"
    seen = blocks.repartition(parts, "path", "at").mapInArrow(step, kinds)
    by_file = Window.partitionBy("path").orderBy("at")  # a row a block
    before = F.coalesce(F.sum("quotes").over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begin = F.when(F.col("at") == 0, F.lit(0)).when(before % 2 == 0, F.col("closed")).otherwise(F.col("open"))
    starts = seen.withColumn("begin", begin).where((F.col("begin") >= 0) & (F.col("begin") < F.col("length")))
    end = F.coalesce(F.lead("begin").over(Window.partitionBy("path").orderBy("begin")), F.col("length"))
    return starts.select("path", "begin", end.alias("end"))


def records(spark: SparkSession, files: DataFrame, block: int = BLOCK_BYTES) -> DataFrame:
    """(path, record) of all records of ``files`` (path, length) but their headers."""

    def step(batches):
        for batch in batches:
            for path, begin, end in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                store, place = located(path)
                with store.open_input_file(place) as file:
                    own, size, header = [], 0, begin == 0
                    returns = _returns(file)
                    for record in cut(_pieces(file, begin, end)):
                        if returns:
                            record = record.removesuffix(b"\r").replace(b"\r\n", b"\n")
                        if header:
                            header = False
                            continue
                        if not record.strip():
                            continue
                        own.append(record)
                        size += len(record)
                        if size >= PIECE_BYTES:
                            yield _batch(path, own)
                            own, size = [], 0
                    if own:
                        yield _batch(path, own)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges(spark, files, block).repartition(parts, "path", "begin").mapInArrow(step, "path string, record string")


def _batch(path: str, own: list[bytes]) -> pa.RecordBatch:
    told = [r.decode("utf-8", "replace") for r in own]
    return pa.RecordBatch.from_arrays([pa.array([path] * len(own)), pa.array(told, pa.string())], ["path", "record"])
