"""The corpus pipeline: toxicity, line dedup, near-dedup, benchmark
decontamination and source mixing, in this order.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns
a DataFrame that is written and read again as the next one's ``docs``.  All but
the last return the columns of ``docs``; the last returns, for every document left,
what the mix takes of it.

Rows without doc_id pass the filters on their own text and are never grouped with
others.  Other columns of ``docs``, whatever their names, are carried along.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm import decontam, linededup, minhash, mixing, toxicity
from cartflow.llm.common import remove, table
from cartflow.session import checkpoint_dir

ORACLE_SQL = None


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id and text, with all other columns in a struct named rest."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others, F.lit(0).alias("_")).alias("rest"))


def _unpacked(rows: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``; n_chars follows the text."""
    out = []
    for c in like.columns:
        if c in ("doc_id", "text"):
            out.append(F.col(c))
        elif c == "n_chars":
            out.append(F.length("text").cast(like.schema[c].dataType).alias(c))
        else:
            out.append(F.col("rest")[c].alias(c))
    return rows.select(*out)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(_packed(docs), model)
    return _unpacked(scored.where("predicted = 0"), docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more of them share."""
    return _unpacked(linededup.LineIndex.build(docs).rewrite(_packed(docs)), docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles); of its rows,
    those of different texts."""
    kept = minhash.near_duplicates(docs, width=5, percent=80).where("kept and doc_id is not null").select("doc_id")
    named = docs.where("doc_id is not null").join(kept.distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id is null"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document, and its first slot."""
    return mixing.taken(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what passes between them lies in the shared
    checkpoint folder, a stage's rows until the next one's are written.  The rows
    returned are read from there."""
    folder = os.path.join(checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(before)
        before = path
    return docs
