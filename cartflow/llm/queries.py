"""Registered queries of the training-data operators: ``opN_<name>`` applies an
operator, with its production parameters, to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm import decontam, digest, extract, langid, merkle, mixing, toxicity, urlfilter, vectorcodes, warc
from cartflow.llm.common import held_out, table
from cartflow.llm.linededup import dedup_lines
from cartflow.llm.minhash import near_duplicates
from cartflow.llm.oracle import SQL  # noqa: F401
from cartflow.llm.substring import drop_repeats
from cartflow.session import checkpoint_dir


def _sha256(column: str):
    return F.sha2(F.coalesce(F.col(column), F.lit("")), 256)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents on 4-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), width=4, percent=80)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return extract.extract(pages, extract.train(pages)).withColumn("n_chars", F.length("text").cast("long"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more of them share."""
    kept = dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"), min_chars=20, min_docs=3)
    return kept.select("doc_id", "n_lines", "n_dropped", _sha256("text").alias("kept_sha256"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without words of 20-word windows that occur earlier."""
    kept = drop_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), width=20)
    return kept.select("doc_id", "n_words", "n_removed", _sha256("text").alias("kept_sha256"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartile digests of every document and of its edited text."""
    found = digest.fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", "n_chars", _sha256("edited").alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", *[F.round(c, 9).alias(c) for c in ("near_edited", "near_next")],
    )


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix at target source weights takes from every document."""
    mixed = mixing.taken(table(spark, sf_dir, "documents", "doc_id", "source", "text"))
    return mixed.withColumn("target", F.round("target", 6))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents leak, with the best passage of each pair."""
    return decontam.leaks(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or reputation verdict on every page's address."""
    judged = urlfilter.judge_urls(table(spark, sf_dir, "pages", "page_id", "url"), table(spark, sf_dir, "labels"))
    rounded = [F.round(c, 6).alias(c) for c in ("rate", "bound")]
    return judged.select("page_id", "host", "path", "rule", "verdict", "n", "bad", *rounded)


def op11_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of a ZIP-packaged archive, read back by range."""
    folder = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    rows = warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"), folder, min_bytes=0)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every usable vector and the digest of the codebooks."""
    rows, books = vectorcodes.compress(table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding"))
    digest_ = F.lit(vectorcodes.books_digest(books)).alias("codebooks_sha256")
    return rows.select("vec_id", "code", "error", "label_error", digest_)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, tree digests and checked proof of every document."""
    rows = merkle.verified(merkle.manifest(table(spark, sf_dir, "documents", *merkle.FIELDS)))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_extract": op3_extract,
    "op4_line_dedup": op4_line_dedup,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_fingerprint": op6_fingerprint,
    "op7_mix_sources": op7_mix_sources,
    "op8_language": op8_language,
    "op9_decontamination": op9_decontamination,
    "op10_url_filter": op10_url_filter,
    "op11_warc_packages": op11_warc_packages,
    "op12_vector_codes": op12_vector_codes,
    "op13_merkle_manifest": op13_merkle_manifest,
}
