"""Toxicity scores: a linear classifier over character n-grams whose features are
scaled by naive Bayes log-count ratios.

A feature is the presence of a hashed n-gram of code points (A-Z lower-cased,
white space as blanks), or its presence more than once.  Document counts of every feature and class cover all
labelled training rows and give each feature its ratio
log(P(feature | toxic) / P(feature | clean)), shrunk towards zero for rare
features and zero where the classes do not differ significantly.  A logistic
regression on the ratios of a text's features is fitted in numpy on a bounded sample
of labelled rows (``sample_rows`` at most, and as many as have ``SAMPLE_FEATURES``
features together by the mean; in hash order, half of them for each class where there
are as many; weights restore the classes' proportions).  Scoring covers whole texts.

Only the text enters a score.  Defined results: null and empty texts have no
features and get the model's bias; rows with a null label or doc_id train
nothing; several labels of one doc_id count as toxic if one of them is; with
labels of one class only (or none) every score is that class's rate (0 without
labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import held_out, list_array, per_slice, received, share, small

ORDERS = (4, 5, 6)
#: Hashed features, half of them for repeated n-grams.
BITS = 19
SAMPLE_ROWS = 12000
#: Features of all sampled rows together, about: what the driver holds (4 bytes each).
SAMPLE_FEATURES = 12_000_000
#: Labels up to this number are sent to all tasks; more are joined by a shuffle.
BROADCAST_LABELS = 2_000_000
#: Weight of the prior in the log-count ratios, in documents.
SMOOTHING = 2.0
#: Standard errors by which a feature's shares must differ between the classes.
DEVIATIONS = 4.0
EPOCHS = 30
_FACTORS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0x7FEB352D)


def _positions(text: bytes | None) -> np.ndarray:
    """Hash of the n-gram at every position of a text, for all orders."""
    codes = np.frombuffer((text or b"").lower().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    codes = np.where((codes >= 9) & (codes <= 13), np.uint32(32), codes)
    out, total = [], np.zeros(len(codes), np.uint32)
    for j in range(max(ORDERS)):
        n = len(codes) - j
        if n <= 0:
            break
        total = total[:n] + (codes[j:] + np.uint32(j + 1)) * np.uint32(_FACTORS[j])
        total = total ^ (total >> np.uint32(15))
        if j + 1 in ORDERS:
            out.append((total * np.uint32(0x2C1B3C6D)) >> np.uint32(33 - BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def gram_features(text: bytes | None, wanted: np.ndarray | None = None) -> np.ndarray:
    """Distinct features of a text; ``wanted`` (by n-gram) keeps the others out early."""
    found = _positions(text)
    if wanted is not None:
        found = found[wanted[found]]
    found = np.sort(found)
    new = np.ones(len(found), bool)
    new[1:] = found[1:] != found[:-1]
    again = ~new
    again[1:] &= new[:-1]  # each repeated n-gram once
    return np.concatenate((found[new], found[again] + np.uint32(1 << (BITS - 1)))).astype(np.int32)


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # of each hashed feature: fitted weight times log-count ratio
    bias: float

    def wanted(self) -> np.ndarray:
        """The n-grams of which some feature has a weight."""
        return (self.weight.reshape(2, -1) != 0).any(axis=0)

    def score(self, text: bytes | None, wanted: np.ndarray | None = None) -> float:
        found = gram_features(text, wanted)
        z = self.bias + float(self.weight[found].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and label (0 or 1) of labelled rows outside the held-out fold."""
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.join(small(marked, BROADCAST_LABELS), "doc_id")


def feature_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents of each class (2) and with each feature (2 x 2**BITS), over all rows."""

    def step(batches):
        counts = np.zeros((2, 1 << BITS), np.int64)
        totals = np.zeros(2, np.int64)
        for batch in batches:
            for text, label in zip(
                batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                counts[label, gram_features(text)] += 1
                totals[label] += 1
        some = np.flatnonzero(counts.sum(axis=0))
        feature = np.concatenate((some, [-1])).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(feature), *(pa.array(np.concatenate((counts[k, some], [totals[k]]))) for k in (0, 1))],
            ["feature", "clean", "toxic"],
        )

    # At most 2**BITS + 1 rows reach the driver, whatever the corpus.
    got = (
        rows.select("text", "label")
        .mapInArrow(step, "feature int, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .toArrow()
    )
    feature = got.column("feature").to_numpy()
    pairs = np.stack([got.column("clean").to_numpy(), got.column("toxic").to_numpy()])
    counts = np.zeros((2, 1 << BITS), np.int64)
    real = feature >= 0
    counts[:, feature[real]] = pairs[:, real]
    return pairs[:, ~real].sum(axis=1), counts


def log_ratios(totals: np.ndarray, counts: np.ndarray) -> np.ndarray:
    prior = totals / totals.sum()
    share = (counts + SMOOTHING * prior[:, None]) / (totals[:, None] + SMOOTHING)
    ratio = np.log(share[1] / share[0])
    # A ratio counts as far as the two shares differ beyond chance.
    both = (counts.sum(axis=0) + 1) / (totals.sum() + 2)
    error = np.sqrt(both * (1 - both) * (1 / totals).sum())
    apart = np.abs(share[1] - share[0]) / error
    ratio[apart < DEVIATIONS] = 0
    return ratio.astype(np.float32)


def _logistic(rows: list[np.ndarray], label: np.ndarray, weight: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Adagrad on single rows in shuffled order; features are scaled by ``ratio``."""
    rng = np.random.default_rng(5)
    w, square = np.zeros(len(ratio), np.float32), np.full(len(ratio), 1e-6, np.float32)
    bias = float(np.log(np.average(label, weights=weight) / (1 - np.average(label, weights=weight))))
    start, total = bias, 1.0
    for epoch in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at = rows[i]
            x = ratio[at] / np.float32(10)
            z = bias + float(w[at] @ x)
            g = float(weight[i] * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - label[i]))
            step = g * x + np.float32(1e-4) * w[at]
            square[at] += step * step
            w[at] -= 0.1 * step / np.sqrt(square[at])
            total += g * g
            bias -= 0.1 * (g + 1e-3 * (bias - start)) / np.sqrt(total)
    return w * ratio / np.float32(10), bias


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    rows = training_rows(docs, labels)
    totals, counts = feature_counts(rows)
    if not totals.all():
        rate = totals[1] / totals.sum() if totals.sum() else 0.0
        return Model(np.zeros(1 << BITS, np.float32), float(50 * (2 * rate - 1)))
    ratio = log_ratios(totals, counts)
    # Significant features of a labelled row, on average over all of them.
    mean = counts[:, ratio != 0].sum() / totals.sum()
    sample_rows = min(sample_rows, max(2, int(SAMPLE_FEATURES / max(mean, 1))))
    room = [max(sample_rows // 2, sample_rows - int(totals[1 - k])) for k in (0, 1)]
    ids = None
    for label in (0, 1):
        part = rows.where(F.col("label") == label).select("doc_id").distinct()
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(room[label])
        ids = part if ids is None else ids.unionByName(part)
    sample = rows.join(F.broadcast(ids), "doc_id", "left_semi")  # sample_rows ids at most
    sample = sample.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # one row of each

    def step(batch, texts):
        found = [gram_features(t) for t in texts]
        found = [np.sort(f[ratio[f] != 0]) for f in found]
        flat = np.concatenate(found) if found else np.zeros(0, np.int32)
        lists = list_array(flat, np.array([len(f) for f in found], np.int64), pa.int32())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists], ["doc_id", "label", "found"])

    sample = sample.select("doc_id", "text", "label")
    got = sample.mapInArrow(per_slice(step), "doc_id long, label int, found array<int>").orderBy("doc_id", "found").toArrow()
    label = got.column("label").to_numpy().astype(np.float64)
    found = got.column("found").combine_chunks()
    flat, cuts = found.flatten().to_numpy(), found.value_lengths().to_numpy()
    features = np.split(flat, np.cumsum(cuts)[:-1])
    share = np.array([(label == k).sum() for k in (0, 1)])
    weight = (totals / totals.sum() * len(label) / share)[label.astype(int)]
    return Model(*_logistic(features, label, weight, ratio))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5 on) of each whole text; a
    struct column ``rest`` and the text are carried along."""
    carry = ["rest"] if "rest" in docs.columns else []
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry
    )
    shared = share(docs.sparkSession, model)  # 2 MB, whatever the corpus

    def model_of_task() -> tuple[Model, np.ndarray]:
        own = received(shared)
        return own, own.wanted()

    def step(batch, texts, ready):
        own, wanted = ready
        marks = pa.array([own.score(t, wanted) for t in texts], pa.float64())
        made = [*batch.columns, marks]
        return pa.RecordBatch.from_arrays(made, [*batch.schema.names, "score"])

    schema = "doc_id long, text string" + (f", rest {plain.schema['rest'].dataType.simpleString()}" if carry else "")
    scored = plain.mapInArrow(per_slice(step, once=model_of_task), schema + ", score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
