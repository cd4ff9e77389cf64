"""Language identification by a byte convolutional network.

Windows of ``WINDOW`` bytes pass an embedding, filters of several widths, max
pooling over positions and a softmax.  The network is trained in numpy (Adam,
cross-entropy) on at most ``sample_windows`` windows (eight a language where there are
more than an eighth as many languages), four at most of one labelled text, the texts
taken in hash order and evenly from the languages.  All languages are learned.  Applied to whole texts: every window
is scored (the last one padded), in batches, and a text's score is the mean of
its windows' probabilities.  For speed a filter of width w is a sum of table
rows, one for each pair of neighbouring bytes.

Only the text enters a prediction.  Defined results: ``und`` with score 0 for
texts that are null or have no letter, and for all texts if nothing can be
learned; with a single learned language that one, with score 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import cut, held_out, per_slice, received, share, small

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 8
SAMPLE_WINDOWS = 8000
EPOCHS = 6
BATCH = 64
#: Byte classes of the network: padding, then the bytes.
ALPHABET = 257
#: Languages whose counts are sent to all tasks; more are joined by a shuffle.
BROADCAST_LANGUAGES = 100_000


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray  # ALPHABET x EMBED
    banks: list[np.ndarray]  # width * EMBED x FILTERS
    bias: list[np.ndarray]
    dense: np.ndarray  # FILTERS * len(WIDTHS) x languages
    offset: np.ndarray

    def tables(self) -> list[tuple[list[np.ndarray], np.ndarray]]:
        """For each width: tables over byte pairs (the last over one byte if odd)."""
        out = []
        for width, bank, bias in zip(WIDTHS, self.banks, self.bias, strict=True):
            single = [self.embed @ bank[j * EMBED : (j + 1) * EMBED] for j in range(width)]
            parts = [
                (single[j][:, None] + single[j + 1][None]).reshape(-1, FILTERS) for j in range(0, width - 1, 2)
            ] + ([single[-1]] if width % 2 else [])
            out.append(([np.ascontiguousarray(p, np.float32) for p in parts], bias.astype(np.float32)))
        return out

    def probabilities(self, windows: np.ndarray, tables) -> np.ndarray:
        """Softmax of windows (rows of byte classes)."""
        pooled = []
        pairs = windows[:, :-1].astype(np.int32) * ALPHABET + windows[:, 1:]
        for width, (parts, bias) in zip(WIDTHS, tables, strict=True):
            n = WINDOW - width + 1
            total = np.take(parts[0], pairs[:, :n].ravel(), axis=0)
            if width == 3:
                total += np.take(parts[1], windows[:, 2 : 2 + n].ravel(), axis=0)
            elif width == 4:
                total += np.take(parts[1], pairs[:, 2 : 2 + n].ravel(), axis=0)
            total = total.reshape(len(windows), n * FILTERS)
            while n > 1:  # maximum over positions by halves
                half = n // 2
                upper = np.maximum(total[:, : half * FILTERS], total[:, half * FILTERS : 2 * half * FILTERS])
                if n % 2:
                    np.maximum(upper[:, :FILTERS], total[:, (n - 1) * FILTERS : n * FILTERS], out=upper[:, :FILTERS])
                total, n = upper, half
            pooled.append(np.maximum(total[:, :FILTERS] + bias, 0))
        z = np.concatenate(pooled, axis=1) @ self.dense + self.offset
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def window_rows(data: bytes) -> np.ndarray:
    """All windows of a text as byte classes; class 0 pads the last one."""
    n = -(-max(len(data), 1) // WINDOW)
    out = np.zeros(n * WINDOW, np.uint16)
    np.add(np.frombuffer(data, np.uint8), np.uint16(1), out=out[: len(data)])
    return out.reshape(n, WINDOW)


def fit(windows: list[bytes], langs: list[str], epochs: int = EPOCHS) -> Network:
    """Train the network on windows of bytes and their languages."""
    rng = np.random.default_rng(3)
    names = sorted(set(langs))
    label = np.array([names.index(x) for x in langs])
    x = np.concatenate([window_rows(w) for w in windows])
    deep = FILTERS * len(WIDTHS)
    p = [rng.normal(0, 0.3, (ALPHABET, EMBED))]
    p += [rng.normal(0, 1 / np.sqrt(w * EMBED), (w * EMBED, FILTERS)) for w in WIDTHS]
    p += [np.zeros(FILTERS) for _ in WIDTHS]
    p += [rng.normal(0, 1 / np.sqrt(deep), (deep, len(names))), np.zeros(len(names))]
    p = [a.astype(np.float32) for a in p]
    first, second, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    k = len(WIDTHS)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), BATCH):
            own, want = x[order[i : i + BATCH]], label[order[i : i + BATCH]]
            b = len(own)
            e = p[0][own]
            flat = e.reshape(b, -1)
            grads = [np.zeros_like(a) for a in p]
            pooled, best = [], []
            for j, w in enumerate(WIDTHS):
                n = WINDOW - w + 1
                patch = np.lib.stride_tricks.as_strided(
                    flat, (b, n, w * EMBED), (flat.strides[0], EMBED * flat.itemsize, flat.itemsize)
                )
                out = patch.reshape(b * n, -1) @ p[1 + j]
                at = out.reshape(b, n, FILTERS).argmax(axis=1)
                best.append(at)
                pooled.append(np.take_along_axis(out.reshape(b, n, FILTERS), at[:, None], 1)[:, 0] + p[1 + k + j])
            h = np.concatenate(pooled, axis=1)
            a = np.maximum(h, 0)
            z = a @ p[-2] + p[-1]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            z[np.arange(b), want] -= 1
            z /= b
            grads[-2], grads[-1] = a.T @ z, z.sum(axis=0)
            back = (z @ p[-2].T) * (h > 0)
            for j, w in enumerate(WIDTHS):
                g = back[:, j * FILTERS : (j + 1) * FILTERS]
                grads[1 + k + j] = g.sum(axis=0)
                place = best[j][:, :, None] + np.arange(w)  # b x FILTERS x w
                codes = own[np.arange(b)[:, None, None], place]
                patch = p[0][codes].reshape(b, FILTERS, w * EMBED)
                grads[1 + j] = np.einsum("bfd,bf->df", patch, g)
                down = (g[:, :, None] * p[1 + j].T[None]).reshape(-1, EMBED)
                np.add.at(grads[0], codes.reshape(-1), down)
            t += 1
            rate = 0.004 * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
            for q, g, m, v in zip(p, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= (rate * m / (np.sqrt(v) + 1e-7)).astype(np.float32)
    return Network(names, p[0], p[1 : 1 + k], p[1 + k : 1 + 2 * k], p[-2], p[-1])


def train(docs: DataFrame, sample_windows: int = SAMPLE_WINDOWS) -> Network | None:
    """Fit on labelled rows outside the held-out fold; None without any."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    ).where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = cut(rows.groupBy("lang").agg(F.count(F.lit(1)).cast("double").alias("stretch")))
    languages = counts.count()
    if not languages:
        return None
    sample_windows = max(sample_windows, 8 * languages)
    # Uniform keys stretched by the language's rows: the smallest ones fall evenly
    # on the languages.
    stretched = rows.select("doc_id", "lang").join(small(counts, BROADCAST_LANGUAGES), "lang")
    key = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) * F.col("stretch")
    stretched = stretched.select("doc_id", "lang", key.alias("key"))
    ids = stretched.groupBy("doc_id").agg(F.min("key").alias("key"))
    ids = ids.orderBy("key", "doc_id").limit(sample_windows // 4).select("doc_id")
    # The first text of each language besides: one row a language.
    firsts = stretched.groupBy("lang").agg(F.min(F.struct("key", "doc_id"))["doc_id"].alias("doc_id")).select("doc_id")
    ids = ids.union(firsts).distinct()
    picked = rows.join(small(ids, sample_windows), "doc_id", "left_semi")
    picked = picked.groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("r")).select("doc_id", "r.*")  # one row of each

    def step(batch, texts):
        lang, found = [], []
        for own, text in zip(batch.column(1).to_pylist(), texts, strict=True):
            text = text or b""
            n = -(-len(text) // WINDOW)
            for i in sorted({n * j // 4 for j in range(4)}) if n else []:
                lang.append(own)
                found.append(text[i * WINDOW : (i + 1) * WINDOW])
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(found, pa.binary())], ["lang", "part"])

    got = picked.mapInArrow(per_slice(step), "lang string, part binary").orderBy(F.xxhash64("part"), "lang").toArrow()
    if not got.num_rows:
        return None
    return fit(got.column("part").to_pylist(), got.column("lang").to_pylist())


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, lang_pred and score of each whole text."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = share(docs.sparkSession, network)  # some thousand numbers

    def ready():
        net = received(shared)
        return net, net.tables() if net else None

    def step(batch, texts, state):
        net, tables = state
        lang, score = ["und"] * len(texts), [0.0] * len(texts)
        live = [i for i, t in enumerate(texts) if t and net and any(map(str.isalpha, t.decode("utf-8", "replace")))]
        if live:
            rows = [window_rows(texts[i]) for i in live]
            size = np.array([len(r) for r in rows])
            every = np.concatenate(rows)
            p = np.concatenate([net.probabilities(every[k : k + 256], tables) for k in range(0, len(every), 256)])
            mean = np.add.reduceat(p, np.cumsum(size) - size, axis=0) / size[:, None]
            for i, row in zip(live, mean, strict=True):
                at = int(row.argmax())
                lang[i], score[i] = net.languages[at], float(min(1.0, row[at]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"]
        )

    return plain.mapInArrow(per_slice(step, once=ready), "doc_id long, lang_pred string, score double")
