"""Language identification by a byte convolutional network.

Texts are cut into windows of a fixed number of bytes. Bytes are embedded, filters of
several widths run over a window, each filter keeps its maximum, and a softmax over the
maxima gives the window's languages. A text's prediction is the mean of the log
probabilities of all its windows, weighted by their bytes. The network is trained in numpy
on a bounded sample of labelled windows; the corpus is then scored without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.llm.frames import binary_texts, extended, remainder, without

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 12
EMBEDDING = 8
# Labelled documents of a language that are learned from, about; one window of each.
SAMPLE_PER_LANGUAGE = 1500
# Sampled windows in all, and languages, at most.
SAMPLE = 60_000
MOST_LANGUAGES = 10_000
EPOCHS = 12
BATCH = 128
# Windows scored at once.
WINDOWS_AT_ONCE = 1024

UNDETERMINED = "und"
HELD_OUT_MODULUS, HELD_OUT = 5, 0
RESULTS = ["held_out", "lang_pred", "score"]


@dataclass
class Network:
    """Weights; filter banks are (width x embedding, filters)."""

    labels: list[str]
    embedding: np.ndarray
    banks: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maxima of all filters over each window, and where they are."""
        n, size = windows.shape
        embedded = self.embedding[windows]
        best, place = [], []
        for bank in self.banks:
            width = len(bank) // EMBEDDING
            slid = np.lib.stride_tricks.sliding_window_view(embedded, width, axis=1)
            rows = slid.transpose(0, 1, 3, 2).reshape(n * (size - width + 1), -1)
            values = (rows @ bank).reshape(n, size - width + 1, -1)
            at = values.argmax(axis=1)
            place.append(at)
            best.append(np.take_along_axis(values, at[:, None, :], axis=1)[:, 0])
        return np.maximum(np.concatenate(best, axis=1) + self.bias, 0), np.concatenate(place, axis=1)

    def maxima(self, windows: np.ndarray) -> np.ndarray:
        """As :meth:`pooled`, without the places: sums of looked-up products by byte."""
        size = windows.shape[1]
        best = []
        for bank in self.banks:
            parts = [self.embedding @ part for part in bank.reshape(-1, EMBEDDING, FILTERS)]
            length = size - len(parts) + 1
            values = np.take(parts[0], windows[:, :length], axis=0)
            for offset, part in enumerate(parts[1:], 1):
                values += np.take(part, windows[:, offset : offset + length], axis=0)
            best.append(values.max(axis=1))
        return np.maximum(np.concatenate(best, axis=1) + self.bias, 0)

    def log_probabilities(self, maxima: np.ndarray) -> np.ndarray:
        logits = maxima @ self.dense + self.dense_bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def windows_of(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows (padded with zeros), their text and their number of bytes."""
    counts = np.array([-(-len(text) // size) for text in texts], np.int64)
    padded = b"".join(
        text.lower().ljust(count * size, b"\0") for text, count in zip(texts, counts.tolist())
    )
    windows = np.frombuffer(padded, np.uint8).reshape(-1, size)
    text_of = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(text_of)) - np.repeat(np.cumsum(counts) - counts, counts)
    lengths = np.array([len(text) for text in texts], np.int64)
    return windows, text_of, np.minimum(lengths[text_of] - number * size, size)


def train(windows: np.ndarray, labels: list[str], epochs: int = EPOCHS, seed: int = 4) -> Network:
    """Fit a network by stochastic gradients with momentum scaling (Adam).

    Gradients pass through the maxima only, so the backward step touches one place per
    filter and window.
    """
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    wanted = np.searchsorted(names, labels)
    filters = FILTERS * len(WIDTHS)

    def drawn(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)

    net = Network(
        names,
        drawn(256, EMBEDDING, scale=0.5),
        [drawn(w * EMBEDDING, FILTERS, scale=1 / np.sqrt(w * EMBEDDING)) for w in WIDTHS],
        np.zeros(filters, np.float32),
        drawn(filters, len(names), scale=1 / np.sqrt(filters)),
        np.zeros(len(names), np.float32),
    )
    weights = [net.embedding, *net.banks, net.bias, net.dense, net.dense_bias]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            batch, target = windows[rows], wanted[rows]
            maxima, place = net.pooled(batch)
            error = np.exp(net.log_probabilities(maxima))
            error[np.arange(len(rows)), target] -= 1
            error /= len(rows)
            back = (error @ net.dense.T) * (maxima > 0)
            gradients = [np.zeros_like(net.embedding)]
            for i, bank in enumerate(net.banks):
                width = len(bank) // EMBEDDING
                own = slice(i * FILTERS, (i + 1) * FILTERS)
                offsets = place[:, own, None] + np.arange(width)
                read = np.take_along_axis(batch[:, None, :], offsets, axis=2)
                inputs = net.embedding[read].reshape(len(rows), FILTERS, -1)
                gradients.append(np.einsum("nf,nfk->kf", back[:, own], inputs))
                flow = back[:, own, None] * bank.T[None]
                np.add.at(
                    gradients[0], read.reshape(-1), flow.reshape(-1, EMBEDDING)
                )
            gradients += [back.sum(axis=0), maxima.T @ error, error.sum(axis=0)]
            step += 1
            for weight, gradient, (mean, square) in zip(weights, gradients, moments):
                mean += 0.1 * (gradient - mean)
                square += 0.001 * (gradient * gradient - square)
                rate = 0.005 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weight -= (rate * mean / (np.sqrt(square) + 1e-8)).astype(np.float32)
    return net


def predict(net: Network | None, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
    """Language and probability of each text; ``und`` without any letter, or without a network."""
    names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    rows = [
        row
        for row, text in enumerate(texts)
        if net is not None and text and any(map(str.isalpha, text.decode("utf-8", "replace")))
    ]
    start = size = 0
    for end, row in enumerate(rows, 1):
        size += len(texts[row])
        if size < WINDOWS_AT_ONCE * WINDOW * 8 and end < len(rows):
            continue
        part = [texts[r] for r in rows[start:end]]
        windows, text_of, lengths = windows_of(part)
        total = np.zeros((len(part), len(net.labels)))
        for at in range(0, len(windows), WINDOWS_AT_ONCE):
            some = slice(at, at + WINDOWS_AT_ONCE)
            logs = net.log_probabilities(net.maxima(windows[some]))
            np.add.at(total, text_of[some], logs * lengths[some, None])
        total /= np.array([len(text) for text in part])[:, None]
        total = np.exp(total - total.max(axis=1, keepdims=True))
        total /= total.sum(axis=1, keepdims=True)
        for r, probabilities in zip(rows[start:end], total):
            best = int(probabilities.argmax())
            names[r], scores[r] = net.labels[best], float(probabilities[best])
        start, size = end, 0
    return names, scores


def sample(
    docs: DataFrame, text: str, lang: str, key: str, per_language: int = SAMPLE_PER_LANGUAGE
) -> tuple[np.ndarray, list[str]]:
    """One window of about ``per_language`` labelled documents of each language.

    Documents and the place of the window are chosen by hashes, so the sample is the same
    in every run. Documents held out are not in it.
    """
    usable = docs.filter(
        F.col(lang).isNotNull()
        & (F.length(text) > 0)
        & (remainder(key, HELD_OUT_MODULUS) != HELD_OUT)
    ).select(
        F.col(lang).alias("label"),
        F.col(text).alias("text"),
        F.xxhash64(F.col(key), F.col(text)).alias("hash"),
    )
    # One row for each language; more of them than this are not languages.
    counted = usable.groupBy("label").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counted) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in column {lang}")
    counts = docs.sparkSession.createDataFrame(
        [(row["label"], row["count"]) for row in counted], "label string, count long"
    )
    share = F.pmod(F.col("hash"), F.lit(1_000_000)) * F.col("count") < per_language * 1_000_000
    place = F.pmod(F.xxhash64("hash"), F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1)
    rows = (
        usable.join(F.broadcast(counts), "label")
        .filter(share)
        .select("hash", "label", F.substring("text", place.cast("int") + 1, F.lit(WINDOW)).alias("text"))
        .orderBy("hash", "label", "text")
        .limit(SAMPLE)
        .collect()
    )
    texts = [row["text"].encode()[:WINDOW] for row in rows]
    return windows_of(texts)[0], [row["label"] for row in rows]


def languages(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``, which replace columns of those names.

    Learns from documents that have a language and are not held out. A null text or one
    without a letter is ``und`` with score 0, and so is every text if there is nothing to
    learn from. A null key counts as empty text in the split. Repeated rows stay.
    """
    kept = without(docs, RESULTS)
    windows, labels = sample(docs, text, lang, key, per_language)
    net = train(windows, labels) if labels else None
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def score(batches):
        for batch in batches:
            names, scores = predict(shared.value, binary_texts(batch, "_scored_text"))
            added = [("lang_pred", pa.array(names, pa.string())), ("score", pa.array(scores, pa.float64()))]
            yield extended(batch, added, drop={"_scored_text"})

    narrow = docs.select(
        *kept,
        (remainder(key, HELD_OUT_MODULUS) == HELD_OUT).alias("held_out"),
        F.col(text).alias("_scored_text"),
    )
    fields = [f for f in narrow.schema if f.name != "_scored_text"]
    schema = T.StructType(
        [*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return narrow.mapInArrow(score, schema)
