"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of consecutive words. Each passage is encoded from counts
of byte-class trigrams and a few shares; a gated attention, learned from the labels of
documents only, weighs the passages; the weighted representation gives the score. The
network is trained in numpy on a bounded sample; the corpus is scored without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.llm.frames import binary_texts, extended, remainder, without
from siltworks.llm.words import Words, blocks, mix, space_words

PASSAGE = 64
BUCKETS = 256
SHARES = 6
HIDDEN = 32
ATTENTION = 16
# Labelled documents of either class that are learned from, about.
SAMPLE_PER_CLASS = 3000
# Passages of a sampled document that are learned from, evenly spaced over it; all are scored.
SAMPLED_PASSAGES = 48
EPOCHS = 12
BATCH = 32
THRESHOLD = 0.3

HELD_OUT_MODULUS, HELD_OUT = 5, 0
RESULTS = ["held_out", "score", "predicted"]


def _byte_classes() -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[0x80:] = 1
    table[ord("a") : ord("z") + 1] = 2
    table[[ord(c) for c in "aeiou"]] = 3
    table[ord("A") : ord("Z") + 1] = 4
    table[ord("0") : ord("9") + 1] = 5
    for number, byte in enumerate(b" \n.,!?|#%$&*-:;'\"()<>=/@_{}[]"):
        table[byte] = 6 + number
    return table


_CLASSES = _byte_classes()
_CLASS_COUNT = int(_CLASSES.max()) + 1
_BUCKET = (mix(np.arange(_CLASS_COUNT**3, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)


def encoded(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Inputs of all passages of some texts, and the first passage of each text.

    A text without words is one passage of zeros.
    """
    words = Words(texts, space_words(), lower=False)
    counts = words.counts()
    passages = np.maximum(-(-counts // PASSAGE), 1)
    first = np.append(0, np.cumsum(passages))
    total = int(first[-1])
    inputs = np.zeros((total, BUCKETS + SHARES), np.float32)
    if not len(words):
        return inputs, first
    text_of = words.text_of()
    passage_of = first[text_of] + (np.arange(len(words)) - words.first[text_of]) // PASSAGE
    # Bytes from one word's start to the next one's belong to the word's passage.
    spans = np.diff(np.append(words.starts, len(words.data)))
    byte_passage = np.repeat(passage_of, spans)
    classes = _CLASSES[words.data[words.starts[0] :]]
    kind = classes[:-2] * _CLASS_COUNT**2 + classes[1:-1] * _CLASS_COUNT + classes[2:]
    found = np.bincount(
        byte_passage[: len(kind)] * BUCKETS + _BUCKET[kind], minlength=total * BUCKETS
    ).reshape(total, BUCKETS)
    inputs[:, :BUCKETS] = np.sqrt(found / np.maximum(found.sum(axis=1, keepdims=True), 1))
    sizes = np.bincount(passage_of, minlength=total)
    hashes = words.hashes()
    same = np.append(False, (hashes[1:] == hashes[:-1]) & (passage_of[1:] == passage_of[:-1]))
    distinct = np.unique(mix(hashes + passage_of.astype(np.uint64)), return_index=True)[1]
    lengths = words.ends - words.starts
    n = np.maximum(sizes, 1)
    inputs[:, BUCKETS] = np.bincount(passage_of, same, total) / n
    inputs[:, BUCKETS + 1] = np.bincount(passage_of[distinct], minlength=total) / n
    inputs[:, BUCKETS + 2] = np.bincount(passage_of, lengths, total) / n / 10
    inputs[:, BUCKETS + 3] = np.bincount(passage_of, lengths == 1, total) / n
    inputs[:, BUCKETS + 4] = sizes / PASSAGE
    inputs[:, BUCKETS + 5] = 1
    return inputs, first


@dataclass
class Network:
    encode: np.ndarray
    view: np.ndarray
    gate: np.ndarray
    attend: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [getattr(self, field.name) for field in fields(self)]

    def forward(self, inputs: np.ndarray, first: np.ndarray):
        """Scores of bags, and what the backward step needs."""
        hidden = np.tanh(inputs @ self.encode)
        seen, gate = np.tanh(hidden @ self.view), _sigmoid(hidden @ self.gate)
        logits = (seen * gate) @ self.attend
        sizes = np.diff(first)
        bag = np.repeat(np.arange(len(sizes)), sizes)
        shifted = np.exp(logits - np.maximum.reduceat(logits, first[:-1])[bag])
        attention = shifted / np.add.reduceat(shifted, first[:-1])[bag]
        pooled = np.add.reduceat(attention[:, None] * hidden, first[:-1], axis=0)
        score = _sigmoid(pooled @ self.output + self.bias[0])
        return score, (hidden, seen, gate, bag, attention, pooled)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> Network:
    """Fit by Adam; only whole documents have labels."""
    rng = np.random.default_rng(seed)
    width = BUCKETS + SHARES

    def drawn(*shape):
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

    net = Network(
        drawn(width, HIDDEN), drawn(HIDDEN, ATTENTION), drawn(HIDDEN, ATTENTION),
        drawn(ATTENTION), drawn(HIDDEN), np.zeros(1, np.float32),
    )
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            inputs = np.concatenate([bags[r] for r in rows]).astype(np.float32)
            first = np.append(0, np.cumsum([len(bags[r]) for r in rows]))
            score, (hidden, seen, gate, bag, attention, pooled) = net.forward(inputs, first)
            error = (score - labels[rows]) / len(rows)
            to_pooled = error[:, None] * net.output
            to_attention = (hidden * to_pooled[bag]).sum(axis=1)
            mean = np.add.reduceat(attention * to_attention, first[:-1])
            to_logit = attention * (to_attention - mean[bag])
            to_seen = to_logit[:, None] * net.attend * gate * (1 - seen**2)
            to_gate = to_logit[:, None] * net.attend * seen * gate * (1 - gate)
            to_hidden = attention[:, None] * to_pooled[bag]
            to_hidden += to_seen @ net.view.T + to_gate @ net.gate.T
            to_hidden *= 1 - hidden**2
            gradients = [
                inputs.T @ to_hidden, hidden.T @ to_seen, hidden.T @ to_gate,
                (seen * gate).T @ to_logit, pooled.T @ error, np.array([error.sum()]),
            ]
            step += 1
            for weight, gradient, (m, v) in zip(net.weights(), gradients, moments):
                m += 0.1 * (gradient - m)
                v += 0.001 * (gradient * gradient - v)
                rate = 0.003 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weight -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return net


def sample(
    docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, per_class: int,
    passages: int = SAMPLED_PASSAGES,
) -> tuple[list[np.ndarray], np.ndarray]:
    """Encoded passages of about ``per_class`` labelled documents of either class.

    Of a document with more than ``passages`` as many, evenly spaced, so that what reaches the
    driver is bounded in rows and in bytes.
    Chosen among the labels by hashes of their keys, before any text is read, so the join is
    with a bounded broadcast. Rows that are held out or without a label are not in it.
    """
    usable = labels.filter(
        F.col(label).isin(0, 1)
        & F.col(key).isNotNull()
        & (remainder(key, HELD_OUT_MODULUS) != HELD_OUT)
    ).select(F.col(key).alias("_of"), F.col(label).cast("int").alias("_label"))
    counts = usable.groupBy("_label").count()
    hashed = F.pmod(F.xxhash64("_of"), F.lit(1_000_000))
    chosen = (
        usable.join(counts, "_label")
        .filter(hashed * F.col("count") < per_class * 1_000_000)
        .select("_of", "_label")
        .orderBy(F.xxhash64("_of"), "_of", "_label")
        .limit(4 * per_class)
        .dropDuplicates(["_of"])
    )
    # At most 4 x per_class keys.
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(
        F.broadcast(chosen), F.col("_key") == F.col("_of")
    )

    def encode(batches):
        for batch in batches:
            texts, keys, wanted, bags = binary_texts(batch, "_text"), [], [], []
            for start, end in blocks(texts):
                inputs, first = encoded(texts[start:end])
                for row in range(end - start):
                    bag = inputs[first[row] : first[row + 1]]
                    if len(bag) > passages:
                        bag = bag[np.linspace(0, len(bag) - 1, passages).astype(int)]
                    keys.append(start + row)
                    bags.append(bag.astype(np.float16).tobytes())
            wanted = batch.column(batch.schema.get_field_index("_label"))
            of = batch.column(batch.schema.get_field_index("_key")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [of, wanted.cast(pa.int32()), pa.array(bags, pa.binary())], names=["k", "label", "bag"]
            )

    found = rows.select(F.xxhash64("_key").alias("_key"), "_label", "_text").mapInArrow(
        encode, "k long, label int, bag binary"
    )
    found = found.orderBy("k", "label", "bag").limit(4 * per_class).collect()
    bags = [
        np.frombuffer(row["bag"], np.float16).reshape(-1, BUCKETS + SHARES) for row in found
    ]
    return bags, np.array([row["label"] for row in found], np.float32)


def quality(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    per_class: int = SAMPLE_PER_CLASS,
    threshold: float = THRESHOLD,
    passages: int = SAMPLED_PASSAGES,
) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``, which replace columns of those names.

    The score is the probability of label 1 of the whole text, whose passages all count. A
    null or empty text is one empty passage. Without labels of both classes every score is
    0.5. A null key counts as empty text in the split. Repeated rows stay. The network learns from
    about ``per_class`` labelled documents of either class, and of each from at most ``passages``.
    """
    kept = without(docs, RESULTS)
    bags, wanted = sample(docs, labels, text, key, label, per_class, passages)
    net = train(bags, wanted) if len(set(wanted.tolist())) == 2 else None
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def score(batches):
        net = shared.value
        for batch in batches:
            texts = binary_texts(batch, "_scored_text")
            values = np.full(len(texts), 0.5)
            if net is not None:
                for start, end in blocks(texts, 1 << 20):
                    values[start:end] = net.forward(*encoded(texts[start:end]))[0]
            yield extended(batch, [("score", pa.array(values))], drop={"_scored_text"})

    narrow = docs.select(
        *kept,
        (remainder(key, HELD_OUT_MODULUS) == HELD_OUT).alias("held_out"),
        F.col(text).alias("_scored_text"),
    )
    columns = [f for f in narrow.schema if f.name != "_scored_text"]
    schema = T.StructType([*columns, T.StructField("score", T.DoubleType())])
    return narrow.mapInArrow(score, schema).withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)
    )
