"""Scoring by a bigram model with deleted interpolation.

The maximum-likelihood estimates of a word after its context, of the word alone and of any
word are mixed by weights that depend on how often the context occurs. The weights are
learned by expectation-maximisation from deleted counts: each training token is scored by
the counts without itself, so the training text serves as held-out text.

Text moves through Spark in blocks of documents. A block asks for the counts of its
distinct words and bigrams, as sorted 64-bit hashes cut into ranges; a task per
range adds up what all blocks bring and answers each block in the order of its question.
A word or bigram is one entry per block, however frequent it is, and ranges of hashes are
even. Only a histogram of bounded size and the totals reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.llm.blobs import block_texts, document_blocks, hash_range, pack, unpack
from siltworks.llm.frames import remainder
from siltworks.llm.words import Words, blocks, mix, space_words
from siltworks.staging import settle

# Text bytes of a block, and of what a range of hashes answers for, about.
BLOCK_TEXT = 6 << 20
RANGE_TEXT = 12 << 20
HELD_OUT_MODULUS, HELD_OUT = 7, 2
ITERATIONS = 40

_END, _START = np.uint64(0x8F1BBCDC62C1D6A1), np.uint64(0x5A827999CA4F2E37)
# Histogram cells: context buckets, and quarter powers of two for either estimate; the
# last bin is probability zero.
_BUCKETS, _BINS = 48, 193


class Tokens:
    """The tokens of a block: word hashes, each document closed by an end."""

    def __init__(self, texts: list[bytes]):
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for first, last in blocks(texts):
            words = Words(texts[first:last], space_words())
            hashes.append(words.hashes())
            counts.append(words.counts())
        counts = np.concatenate(counts) + 1
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        self.words = np.full(int(counts.sum()), _END, np.uint64)
        inside = np.ones(len(self.words), bool)
        inside[self.ends - 1] = False
        self.words[inside] = np.concatenate(hashes)
        context = np.empty_like(self.words)
        context[1:] = self.words[:-1]
        context[self.starts] = _START
        self.bigrams = mix(context * np.uint64(0xD6E8FEB86659FD93) + self.words)
        self.counts = counts


def _questions(batches, parts: int):
    names = ["part", "block", "family", "hashes", "counts"]
    for batch in batches:
        for row in batch.to_pylist():
            tokens = Tokens(block_texts(row))
            train = np.repeat(~np.array(row["held_out"], bool), tokens.counts)
            out: list[list] = [[] for _ in names]
            for family, values in enumerate((tokens.words, tokens.bigrams)):
                hashes, which = np.unique(values, return_inverse=True)
                counts = np.bincount(which, train, len(hashes)).astype(np.int64)
                of = hash_range(hashes, parts)
                cuts = np.searchsorted(of, np.arange(parts + 1))
                for part, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
                    if a < b:
                        gaps = np.diff(hashes[a:b], prepend=np.uint64(0))
                        values_of = (part, row["block"], family, pack(gaps), pack(counts[a:b]))
                        for column, value in zip(out, values_of):
                            column.append(value)
            types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types)], names=names
            )


_ANSWER = "block long, part int, family int, totals binary, tokens long, known long"


def _answers(table: pa.Table) -> pa.Table:
    """The totals of one range of hashes for every block that asked, and a row of sums."""
    rows = table.to_pylist()
    out: list[tuple] = []
    for family in (0, 1):
        own = [row for row in rows if row["family"] == family]
        if not own:
            continue
        asked = [np.cumsum(unpack(row["hashes"], np.uint64), dtype=np.uint64) for row in own]
        counts = [unpack(row["counts"], np.int64) for row in own]
        hashes, which = np.unique(np.concatenate(asked), return_inverse=True)
        sums = np.zeros(len(hashes), np.int64)
        np.add.at(sums, which, np.concatenate(counts))
        at = 0
        for row, hashes_of in zip(own, asked):
            end = at + len(hashes_of)
            out.append((row["block"], row["part"], family, pack(sums[which[at:end]]), 0, 0))
            at = end
        if family == 0:
            out.append((-1, own[0]["part"], 0, b"", int(sums.sum()), int((sums > 0).sum())))
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    names = ["block", "part", "family", "totals", "tokens", "known"]
    columns = zip(*out) if out else [[] for _ in names]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def buckets(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then powers of two of its frequency."""
    return np.where(
        context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(int) + 1, _BUCKETS - 1), 0
    )


def estimates(bigram, context, word, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood estimates after the context and alone; 0 where nothing is known."""
    after = np.where(context > 0, bigram / np.maximum(context, 1), 0.0)
    return after, word / max(total, 1)


def _bins(p: np.ndarray) -> np.ndarray:
    logs = np.rint(-4 * np.log2(np.where(p > 0, p, 1.0))).astype(int)
    return np.where(p > 0, np.minimum(logs, _BINS - 2), _BINS - 1)


def contexts(words: np.ndarray, starts: np.ndarray, documents: int) -> np.ndarray:
    """The count of each token's context: of the word before it, or of document starts."""
    result = np.empty_like(words)
    result[1:] = words[:-1]
    result[starts] = documents
    return result


def cells(bigram: np.ndarray, context: np.ndarray, word: np.ndarray, total: int) -> np.ndarray:
    """Histogram cells of training tokens, by the counts without the token itself."""
    after, alone = estimates(bigram - 1, context - 1, word - 1, total - 1)
    return (buckets(context - 1) * _BINS + _bins(after)) * _BINS + _bins(alone)


def learn(cell: np.ndarray, count: np.ndarray, known: int) -> np.ndarray:
    """Weights (after the context, alone, any word) for each bucket, by EM on a histogram."""
    if not len(cell):
        return np.tile([0.0, 0.0, 1.0], (_BUCKETS, 1))
    bucket, rest = np.divmod(cell, _BINS * _BINS)
    bins = np.divmod(rest, _BINS)
    parts = np.stack(
        [np.where(b < _BINS - 1, 2.0 ** (-b / 4), 0.0) for b in bins]
        + [np.full(len(cell), 1 / (known + 1))]
    )
    weights = np.full((_BUCKETS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    # What no token has shown keeps the weights of the nearest bucket that has tokens.
    for _ in range(ITERATIONS):
        mixed = weights[bucket].T * parts
        share = mixed / mixed.sum(axis=0) * count
        sums = np.stack([np.bincount(bucket, s, _BUCKETS) for s in share], axis=1)
        seen = sums.sum(axis=1) > 0
        weights[seen] = sums[seen] / sums[seen].sum(axis=1, keepdims=True)
    seen = np.flatnonzero(np.bincount(bucket, minlength=_BUCKETS)[1:]) + 1
    for b in range(1, _BUCKETS):
        if len(seen) and b not in seen:
            weights[b] = weights[seen[np.abs(seen - b).argmin()]]
    weights[0, 0] = 0
    weights = np.maximum(weights, [0, 1e-9, 1e-9])
    return weights / weights.sum(axis=1, keepdims=True)


def interpolated(
    weights: np.ndarray, bigram, context, word, total: int, known: int
) -> np.ndarray:
    """Probability of each token."""
    after, alone = estimates(bigram, context, word, total)
    mix_of = weights[buckets(context)]
    return mix_of[:, 0] * after + mix_of[:, 1] * alone + mix_of[:, 2] / (known + 1)


def _joined(key_type: T.DataType, total: int, known: int):
    schema = T.StructType(
        [
            T.StructField("keys", T.ArrayType(key_type)),
            T.StructField("held_out", T.ArrayType(T.BooleanType())),
            *(T.StructField(n, T.ArrayType(T.LongType())) for n in ("n_tokens", "n_known")),
            T.StructField("base", T.ArrayType(T.DoubleType())),
            T.StructField("bigrams", T.BinaryType()),
            T.StructField("words", T.BinaryType()),
            T.StructField("documents", T.LongType()),
            T.StructField("cells", T.ArrayType(T.LongType())),
            T.StructField("cell_counts", T.ArrayType(T.LongType())),
        ]
    )

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        answers: dict[int, list[tuple[int, bytes]]] = {0: [], 1: []}
        for row in right.to_pylist():
            answers[row["family"]].append((row["part"], row["totals"]))
        batches = []
        for at in range(left.num_rows):
            source = left.slice(at, 1)
            row = source.select(["held_out", "lengths", "texts"]).to_pylist()[0]
            tokens = Tokens(block_texts(row))
            found = []
            for family, values in enumerate((tokens.words, tokens.bigrams)):
                hashes, which = np.unique(values, return_inverse=True)
                totals = [np.zeros(0, np.int64)]
                totals += [unpack(data, np.int64) for _, data in sorted(answers[family])]
                found.append(np.concatenate(totals)[which])
                if family == 0:
                    documents = int(found[0][tokens.ends[0] - 1])
            word, bigram = found
            train = np.repeat(~np.array(row["held_out"], bool), tokens.counts)
            context = contexts(word, tokens.starts, documents)
            cell, count = np.unique(
                cells(bigram[train], context[train], word[train], total), return_counts=True
            )
            logs = np.log10((word + 1) / (total + known + 1))
            values = [
                source.column("keys").combine_chunks(),
                source.column("held_out").combine_chunks(),
                *(
                    pa.array([x.tolist()], pa.list_(pa.int64()))
                    for x in (tokens.counts, np.add.reduceat((word > 0).astype(np.int64), tokens.starts))
                ),
                pa.array([np.add.reduceat(logs, tokens.starts).tolist()], pa.list_(pa.float64())),
                *(pa.array([pack(x.astype(np.int64))], pa.binary()) for x in (bigram, word)),
                pa.array([documents], pa.int64()),
                pa.array([cell.tolist()], pa.list_(pa.int64())),
                pa.array([count.tolist()], pa.list_(pa.int64())),
            ]
            batches.append(pa.table(values, names=schema.names))
        return pa.concat_tables(batches) if batches else _empty(schema)

    return join, schema


def _empty(schema: T.StructType) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema).empty_table()


def scored(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    block_bytes: int = BLOCK_TEXT,
    range_bytes: int = RANGE_TEXT,
) -> DataFrame:
    """The log probability of every whole text, with the column ``key``.

    Adds ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one
    unigrams) and ``score``. A null or empty text is its end alone. A null key counts as empty
    text in the split. Repeated rows stay and count once each. Without training rows every
    token has probability one.
    """
    held_out = remainder(key, HELD_OUT_MODULUS) == HELD_OUT
    packed = settle(
        document_blocks(docs, key, text, block_bytes, held_out=held_out), "blocks"
    )
    size = packed.agg(
        F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x))
    ).first()[0]
    parts = max(1, -(-(size or 0) // range_bytes))
    asked = packed.select("block", "held_out", "lengths", "texts").mapInArrow(
        lambda batches: _questions(batches, parts),
        "part int, block long, family int, hashes binary, counts binary",
    )
    answers = settle(asked.groupBy("part").applyInArrow(_answers, _ANSWER), "answers")
    sums = answers.filter("block < 0").agg(F.sum("tokens"), F.sum("known")).first()
    total, known = sums[0] or 0, sums[1] or 0
    join, schema = _joined(docs.schema[key].dataType, total, known)
    joined = settle(
        packed.groupBy("block")
        .cogroup(answers.filter("block >= 0").groupBy("block"))
        .applyInArrow(join, schema),
        "counted",
    )
    histogram = (
        joined.select(F.explode(F.arrays_zip("cells", "cell_counts")).alias("x"))
        .groupBy(F.col("x.cells").alias("cell"))
        .agg(F.sum("x.cell_counts").alias("count"))
        .collect()  # at most one row for each cell of the histogram
    )
    histogram.sort()
    weights = learn(
        np.array([row["cell"] for row in histogram], np.int64),
        np.array([row["count"] for row in histogram], np.float64),
        known,
    )

    def score(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                data = row.select(["bigrams", "words", "documents", "n_tokens"]).to_pylist()[0]
                bigram, word = (unpack(data[n], np.int64) for n in ("bigrams", "words"))
                starts = np.cumsum(data["n_tokens"]) - np.array(data["n_tokens"])
                context = contexts(word, starts, data["documents"])
                p = interpolated(weights, bigram, context, word, total, known)
                keys = row.column(row.schema.get_field_index("keys")).flatten()
                lists = [
                    row.column(row.schema.get_field_index(n)).flatten()
                    for n in ("held_out", "n_tokens", "n_known", "base")
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys, *lists[:3], pa.array(np.full(len(keys), total, np.int64)), lists[3],
                        pa.array(np.add.reduceat(np.log10(p), starts)),
                    ],
                    names=out.names,
                )

    out = T.StructType(
        [
            T.StructField("_key", docs.schema[key].dataType),
            T.StructField("held_out", T.BooleanType()),
            *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")),
            *(T.StructField(n, T.DoubleType()) for n in ("base_score", "score")),
        ]
    )
    return joined.drop("cells", "cell_counts").mapInArrow(score, out).withColumnRenamed("_key", key)
