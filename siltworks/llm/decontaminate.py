"""Benchmark decontamination: n-grams of test items looked up in training texts.

The windows of the benchmark are hashed and broadcast in blocks of a bounded number of
words. Each block is one scan of the documents without a shuffle: a task hashes the
windows of its texts, keeps those whose hash a bitmap admits, and then compares the words
themselves. What a scan finds travels with its document to the next block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.llm.frames import binary_texts, extended, without
from siltworks.llm.words import Words, blocks, name_words, prefix_hash, span_hash
from siltworks.staging import settle

WINDOW = 13
# Words of benchmark text in one broadcast, at most; a longer item is a block of its own.
BLOCK_WORDS = 500_000

_BITS = 22
_TEXT, _SPANS, _ITEMS, _COUNT = "_scanned_text", "_hit_spans", "_hit_items", "_word_count"
RESULTS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


class Windows:
    """The windows of some benchmark items, by length and hash."""

    def __init__(self, items: list[tuple[str | None, bytes]], size: int):
        found: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
        self.lengths: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        hashes: dict[int, dict[bytes, int]] = defaultdict(dict)
        for name, text in items:
            words = Words([text], name_words())
            length = min(size, len(words))
            if not length:
                continue
            starts = np.arange(len(words) - length + 1)
            values = span_hash(prefix_hash(words.hashes()), starts, starts + length)
            for start, value in zip(starts.tolist(), values.tolist()):
                window = words.joined(start, start + length)
                found[length][window].add(name)
                hashes[length][window] = value
        self.items: dict[int, dict[int, list[tuple[bytes, list[str]]]]] = {}
        for length, windows in found.items():
            by_hash: dict[int, list[tuple[bytes, list[str]]]] = defaultdict(list)
            for window, names in windows.items():
                by_hash[hashes[length][window]].append(
                    (window, sorted(n for n in names if n is not None))
                )
            self.items[length] = dict(by_hash)
            bitmap = np.zeros(1 << _BITS, bool)
            bitmap[np.fromiter(by_hash, np.uint64) >> np.uint64(64 - _BITS)] = True
            self.lengths[length] = bitmap

    def hits(self, words: Words) -> Iterator[tuple[int, int, list[str]]]:
        """First word, end and items of each occurrence."""
        if not len(words):
            return
        sums, text_of = prefix_hash(words.hashes()), words.text_of()
        for length, bitmap in self.lengths.items():
            starts = np.arange(len(words) - length + 1)
            if not len(starts):
                continue
            inside = text_of[starts] == text_of[starts + length - 1]
            starts = starts[inside]
            values = span_hash(sums, starts, starts + length)
            near = bitmap[values >> np.uint64(64 - _BITS)]
            by_hash = self.items[length]
            for start, value in zip(starts[near].tolist(), values[near].tolist()):
                for window, names in by_hash.get(value, ()):
                    if words.joined(start, start + length) == window:
                        yield start, start + length, names


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def _benchmark_blocks(benchmark: DataFrame, item: str, text: str, limit: int):
    """Items in blocks of about ``limit`` words, read one partition at a time."""
    size, block = 0, []
    rows = benchmark.select(
        F.col(item).cast("string").alias("item"), F.col(text).cast("binary").alias("text")
    )
    for row in rows.toLocalIterator():
        if row["text"] is None:
            continue
        words = len(Words([bytes(row["text"])], name_words()))
        if block and size + words > limit:
            yield block
            size, block = 0, []
        size += words
        block.append((row["item"], bytes(row["text"])))
    if block:
        yield block


def _scan(docs: DataFrame, text: str, windows: Windows, drop: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def scan(batches):
        known = shared.value
        for batch in batches:
            texts = binary_texts(batch, text)
            count = np.zeros(len(texts), np.int64)
            spans = batch.column(batch.schema.get_field_index(_SPANS)).to_pylist()
            items = batch.column(batch.schema.get_field_index(_ITEMS)).to_pylist()
            for start, end in blocks(texts):
                words = Words(texts[start:end], name_words())
                count[start:end] = words.counts()
                found = defaultdict(list)
                for first, last, names in known.hits(words):
                    row = int(np.searchsorted(words.first, first, "right")) - 1
                    base = int(words.first[row])
                    found[start + row].append((first - base, last - base))
                    items[start + row] = sorted({*items[start + row], *names})
                for row, own in found.items():
                    before = list(zip(spans[row][::2], spans[row][1::2]))
                    spans[row] = [edge for span in _merged(before + own) for edge in span]
            yield extended(
                batch,
                [
                    (_COUNT, pa.array(count)),
                    (_SPANS, pa.array(spans, pa.list_(pa.int64()))),
                    (_ITEMS, pa.array(items, pa.list_(pa.string()))),
                ],
                drop=replaced,
            )

    replaced = {_COUNT, _SPANS, _ITEMS, *([text] if drop else [])}
    kept = [f for f in docs.schema if f.name not in replaced]
    schema = T.StructType(
        [
            *kept,
            T.StructField(_COUNT, T.LongType()),
            T.StructField(_SPANS, T.ArrayType(T.LongType())),
            T.StructField(_ITEMS, T.ArrayType(T.StringType())),
        ]
    )
    return docs.mapInArrow(scan, schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    share: int = 20,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Documents with the benchmark windows their words lie in, and their columns ``keep``.

    A window is ``window`` consecutive words of an item, or all words of a shorter item.
    Adds ``n_words``, ``n_hit`` (words inside any occurrence), ``n_items``, ``items_sha256``
    and ``contaminated`` (at least one word in ``share`` is hit), and ``hit_spans``, the word
    ranges as [first, end, ...]. These replace input columns of the same names.

    A null text has no words. An item without words has no window. Equal item ids are one
    item; an item whose id is null hits words but is not listed. Repeated rows stay.
    An empty benchmark hits nothing.
    """
    kept = without(docs, [*RESULTS, "hit_spans", _SPANS, _ITEMS, _COUNT])
    if keep is not None:
        kept = [name for name in kept if name.lower() in {k.lower() for k in keep}]
    found = docs.select(
        *kept,
        F.col(text).alias(_TEXT),
        F.array().cast("array<bigint>").alias(_SPANS),
        F.array().cast("array<string>").alias(_ITEMS),
    )
    ahead = None
    for block in _benchmark_blocks(benchmark, item, item_text, block_words):
        if ahead is not None:
            # Written, so that a task holds the windows of one block at a time.
            found = settle(_scan(found, _TEXT, Windows(ahead, window), drop=False), "scanned")
        ahead = block
    found = _scan(found, _TEXT, Windows(ahead or [], window), drop=True)
    edges = F.col(_SPANS)
    hit = F.aggregate(
        F.transform(edges, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    return (
        found.withColumn("n_hit", hit)
        .select(
            *kept,
            F.col(_COUNT).alias("n_words"),
            "n_hit",
            F.size(_ITEMS).cast("bigint").alias("n_items"),
            F.sha2(F.array_join(F.array_sort(_ITEMS), ",").cast("binary"), 256).alias(
                "items_sha256"
            ),
            ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col(_COUNT))).alias(
                "contaminated"
            ),
            F.col(_SPANS).alias("hit_spans"),
        )
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    options["text"] = _own(docs, options.get("text", "text"))
    found = contamination(_guarded(docs), benchmark, **options)
    return _restored(found.filter(~F.col("contaminated")), docs)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents, without the words inside occurrences and what stands between those words."""
    found = contamination(_guarded(docs), benchmark, text=_own(docs, text), **options)
    column = _own(docs, text)

    def cut(batches):
        for batch in batches:
            spans = batch.column(batch.schema.get_field_index("hit_spans")).to_pylist()
            texts = binary_texts(batch, column)
            for row, edges in enumerate(spans):
                if edges:
                    words = Words([texts[row]], name_words())
                    at, parts = 0, []
                    for first, end in zip(edges[::2], edges[1::2]):
                        parts.append(texts[row][at : words.starts[first]])
                        at = int(words.ends[end - 1])
                    texts[row] = b"".join([*parts, texts[row][at:]])
            values = pa.array(texts, pa.binary()).cast(pa.string())
            yield extended(batch, [("_cut", values)], drop={column, "hit_spans"})

    fields = [f for f in found.schema if f.name not in (column, "hit_spans")]
    schema = T.StructType([*fields, T.StructField("_cut", T.StringType())])
    result = found.mapInArrow(cut, schema).withColumnRenamed("_cut", column)
    return _restored(result, docs)


# Columns of the input are numbered on the way, so none of them can clash with a result.


def _own(docs: DataFrame, name: str) -> str:
    lower = [column.lower() for column in docs.columns]
    return f"_c{lower.index(name.lower())}"


def _guarded(docs: DataFrame) -> DataFrame:
    return docs.toDF(*(f"_c{i}" for i in range(len(docs.columns))))


def _restored(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"_c{i}").alias(name) for i, name in enumerate(docs.columns)))
