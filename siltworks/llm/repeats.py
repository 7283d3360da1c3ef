"""Removal of repeated byte strings, decided by a distributed suffix sort.

A string of ``window`` bytes that also starts earlier is removed wherever it recurs. Sorting
every suffix of a corpus would move it many times, so it is done in two steps:

1. Content-defined anchors (see ``winnow``) deal the windows out: equal windows have the same
   anchor. Ranges of anchor hashes learn from all blocks in which surroundings an anchor
   occurs. An anchor in one place only has no repeated window; the second and later places
   of the same surroundings have nothing but repeated ones.
2. What is left are the first places of anchors with several surroundings: near copies at
   an edit, a shared passage at its ends. Their windows go to tasks by anchor, and each task
   sorts the suffixes of what it gets by the difference-cover algorithm, compares
   neighbours and keeps the earliest of each group of equal windows.

The windows of an anchor with very many surroundings, as at the edges of a passage that very many
documents share, would be one group. They are dealt out one by one, by 64-bit hashes of
their bytes; the least place of each hash is found by a minimum that combines in the map
tasks, so neither the anchor nor a window that recurs everywhere gathers in one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.llm.blobs import (
    block_texts,
    document_blocks,
    hash_range,
    pack,
    pack_bytes,
    table_of,
    unpack,
    unpack_bytes,
)
from siltworks.llm.suffixes import equal_prefixes, suffix_array
from siltworks.llm.winnow import Anchors
from siltworks.llm.words import _BYTE_VALUES, prefix_hash, span_hash
from siltworks.staging import settle

WINDOW = 100
# Text bytes of a block, of what a range of anchors answers for, and of a suffix sort, about.
BLOCK_TEXT = 4 << 20
RANGE_TEXT = 8 << 20
SORT_TEXT = 1 << 20
# Surroundings of an anchor above which its windows are dealt out one by one.
HOT_ANCHOR = 4096
PIECE = 1 << 19
# The part of windows that are dealt out one by one.
ALONE = -1

# Answers: nothing repeats, everything does, to be sorted, to be dealt out one by one.
UNIQUE, REPEATED, SORTED, SINGLE = 0, 1, 2, 3


class Places:
    """All anchors of a block: where they are, and the entry each belongs to.

    An entry is an anchor with its surroundings; its head is its earliest place.
    """

    def __init__(self, texts: list[bytes], keys: list[int], window: int):
        rows, parts = [], []
        for row, text in enumerate(texts):
            for low in range(0, max(len(text) - window + 1, 0), PIECE):
                found = Anchors(text, window, low, low + PIECE)
                parts.append(found)
                rows.append(np.full(len(found.places), row, np.int64))

        def joined(name: str, kind) -> np.ndarray:
            return np.concatenate([np.zeros(0, kind), *(getattr(p, name) for p in parts)])

        self.row = np.concatenate([np.zeros(0, np.int64), *rows])
        self.place, self.first = joined("places", np.int64), joined("first", np.int64)
        self.count = joined("count", np.int64)
        hashes, contexts = joined("hashes", np.uint64), joined("contexts", np.uint64)
        self.key = np.array(keys, np.int64)[self.row] if len(keys) else np.zeros(0, np.int64)
        # Anchors come by row, place and first window, and the sort is stable.
        order = np.lexsort((self.key, contexts, hashes))
        h, x = hashes[order], contexts[order]
        new = np.append(True, (h[1:] != h[:-1]) | (x[1:] != x[:-1]))[: len(order)]
        self.head = order[new]
        self.hashes, self.contexts = hashes[self.head], contexts[self.head]
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        # Pieces of a long text can share an anchor: all windows at the place of the head.
        head = self.head[self.entry]
        self.at_head = (self.row == self.row[head]) & (self.place == self.place[head])


def _keys(row: dict) -> list[int]:
    """Null keys come before all others."""
    least = np.iinfo(np.int64).min
    return [least if key is None else key for key in row["keys"]]


_ASKED = {
    "hashes": np.uint64, "contexts": np.uint64, "key": np.int64, "row": np.int64, "place": np.int64,
}


def _questions(window: int, parts: int):
    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = Places(block_texts(row), _keys(row), window)
                of = hash_range(found.hashes, parts)
                cuts = np.searchsorted(of, np.arange(parts + 1)).tolist()
                head = found.head
                columns = {
                    "hashes": found.hashes, "contexts": found.contexts,
                    "key": found.key[head], "row": found.row[head], "place": found.place[head],
                }
                out: list[list] = [[] for _ in range(2 + len(columns))]
                for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if a < b:
                        values = [part, row["block"]]
                        for name, column in columns.items():
                            own = column[a:b]
                            if name == "hashes":
                                own = np.diff(own, prepend=np.uint64(0))
                            values.append(pack(own))
                        for to, value in zip(out, values):
                            to.append(value)
                types = [pa.int32(), pa.int64(), *[pa.binary()] * len(columns)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, types)], names=["part", "block", *columns]
                )

    return ask


def _answers(hot: int):
    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        asked = {name: [unpack(row[name], kind) for row in rows] for name, kind in _ASKED.items()}
        asked["hashes"] = [np.cumsum(x, dtype=np.uint64) for x in asked["hashes"]]
        sizes = [len(x) for x in asked["key"]]
        column = {name: np.concatenate(values) for name, values in asked.items()}
        block = np.repeat([row["block"] for row in rows], sizes)
        order = np.lexsort(
            (column["place"], column["row"], block, column["key"], column["contexts"], column["hashes"])
        )
        h, x = column["hashes"][order], column["contexts"][order]
        new_hash = np.append(True, h[1:] != h[:-1])
        new = new_hash | np.append(True, x[1:] != x[:-1])
        number = np.cumsum(new_hash) - 1
        surroundings = np.bincount(number, new)[number]
        code = np.where(surroundings == 1, UNIQUE, np.where(surroundings <= hot, SORTED, SINGLE))
        code = np.where(new, code, REPEATED).astype(np.uint8)
        codes = np.empty(len(order), np.uint8)
        codes[order] = code
        parts = np.split(codes, np.cumsum(sizes)[:-1])
        return table_of(
            {
                "block": ([row["block"] for row in rows], pa.int64()),
                "part": ([row["part"] for row in rows], pa.int32()),
                "codes": ([pack(x) for x in parts], pa.binary()),
            }
        )

    return answer


_ANSWER = "block long, part int, codes binary"


def _codes(table: pa.Table) -> np.ndarray:
    """The answers to a block, in the order of its entries."""
    found = sorted((row["part"], row["codes"]) for row in table.to_pylist())
    return np.concatenate([np.zeros(0, np.uint8), *(unpack(c, np.uint8) for _, c in found)])


_ITEMS = ["part", "block", "key", "row", "first", "count", "texts"]
_ITEM = "part int, block long, key binary, row binary, first binary, count binary, texts binary"


def _single_windows(texts: list[bytes], row: np.ndarray, first: np.ndarray, count: np.ndarray, window: int):
    """Row, place and hash of every window of some anchors."""
    rows = np.repeat(row, count)
    places = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
    hashes = np.zeros(len(rows), np.uint64)
    for text in np.unique(row).tolist():
        own = np.flatnonzero(rows == text)
        data = np.frombuffer(texts[text], np.uint8)
        for low in range(int(places[own].min()), int(places[own].max()) + 1, PIECE):
            some = own[(places[own] >= low) & (places[own] < low + PIECE)]
            sums = prefix_hash(_BYTE_VALUES[data[low : low + PIECE + window]])
            hashes[some] = span_hash(sums, places[some] - low, places[some] - low + window)
    return rows, places, hashes


def _to_sort(window: int, parts: int):
    def extract(left: pa.Table, right: pa.Table) -> pa.Table:
        codes, out = _codes(right), [[] for _ in _ITEMS]

        def add(part: int, block: int, columns: list[np.ndarray], content: bytes) -> None:
            packed = [pack(np.ascontiguousarray(column)) for column in columns]
            for to, value in zip(out, [part, block, *packed, content]):
                to.append(value)

        for at in range(left.num_rows):
            row = left.slice(at, 1).to_pylist()[0]
            texts = block_texts(row)
            found = Places(texts, _keys(row), window)
            code = np.where(found.at_head, codes[found.entry], UNIQUE)
            wanted = np.flatnonzero(code == SORTED)
            of = hash_range(found.hashes[found.entry[wanted]], parts)
            order = np.argsort(of, kind="stable")
            cuts = np.flatnonzero(np.diff(of[order])) + 1
            for some in np.split(order, cuts) if len(order) else []:
                own = wanted[some]
                columns = [found.key[own], found.row[own], found.first[own], found.count[own]]
                pieces = b"".join(
                    texts[r][first : first + count + window - 1]
                    for r, first, count in zip(*(c.tolist() for c in columns[1:]))
                )
                add(int(of[some[0]]), row["block"], columns, pack_bytes(pieces))
            alone = np.flatnonzero(code == SINGLE)
            if len(alone):
                rows, places, hashes = _single_windows(
                    texts, found.row[alone], found.first[alone], found.count[alone], window
                )
                keys = np.array(_keys(row), np.int64)[rows]
                add(ALONE, row["block"], [keys, rows, places, np.ones(len(rows), np.int64)], pack(hashes))
        types = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
        return table_of({n: (c, t) for n, c, t in zip(_ITEMS, out, types)})

    return extract


_FLAGS = "block long, row binary, first binary, count binary, flags binary"


def _alone(items: DataFrame) -> DataFrame:
    """Which of the windows dealt out one by one recur, as the sort tells it of the others."""

    def windows(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                columns = [unpack(row[name], np.int64) for name in ("key", "row", "first")]
                hashes = unpack(row["texts"], np.int64)
                block = np.full(len(hashes), row["block"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (hashes, columns[0], block, *columns[1:])],
                    names=["hash", "key", "block", "row", "first"],
                )

    def flags(table: pa.Table) -> pa.Table:
        rows, first = (table[name].to_numpy() for name in ("row", "first"))
        ones = np.ones(len(rows), np.int64)
        values = {"row": rows, "first": first, "count": ones, "flags": ones.astype(np.uint8)}
        return table_of(
            {"block": ([table["block"][0].as_py()], pa.int64())}
            | {name: ([pack(np.ascontiguousarray(x))], pa.binary()) for name, x in values.items()}
        )

    found = settle(items.mapInArrow(windows, "hash long, key long, block long, row long, first long"), "alone")
    place = F.struct("key", "block", "row", "first")
    least = found.groupBy("hash").agg(F.min(place).alias("head"), F.count("*").alias("n")).filter("n > 1")
    again = found.join(least, "hash").filter(place != F.col("head"))
    return again.select("block", "row", "first").groupBy("block").applyInArrow(flags, _FLAGS)


def _sorted(window: int):
    """Which windows of the items of a part recur, by the suffix array of all their texts."""

    def sort(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        columns = {
            name: [unpack(row[name], np.int64) for row in rows] for name in ("key", "row", "first", "count")
        }
        sizes = [len(x) for x in columns["key"]]
        key, row_of, first, count = (np.concatenate(columns[n]) for n in columns)
        block = np.repeat([row["block"] for row in rows], sizes)
        data = np.frombuffer(b"".join(unpack_bytes(row["texts"]) for row in rows), np.uint8)
        # A zero closes each item; bytes count from 1.
        lengths = count + window - 1
        text = np.zeros(len(data) + len(lengths), np.int64)
        inside = np.ones(len(text), bool)
        starts = np.cumsum(lengths + 1) - lengths - 1
        inside[starts + lengths] = False
        text[inside] = data.astype(np.int64) + 1
        item = np.full(len(text), -1, np.int64)
        windows = np.repeat(starts - (np.cumsum(count) - count), count) + np.arange(count.sum())
        item[windows] = np.repeat(np.arange(len(count)), count)
        order = suffix_array(text + 1)
        order = order[item[order] >= 0]
        group = equal_prefixes(text.astype(np.int16), order, window)
        of = item[order]
        offset = order - starts[of]
        earliest = np.lexsort((first[of] + offset, row_of[of], block[of], key[of], group))
        head = np.append(True, np.diff(group[earliest]) != 0)
        repeated = np.zeros(len(text), bool)
        repeated[order[earliest[~head]]] = True
        flags = repeated[windows]
        bits = np.split(flags, np.cumsum(count)[:-1])
        out = {name: [] for name in ("block", "row", "first", "count", "flags")}
        at = 0
        for row, size in zip(rows, sizes):
            end = at + size
            out["block"].append(row["block"])
            for name, values in (("row", row_of), ("first", first), ("count", count)):
                out[name].append(pack(values[at:end]))
            out["flags"].append(pack(np.concatenate(bits[at:end]).view(np.uint8)))
            at = end
        return table_of({n: (c, pa.int64() if n == "block" else pa.binary()) for n, c in out.items()})

    return sort


def _runs(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that windows from ascending places cover."""
    cuts = np.flatnonzero(np.diff(starts) > window) + 1
    return [(int(x[0]), int(x[-1]) + window) for x in np.split(starts, cuts) if len(x)]


def _finished(window: int, key_type: T.DataType):
    schema = T.StructType(
        [
            T.StructField("_key", key_type),
            *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")),
            T.StructField("kept_sha256", T.StringType()),
            T.StructField("spans", T.ArrayType(T.LongType())),
        ]
    )

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        codes = _codes(right.filter(pa.compute.is_valid(right["codes"])))
        sorted_rows = right.filter(pa.compute.is_valid(right["flags"])).to_pylist()
        tables = []
        for at in range(left.num_rows):
            source = left.slice(at, 1)
            row = source.to_pylist()[0]
            texts = block_texts(row)
            found = Places(texts, _keys(row), window)
            code = codes[found.entry]
            all_of = (code == REPEATED) | ~found.at_head
            row_of = np.repeat(found.row[all_of], found.count[all_of])
            count = found.count[all_of]
            places = np.repeat(found.first[all_of] - (np.cumsum(count) - count), count)
            places += np.arange(len(places))
            more = [(row_of, places)]
            for answer in sorted_rows:
                rows, first, count = (unpack(answer[n], np.int64) for n in ("row", "first", "count"))
                flags = unpack(answer["flags"], np.uint8).astype(bool)
                own = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
                more.append((np.repeat(rows, count)[flags], own[flags]))
            row_of, places = (np.concatenate(x) for x in zip(*more))
            order = np.lexsort((places, row_of))
            row_of, places = row_of[order], places[order]
            edges = np.searchsorted(row_of, np.arange(len(texts) + 1)).tolist()
            out: list[list] = [[] for _ in range(5)]
            for text, a, b in zip(texts, edges, edges[1:]):
                runs = _runs(places[a:b], window)
                digest, end = hashlib.sha256(), 0
                for start, stop in runs:
                    digest.update(text[end:start])
                    end = stop
                digest.update(text[end:])
                values = (
                    len(text), sum(y - x for x, y in runs), len(runs), digest.hexdigest(),
                    [edge for run in runs for edge in run],
                )
                for to, value in zip(out, values):
                    to.append(value)
            kinds = [*[pa.int64()] * 3, pa.string(), pa.list_(pa.int64())]
            tables.append(
                pa.table(
                    [source["keys"].combine_chunks().flatten(), *(pa.array(c, t) for c, t in zip(out, kinds))],
                    names=schema.names,
                )
            )
        return pa.concat_tables(tables)

    return finish, schema


def repeated_spans(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    window: int = WINDOW,
    block_bytes: int = BLOCK_TEXT,
    range_bytes: int = RANGE_TEXT,
    sort_bytes: int = SORT_TEXT,
    hot_anchor: int = HOT_ANCHOR,
) -> DataFrame:
    """Bytes covered by strings of ``window`` bytes that also start earlier, for each document.

    Returns ``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans`` as
    [start, end, ...] in bytes. Earlier is a smaller key (an integer; null before all) or, in
    one document, an earlier start; rows with equal keys are documents in an order of their
    own. A null text is empty. Strings never cross documents.
    """
    number = F.col(key).cast("long") if docs.schema[key].dataType != T.LongType() else F.col(key)
    typed = docs.select(number.alias(key), F.col(text).alias("_value"))
    packed = settle(document_blocks(typed, key, "_value", block_bytes), "blocks")
    size = packed.agg(
        F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x))
    ).first()[0]
    parts = max(1, -(-(size or 0) // range_bytes))
    sorts = max(1, -(-(size or 0) // sort_bytes))
    asked = packed.mapInArrow(
        _questions(window, parts),
        "part int, block long, " + ", ".join(f"{name} binary" for name in _ASKED),
    )
    answers = settle(asked.groupBy("part").applyInArrow(_answers(hot_anchor), _ANSWER), "answers")
    extract = _to_sort(window, sorts)
    dealt = packed.groupBy("block").cogroup(answers.groupBy("block"))
    items = settle(dealt.applyInArrow(extract, _ITEM), "items")
    sorted_items = items.filter(F.col("part") != ALONE).groupBy("part")
    flags = sorted_items.applyInArrow(_sorted(window), _FLAGS)
    flags = settle(flags.unionByName(_alone(items.filter(F.col("part") == ALONE))), "flags")
    finish, schema = _finished(window, T.LongType())
    found = answers.unionByName(flags, allowMissingColumns=True)
    done = packed.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(finish, schema)
    return done.withColumnRenamed("_key", key)

