"""SimHash near-duplicates: fingerprints, and their self-join by a binary trie.

Two fingerprints that differ in at most ``distance`` bits agree in one of ``distance + 1``
slices of their bits. So each fingerprint is dealt out once per slice, rotated so that the
slice comes first, and a task joins the trie below each slice value with itself: pairs of
nodes descend together, the differing bits of their paths add up, and a pair is given up
when they exceed the distance. Pairs whose leaves are already in one component are
given up too, so a dense cluster costs no more than its spanning links.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.llm.components import components
from siltworks.llm.frames import binary_texts, extended, without
from siltworks.llm.words import Words, blocks, space_words
from siltworks.staging import settle

SHINGLE = 4
DISTANCE = 4
SEED = 42
# Above so many fingerprints below one slice value, its trie is dealt out by further bits.
HOT_SLICE = 1 << 20
MOST_SPLIT_BITS = 8
# Node pairs that are expanded at once.
PAIRS = 1 << 20

_SLICE_SHINGLES = 1 << 16


def block_fingerprints(texts: list[bytes | None], shingle: int) -> np.ndarray:
    """Fingerprints of texts, as unsigned 64-bit numbers."""
    words = Words(texts, space_words())
    result = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for row, (first, end) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
        count = end - first
        if not count:
            continue
        size = min(shingle, count)
        ones, total = np.zeros(64, np.int64), count - size + 1
        for at in range(first, first + total, _SLICE_SHINGLES):
            n = min(_SLICE_SHINGLES, first + total - at)
            starts, ends = words.starts[at : at + n + size - 1], words.ends[at : at + n + size - 1]
            data = words.bytes[starts[0] : ends[-1]]
            starts, ends = starts - starts[0], ends - words.starts[at]
            if (starts[1:] - ends[:-1] != 1).any() or data.count(b" ") != len(starts) - 1:
                data = words.joined(at, at + n + size - 1)
                lengths = ends - starts
                ends = np.cumsum(lengths + 1) - 1
                starts = ends - lengths
            hashes = np.array(
                [
                    digest(data[a:b], SEED)
                    for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist())
                ],
                np.uint64,
            )
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int32)
        result[row] = weights[2 * ones > total].sum(dtype=np.uint64)
    return result


def fingerprints(
    docs: DataFrame, text: str = "text", column: str = "fingerprint", shingle: int = SHINGLE
) -> DataFrame:
    """``docs`` with a fingerprint column of long integers, which replaces one of that name."""
    kept = without(docs, [column])
    source = F.col(text).alias("_hashed_text")

    def scan(batches):
        for batch in batches:
            texts = binary_texts(batch, "_hashed_text")
            values = [block_fingerprints(texts[a:b], shingle) for a, b in blocks(texts)]
            values = np.concatenate([np.zeros(0, np.uint64), *values]).view(np.int64)
            yield extended(batch, [(column, pa.array(values))], drop={"_hashed_text"})

    schema = T.StructType(
        [*(docs.schema[name] for name in kept), T.StructField(column, T.LongType())]
    )
    return docs.select(*kept, source).mapInArrow(scan, schema)


class Trie:
    """The binary trie over sorted distinct values; a node is a range of them."""

    def __init__(self, values: np.ndarray, distance: int):
        self.values, self.distance = np.unique(values), distance
        self.parent = np.arange(len(self.values))

    def _roots(self) -> np.ndarray:
        while True:
            above = self.parent[self.parent]
            if (above == self.parent).all():
                return self.parent
            self.parent = above

    def _link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            roots = self._roots()
            a, b = roots[a], roots[b]
            apart = a != b
            a, b = np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart])
            np.minimum.at(self.parent, a, b)

    def join(self, prefix: int) -> tuple[np.ndarray, np.ndarray]:
        """Values and the least value each is linked to, below common prefixes of some bits."""
        n = len(self.values)
        if n < 2:
            return self.values, self.values
        heads = self.values >> np.uint64(64 - prefix) if prefix else np.zeros(n, np.uint64)
        starts = np.flatnonzero(np.append(True, heads[1:] != heads[:-1]))
        ends = np.append(starts[1:], n)
        pairs = np.stack([starts, ends, starts, ends, np.zeros_like(starts)])
        stack = [(prefix, pairs[:, ends - starts > 1])]
        while stack:
            depth, pairs = stack.pop()
            pairs = self._verify(pairs)
            if not pairs.shape[1]:
                continue
            if pairs.shape[1] > PAIRS:
                stack += [(depth, part) for part in np.array_split(pairs, 2, axis=1)]
                continue
            stack.append((depth + 1, self._expand(depth, pairs)))
        return self.values, self.values[self._roots()]

    def _verify(self, pairs: np.ndarray) -> np.ndarray:
        """Link pairs of leaves; return the pairs that still have something to find."""
        a, a_end, b, b_end, _ = pairs
        leaves = (a_end - a == 1) & (b_end - b == 1)
        first, second = a[leaves], b[leaves]
        differing = np.bitwise_count(self.values[first] ^ self.values[second])
        near = differing <= self.distance
        self._link(first[near], second[near])
        pairs = pairs[:, ~leaves]
        if not pairs.shape[1]:
            return pairs
        # changed[i]: how often the component changes among the values before i + 1.
        roots = self._roots()
        changed = np.append(0, np.cumsum(roots[1:] != roots[:-1]))
        a, a_end, b, b_end, _ = pairs
        one = (
            (changed[a_end - 1] == changed[a])
            & (changed[b_end - 1] == changed[b])
            & (roots[a] == roots[b])
        )
        return pairs[:, ~one]

    def _expand(self, depth: int, pairs: np.ndarray) -> np.ndarray:
        """The pairs of children, one bit further down, within the distance."""
        zero = (self.values >> np.uint64(63 - depth)) & np.uint64(1) == 0
        zeros = np.append(0, np.cumsum(zero))
        a, a_end, b, b_end, differing = pairs
        a_mid, b_mid = a + zeros[a_end] - zeros[a], b + zeros[b_end] - zeros[b]
        other = a != b
        children = [
            np.stack([a, a_mid, b, b_mid, differing]),
            np.stack([a_mid, a_end, b_mid, b_end, differing]),
            np.stack([a, a_mid, b_mid, b_end, differing + 1]),
            np.stack([a_mid, a_end, b, b_mid, differing + 1])[:, other],
        ]
        found = np.concatenate(children, axis=1)
        a, a_end, b, b_end, differing = found
        alive = (a < a_end) & (b < b_end) & (differing <= self.distance)
        alive &= ~((a == b) & (a_end - a == 1))
        return found[:, alive]


def _slices(distance: int) -> list[tuple[int, int]]:
    """First bit and width of each slice."""
    edges = [64 * i // (distance + 1) for i in range(distance + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def links(prints: DataFrame, distance: int = DISTANCE, hot: int = HOT_SLICE) -> DataFrame:
    """Spanning links (a, b) of all distinct ``fingerprint`` values within ``distance`` bits.

    Every pair within the distance is connected by links, but a group has fewer links
    than members for each slice. ``prints`` is a written table.
    """
    slices = _slices(distance)
    value = F.col("fingerprint")

    def rotated(first: int) -> Column:
        if not first:
            return value
        return F.shiftleft(value, first).bitwiseOR(F.shiftrightunsigned(value, 64 - first))

    dealt = prints.select(
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(i).alias("slice"),
                        F.shiftrightunsigned(rotated(first), 64 - width).alias("head"),
                        rotated(first).alias("value"),
                    )
                    for i, (first, width) in enumerate(slices)
                )
            )
        ).alias("x")
    ).select("x.*")
    # Some bits more for a slice value that many fingerprints share. Then each pair of
    # subtrees that can hold a link is a task.
    sizes = settle(
        dealt.groupBy("slice", "head").count().filter(F.col("count") > hot), "hot_slices"
    ).select(
        "slice", "head",
        F.least(F.ceil(F.log2(F.col("count") / hot)).cast("int"), F.lit(MOST_SPLIT_BITS)).alias("bits"),
    )
    widths = F.element_at(F.array(*(F.lit(w) for _, w in slices)), F.col("slice") + 1)
    below = F.expr("shiftrightunsigned(shiftleft(value, _width), 64 - bits)").cast("int")
    pairs = F.expr(
        f"transform(filter(sequence(0, (1 << bits) - 1), t -> bit_count(_sub ^ t) <= {distance}),"
        " t -> struct(least(_sub, t) AS low, greatest(_sub, t) AS high))"
    )
    split = (
        dealt.join(sizes, ["slice", "head"], "left")
        .withColumn("_width", widths)
        .withColumn("_sub", F.when(F.col("bits") > 0, below))
        .withColumn(
            "task",
            F.explode(
                F.when(F.col("bits") > 0, pairs).otherwise(
                    F.array(F.struct(F.lit(0).alias("low"), F.lit(0).alias("high")))
                )
            ),
        )
        .select("slice", "head", "value", "task")
    )

    def join(batches):
        groups: dict[tuple, list[np.ndarray]] = {}
        for batch in batches:
            # The trie below a prefix is found again by sorting, so only slices and the
            # subtree pairs of hot ones are kept apart.
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
            values = batch.column(3).to_numpy().view(np.uint64)
            order = np.lexsort(keys)
            keys, values = keys[:, order], values[order]
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for start, part in zip(np.append(0, cuts), np.split(values, cuts)):
                if len(part):
                    groups.setdefault(tuple(keys[:, start].tolist()), []).append(part)
        for (number, _, _), parts in groups.items():
            first, width = slices[number]
            found, least = Trie(np.concatenate(parts), distance).join(width)
            apart = found != least
            turn = np.uint64(first), np.uint64((64 - first) % 64)
            ends = [
                ((x[apart] >> turn[0]) | (x[apart] << turn[1]) if first else x[apart]).view(np.int64)
                for x in (found, least)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends], names=["a", "b"])

    return (
        split.repartition("slice", "head", "task")
        .select("slice", "task.low", "task.high", "value")
        .mapInArrow(join, "a long, b long")
    )


def grouped(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Columns ``keep`` (or all) of the documents with ``fingerprint`` (long), ``component_id`` and ``group_print``.

    ``component_id`` is the least key reachable over links, ``group_print`` a value common to
    the group; both replace input columns of those names. Equal fingerprints are one node
    of the trie, however many documents have them. A null or empty text has fingerprint
    zero and is linked like any other. Null keys are passed over in the minimum; a group
    of null keys has none. Repeated rows stay.
    """
    kept = without(docs, ["fingerprint", "component_id", "group_print"])
    if keep is not None:
        kept = [name for name in kept if name.lower() in {k.lower() for k in keep}]
    printed = fingerprints(docs, text, "fingerprint", shingle)
    carried = kept if key in kept else [*kept, key]
    found = settle(printed.select(*carried, "fingerprint"), "fingerprints")
    prints = settle(
        found.groupBy("fingerprint").agg(F.min(key).alias("_least")), "distinct_prints"
    )
    roots = settle(components(links(prints, distance)), "roots")
    members = prints.join(roots, prints["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "_least", F.coalesce("root", "fingerprint").alias("group_print")
    )
    least = members.groupBy("group_print").agg(F.min("_least").alias("component_id"))
    groups = settle(
        members.join(least, "group_print").select("fingerprint", "group_print", "component_id"),
        "groups",
    )
    return found.join(groups, "fingerprint").select(
        *kept, "fingerprint", "component_id", "group_print"
    )


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The document with the least key of each group; of repeated rows, one."""
    own = [f"_c{i}" for i in range(len(docs.columns))]
    at = {name.lower(): own[i] for i, name in enumerate(docs.columns)}
    found = grouped(docs.toDF(*own), at[text.lower()], at[key.lower()], **options)
    first = found.filter(F.col(at[key.lower()]).eqNullSafe(F.col("component_id")))
    return first.dropDuplicates(["group_print"]).select(
        *(F.col(c).alias(name) for c, name in zip(own, docs.columns))
    )


def as_hex(column: str = "fingerprint") -> Column:
    """The 16 lower-case digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
