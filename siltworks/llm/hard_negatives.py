"""Hard negatives by exact scores from subset-sum tables over packed bit-planes.

Components are whole numbers. A block of candidates holds, for each bit of their two's complement
and each group of eight dimensions, one byte per candidate: the bits of those dimensions.
For a set of anchors and a group, a table of 256 rows holds the sums of every subset of
the anchors' eight components. A byte picks a row, so

    score = sum over bits of weight(bit) * sum over groups of table[group][byte]

with the top bit's weight negative. That is the whole inner product, not an estimate.

The anchors are a stated query set. They are taken in blocks of at most ``BLOCK_ANCHORS``, one
broadcast at a time, and each block is scored against all candidates where those lie: first
against the candidates of the anchor's own label, for its positives, then against the others.
What a task returns are the best few rows of each anchor, so nothing grows with the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltworks.operators.keys import dense_key
from siltworks.staging import passing, settle, staged_path

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
# A negative's score lies between these percentages of the positive's.
LEAST_PERCENT, MOST_PERCENT = 50, 95
GROUP = 8
# Anchors of a broadcast, and the bytes of their components; anchors of one set of tables;
# candidates of a block.
BLOCK_ANCHORS = 16_384
ANCHOR_BYTES = 16 << 20
TABLE_ANCHORS = 128
BLOCK_ROWS = 8_192
# Whole components are below 2 ** MOST_BITS in size, so that scores of any length that fits a
# row are exact in 64 bits.
MOST_BITS = 20

RESULTS = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_NO_ID = np.iinfo(np.int64).max
_BLOCK = "start long, dims int, ids binary, labels binary, planes binary"


def planes_of(values: np.ndarray) -> np.ndarray:
    """Bytes of eight dimensions' bits: an array (bits, groups, rows) for whole ``values``.

    As many bits as the values need, the sign's last.
    """
    rows, dims = values.shape
    largest = int(np.maximum(values, ~values).max(initial=0))
    bits = (values[None] >> np.arange(largest.bit_length() + 1)[:, None, None]) & 1
    packed = np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")
    return np.ascontiguousarray(packed.transpose(0, 2, 1))


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Sums of every subset of eight components: an array (groups, 256, anchors).

    Each dimension doubles the rows: the subsets without it, then those with it.
    """
    count, dims = anchors.shape
    groups = -(-dims // GROUP)
    padded = np.zeros((count, groups * GROUP), np.int64)
    padded[:, :dims] = anchors
    parts = padded.T.reshape(groups, GROUP, count)
    tables = np.zeros((groups, 1, count), np.int64)
    for dim in range(GROUP):
        tables = np.concatenate([tables, tables + parts[:, dim : dim + 1]], axis=1)
    # The narrowest type that holds a sum over all groups.
    largest = int(np.abs(tables).max(axis=1, initial=0).sum(axis=0).max(initial=0))
    for kind in (np.int16, np.int32):
        if largest <= np.iinfo(kind).max:
            return tables.astype(kind)
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products (candidates, anchors) by look-ups, shifts and sums.

    Groups that only one side has are zeros of the other.
    """
    bits, groups, rows = planes.shape
    narrow = tables.dtype == np.int16 and bits <= 15
    total = np.zeros((rows, tables.shape[2]), np.int32 if narrow else np.int64)
    for bit in range(bits):
        picked = np.zeros((rows, tables.shape[2]), tables.dtype)
        for group in range(min(groups, len(tables))):
            picked += tables[group][planes[bit, group]]
        weighted = np.left_shift(picked, bit, dtype=total.dtype)
        if bit == bits - 1:
            total -= weighted
        else:
            total += weighted
    return total


def whole(vector: Column, scale: int = SCALE) -> Column:
    """Each component as a whole number, floor(scale * x) with x as double."""
    return F.transform(vector, lambda x: F.floor(scale * x.cast("double")))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    return vector.isNotNull() & F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )


def candidate_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of ``_id``, ``_label`` and ``_whole``: ``start`` numbers rows, ``planes`` holds bytes.

    Rows of one block have equally many components and ascend by id, nulls last. Row numbers are
    unique in a written table.
    """

    def pack(batches):
        at = TaskContext.get().partitionId() << 40
        held: dict[int, list] = {}

        def block(dims: int):
            nonlocal at
            ids, labels, values = (np.concatenate(x) for x in zip(*held.pop(dims)))
            order = np.argsort(ids, kind="stable")
            arrays = [[at], [dims], *([x.tobytes()] for x in (ids[order], labels[order], planes_of(values[order])))]
            at += len(ids)
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(arrays, kinds)],
                names=["start", "dims", "ids", "labels", "planes"],
            )

        for batch in batches:
            ids = batch.column(0).fill_null(_NO_ID).to_numpy()
            labels = batch.column(1).to_numpy()
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            flat = batch.column(2).flatten().to_numpy()
            if np.maximum(flat, ~flat).max(initial=0) >= 1 << MOST_BITS:
                raise ValueError(f"a whole component is not below 2 ** {MOST_BITS} in size")
            starts = np.cumsum(sizes) - sizes
            for dims in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dims)
                values = flat[starts[own][:, None] + np.arange(dims)]
                for first in range(0, len(own), block_rows):
                    some = slice(first, first + block_rows)
                    held.setdefault(dims, []).append((ids[own[some]], labels[own[some]], values[some]))
                    if sum(len(x[0]) for x in held[dims]) >= block_rows:
                        yield block(dims)
        for dims in list(held):
            yield block(dims)

    return rows.select("_id", "_label", "_whole").mapInArrow(pack, _BLOCK)


class Block:
    """Candidates of one row of :func:`candidate_blocks`."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.rows = row["start"] + np.arange(len(self.ids))
        groups = -(-row["dims"] // GROUP)
        data = np.frombuffer(row["planes"], np.uint8)
        self.planes = data.reshape(-1, groups, len(self.ids)) if groups else data.reshape(0, 0, len(self.ids))


def values_of(block: Block, wanted: np.ndarray, dims: int) -> np.ndarray:
    """The whole components of some rows, from their bit-planes."""
    bits = np.unpackbits(block.planes[:, :, wanted], axis=1, bitorder="little")
    if not len(bits):
        return np.zeros((len(wanted), dims), np.int64)
    weights = np.int64(1) << np.arange(len(bits), dtype=np.int64)
    weights[-1] *= -1
    return np.tensordot(weights, bits.astype(np.int64), 1).T[:, :dims]


def _anchor_rows(blocks: DataFrame, every: int) -> DataFrame:
    """``_row``, ``_id``, ``_label`` and ``_whole`` of the rows whose id is divisible by ``every``."""

    def pick(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                wanted = np.flatnonzero((block.ids % every == 0) & (block.ids != _NO_ID))
                values = values_of(block, wanted, row["dims"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block.rows[wanted]),
                        pa.array(block.ids[wanted]),
                        pa.array(block.labels[wanted]),
                        pa.array(list(values), pa.list_(pa.int64())),
                    ],
                    names=["_row", "_id", "_label", "_whole"],
                )

    return blocks.mapInArrow(pick, "_row long, _id long, _label long, _whole array<long>")


class Anchors:
    """A block of anchors, in sets of up to ``TABLE_ANCHORS`` of one label and length."""

    def __init__(self, rows: list):
        self.row = np.array([r["_row"] for r in rows], np.int64)
        labels = np.array([r["_label"] for r in rows], np.int64)
        dims = np.array([len(r["_whole"]) for r in rows], np.int64)
        order = np.lexsort((dims, labels))
        cuts = np.flatnonzero(np.diff(labels[order]) | np.diff(dims[order])) + 1
        # Of each set: its label, the anchors' places in this block, and their components.
        self.sets: list[tuple[int, np.ndarray, np.ndarray]] = []
        for group in np.split(order, cuts):
            for first in range(0, len(group), TABLE_ANCHORS):
                own = group[first : first + TABLE_ANCHORS]
                values = np.array([rows[i]["_whole"] for i in own], np.int64)
                self.sets.append((int(labels[own[0]]), own, values.reshape(len(own), -1)))


class Best:
    """The best few (score, id, row) of each slot, over the blocks that a task has seen."""

    def __init__(self, slots: int, width: int):
        self.score = np.zeros((slots, width), np.int64)
        self.id = np.full((slots, width), _NO_ID, np.int64)
        self.row = np.full((slots, width), -1, np.int64)  # -1: nothing there

    def add(self, slots: np.ndarray, score: np.ndarray, id_: np.ndarray, row: np.ndarray) -> None:
        """Candidates (slots, n) for some of the slots; those with row -1 are none."""
        width = self.score.shape[1]
        score, id_, row = (
            np.concatenate([a[slots], b], axis=1)
            for a, b in ((self.score, score), (self.id, id_), (self.row, row))
        )
        order = np.lexsort((row, id_, -score, row < 0), axis=1)[:, :width]
        for to, values in ((self.score, score), (self.id, id_), (self.row, row)):
            to[slots] = np.take_along_axis(values, order, axis=1)


def _ranked(score: np.ndarray) -> tuple[np.ndarray, int]:
    """Sorted keys of each anchor, ascending with the score and, for equal ones, with earlier rows.

    The lower bits of a key tell the row, counted from the last.
    """
    rows = len(score)
    bits = max(1, (rows - 1).bit_length())
    keys = (score.T.astype(np.int64) << bits) + ((1 << bits) - 1 - np.arange(rows))
    return np.sort(keys, axis=1), bits


def _best_positives(block: Block, anchors: Anchors, of: tuple, tables: np.ndarray, best: Best) -> None:
    label, own, _ = of
    same = np.flatnonzero(block.labels == label)
    if not len(same):
        return
    keys, bits = _ranked(scores(tables, block.planes[:, :, same]))
    # One more than wanted, as the anchor itself may be among them.
    top = keys[:, ::-1][:, : best.score.shape[1] + 1]
    place = same[(1 << bits) - 1 - (top & ((1 << bits) - 1))]
    rows = block.rows[place]
    best.add(own, top >> bits, block.ids[place], np.where(rows == anchors.row[own][:, None], -1, rows))


def _best_negatives(
    block: Block, of: tuple, tables: np.ndarray, best: Best, low: np.ndarray, high: np.ndarray
) -> None:
    """``low`` and ``high`` bound the scores for each anchor and positive; where low > high, none do."""
    label, own, _ = of
    other = np.flatnonzero(block.labels != label)
    if not len(other):
        return
    width, slots = best.score.shape[1], low.shape[1]
    keys, bits = _ranked(scores(tables, block.planes[:, :, other]))
    for slot in range(slots):
        # The last few keys of scores up to the upper bound.
        bound = ((high[own, slot] + 1) << bits).tolist()
        end = np.array([np.searchsorted(k, b) for k, b in zip(keys, bound)], np.int64)
        place = end[:, None] - 1 - np.arange(width)
        top = np.take_along_axis(keys, np.maximum(place, 0), axis=1)
        score = top >> bits
        found = (place >= 0) & (score >= low[own, slot][:, None])
        chosen = other[(1 << bits) - 1 - (top & ((1 << bits) - 1))]
        best.add(own * slots + slot, score, block.ids[chosen], np.where(found, block.rows[chosen], -1))


def _scan(blocks: DataFrame, shared, slots: int, width: int, use) -> DataFrame:
    """The best of each slot over all blocks: ``_slot``, ``_score``, ``_id``, ``_from`` and ``_n`` from 1.

    ``use`` adds a block to the best of a set of anchors. Tables are made for one set at a time
    and used for all blocks of a batch. A task returns at most ``slots * width`` rows.
    """

    def scan(batches):
        best = Best(slots, width)
        for batch in batches:
            found = [Block(batch.slice(i, 1).to_pylist()[0]) for i in range(batch.num_rows)]
            for of in shared.value[0].sets:
                tables = subset_sums(of[2])
                for block in found:
                    use(block, shared.value, of, tables, best)
        slot, n = np.nonzero(best.row >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (slot, best.score[slot, n], best.id[slot, n], best.row[slot, n])],
            names=["_slot", "_score", "_id", "_from"],
        )

    found = blocks.mapInArrow(scan, "_slot long, _score long, _id long, _from long")
    first = Window.partitionBy("_slot").orderBy(F.desc("_score"), "_id", "_from")
    return found.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= width)


def _id(name: str) -> Column:
    return F.when(F.col(name) != _NO_ID, F.col(name))


def _triples(
    blocks: DataFrame, anchors: DataFrame, positives: int, negatives: int, percents: tuple[int, int]
) -> DataFrame:
    """What one block of anchors finds; ``anchors`` are numbered from 0 by ``_slot``."""
    context = blocks.sparkSession.sparkContext
    rows = sorted(anchors.collect(), key=lambda r: r["_slot"])  # at most BLOCK_ANCHORS
    block = Anchors(rows)
    found = _scan(
        blocks, context.broadcast((block,)), len(rows), positives,
        lambda b, s, of, tables, best: _best_positives(b, s[0], of, tables, best),
    )
    chosen = settle(found, "positives", plain=True)
    # At most BLOCK_ANCHORS x positives scores.
    scored = [tuple(r) for r in chosen.select("_slot", "_n", "_score").collect()]
    slot, n, score = np.array(scored, np.int64).reshape(-1, 3).T
    low, high = np.ones((len(rows), positives), np.int64), np.zeros((len(rows), positives), np.int64)
    low[slot, n - 1] = -(-percents[0] * score // 100)
    high[slot, n - 1] = percents[1] * score // 100
    found = _scan(
        blocks, context.broadcast((block, low, high)), len(rows) * positives, negatives,
        lambda b, s, of, tables, best: _best_negatives(b, of, tables, best, s[1], s[2]),
    )
    of_pair = chosen.join(anchors.select("_slot", F.col("_id").alias("anchor_id")), "_slot").select(
        (F.col("_slot") * positives + F.col("_n") - 1).alias("_pair"),
        "anchor_id",
        _id("_id").alias("positive_id"),
        F.col("_score").alias("positive_score"),
    )
    mined = found.select(
        F.col("_slot").alias("_pair"),
        F.col("_n").alias("rank"),
        _id("_id").alias("negative_id"),
        F.col("_score").alias("negative_score"),
    )
    return mined.join(of_pair, "_pair").select(*(column.split()[0] for column in RESULTS.split(", ")))


def hard_negatives(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    every: int = 50,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percents: tuple[int, int] = (LEAST_PERCENT, MOST_PERCENT),
    scale: int = SCALE,
    block_anchors: int = BLOCK_ANCHORS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """For each anchor and positive the best rows of other labels whose score lies in a range.

    Anchors are the rows whose ``key`` is divisible by ``every``. An anchor's positives are its
    ``positives`` best other rows of the same label; the negatives of a positive with score p are
    the first ``negatives`` rows of other labels with a score s such that
    ``percents[0] * p <= 100 * s <= percents[1] * p``. Higher scores come first, then smaller keys,
    a null key last. Scores are inner products of ``floor(scale * x)``; a shorter vector goes on
    with zeros, and an empty one scores zero.

    Rows with a null label, a null vector or a component that is null or not finite take no part;
    a component of 2 ** ``MOST_BITS`` or more after scaling fails the job. A row with a null key
    is no anchor but takes part. Repeated rows are rows of their own: a copy of an anchor is one of
    its positives, and an anchor twice in the table is twice in the result. No anchor, no positive
    or no negative gives no rows. Other columns are not read.
    """
    spark = rows.sparkSession
    used = rows.select(
        F.col(key).cast("long").alias("_id"),
        F.col(label).cast("long").alias("_label"),
        F.col(vector).alias("_vector"),
    ).filter(F.col("_label").isNotNull() & usable(F.col("_vector")))
    whole_rows = used.select("_id", "_label", whole(F.col("_vector"), scale).alias("_whole"))
    blocks = settle(candidate_blocks(whole_rows, block_rows), "candidates")
    anchors = settle(_anchor_rows(blocks, every), "anchors")
    numbered = settle(dense_key(anchors, "_number", ["_id", "_row"], replayable=True), "numbered")
    total, dims = numbered.agg(F.count("*"), F.max(F.size("_whole"))).first()
    size = min(block_anchors, max(1, ANCHOR_BYTES // (8 * max(1, dims or 0))))
    path = staged_path(spark, "hard_negatives")
    for start in range(0, total, size):
        some = numbered.filter(F.col("_number").between(start + 1, start + size))
        with passing(spark):
            found = _triples(
                blocks, some.withColumn("_slot", F.col("_number") - 1 - start), positives, negatives, percents
            )
            found.write.mode("append").parquet(path)
    return spark.read.schema(RESULTS).parquet(path) if total else spark.createDataFrame([], RESULTS)
