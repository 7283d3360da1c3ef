"""Best-fit packing of token pieces into sequences of bounded length.

Pieces of one length are interchangeable, and so are gaps of one size, so the
matching sees at most ``capacity`` counters of either, whatever the number of documents:
those are all that reaches the driver. Documents and gaps are sorted by size and swept
from large to small; a piece takes the least gap that holds it (its successor), a gap takes
one piece a sweep, and where pieces compete the lower rank goes first. The gaps are
updated and the sweep repeats; what fits nowhere opens new sequences. The rows find their
places in Spark, by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from siltworks.llm.frames import binary_texts, without
from siltworks.llm.tokens import Vocabulary, encoder_of
from siltworks.llm.words import blocks
from siltworks.staging import settle

CAPACITY = 2048
END = 0
# Ranks within a length are counted in parts of at most about so many pieces, and a length of
# which there are more than a few pieces in several, so that no length is one group.
RANK_ROWS = 1_000_000
FEW_ROWS, SOME_PARTS = 1024, 64

RESULTS = ["piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]


def pieces(
    docs: DataFrame,
    tokenizer: Vocabulary,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens, each document's ids closed by ``END``."""
    kept = [name for name in without(docs, RESULTS) if name.lower() in {k.lower() for k in keep}]
    narrow = docs.select(*kept, F.col(text).alias("_packed_text"))

    def cut(batches):
        encoder = encoder_of(tokenizer)
        for batch in batches:
            texts = binary_texts(batch, "_packed_text")
            own = batch.select([n for n in batch.schema.names if n != "_packed_text"])
            for first, last in blocks(texts):
                row_of, piece, start, length, crc, ids = [], [], [], [], [], []
                for row, tokens in enumerate(encoder.encode(texts[first:last]), first):
                    tokens = np.append(tokens, np.uint32(END)).astype("<u4")
                    for number, at in enumerate(range(0, len(tokens), capacity)):
                        part = tokens[at : at + capacity]
                        row_of.append(row)
                        piece.append(number)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            ids.append(part.astype(np.int64))
                columns = list(own.take(pa.array(row_of, pa.int64())).columns) + [
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                ]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [
        *(docs.schema[name] for name in kept),
        T.StructField("piece", T.IntegerType()),
        *(T.StructField(name, T.LongType()) for name in ("start", "length", "ids_crc32")),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    names = [field.name for field in fields]
    return narrow.mapInArrow(cut, T.StructType(fields))


Run = tuple[int, int, int, int, int]


class Sweeps:
    """Best-fit by sweeps over counts of lengths; ``runs`` say where ranks go.

    A run (length, first rank, count, first sequence, offset) places pieces of one length
    with consecutive ranks in consecutive sequences.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.left = dict(counts)
        self.rank = dict.fromkeys(counts, 0)
        self.gaps: dict[int, deque[tuple[int, int]]] = defaultdict(deque)
        self.runs: list[Run] = []
        while self.left:
            self._open()
            while self._sweep():
                pass

    def _place(self, length: int, count: int, sequence: int, gap: int) -> None:
        self.runs.append((length, self.rank[length], count, sequence, self.capacity - gap))
        self.rank[length] += count
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]

    def _open(self) -> None:
        """Sequences for the longest pieces left: as many as those left fill at the least."""
        wanted = -(-sum(n * count for n, count in self.left.items()) // self.capacity)
        for length in sorted(self.left, reverse=True):
            count = min(wanted, self.left[length])
            if not count:
                break
            self._place(length, count, self.sequences, self.capacity)
            if length < self.capacity:
                self.gaps[self.capacity - length].append((self.sequences, count))
            self.sequences += count
            wanted -= count

    def _sweep(self) -> bool:
        """Match every piece with its successor among the gaps, one piece for each gap."""
        free: list[tuple[int, int, int]] = []  # gap, sequence, count; the least on top
        updated: dict[int, deque[tuple[int, int]]] = defaultdict(deque)
        placed = False
        for size in sorted({*self.gaps, *self.left}, reverse=True):
            free += [(size, sequence, count) for sequence, count in self.gaps.pop(size, ())]
            wanted = self.left.get(size, 0)
            while wanted and free:
                gap, sequence, count = free.pop()
                used = min(count, wanted)
                self._place(size, used, sequence, gap)
                placed = True
                wanted -= used
                if gap > size:
                    updated[gap - size].append((sequence, used))
                if used < count:
                    free.append((gap, sequence + used, count - used))
        for gap, sequence, count in free:
            updated[gap].append((sequence, count))
        self.gaps = updated
        return placed and bool(self.left)


def _rank_parts(count: int) -> int:
    return max(min(SOME_PARTS, -(-count // FEW_ROWS)), -(-count // RANK_ROWS))


def packed(pieces: DataFrame, order: Sequence[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, by their column ``length``.

    ``order`` names columns that tell pieces of one length apart; those it does not are
    interchangeable. Null values in it are equal. ``pieces`` is a written table.
    """
    counts = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    runs = Sweeps({row["length"]: row["count"] for row in counts}, capacity).runs
    runs.sort()
    table = np.array(runs, np.int64).reshape(-1, 5)
    shared = pieces.sparkSession.sparkContext.broadcast(table)

    parts = [(row["length"], _rank_parts(row["count"])) for row in counts]
    lengths = pieces.sparkSession.createDataFrame(parts, "length long, _parts long")
    part = F.pmod(F.xxhash64(*order), F.col("_parts"))
    parted = pieces.join(F.broadcast(lengths), "length").select(*pieces.columns, part.alias("_part"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # At most capacity x SOME_PARTS rows, and one for each RANK_ROWS pieces.
    offsets = (
        parted.groupBy("length", "_part")
        .count()
        .select("length", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("length", "_part").orderBy(*order)
    ranked = (
        parted.withColumn("_rank", F.row_number().over(within))
        .join(F.broadcast(offsets), ["length", "_part"])
        .withColumn("_rank", F.col("_rank") - 1 + F.col("_before"))
        .select(*pieces.columns, "_rank")
    )

    def place(batches):
        runs = shared.value
        key = (runs[:, 0] << 44) + runs[:, 1]
        for batch in batches:
            names = batch.schema.names
            rank = batch.column(names.index("_rank")).to_numpy()
            length = batch.column(names.index("length")).to_numpy()
            row = np.searchsorted(key, (length << 44) + rank, "right") - 1
            found = runs[row] if len(runs) else np.zeros((0, 5), np.int64)
            sequence = found[:, 3] + rank - found[:, 1]
            arrays = [batch.column(i) for i, n in enumerate(names) if n != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(sequence), pa.array(found[:, 4])],
                names=[*(n for n in names if n != "_rank"), "sequence_id", "offset"],
            )

    schema = T.StructType(
        [
            *pieces.schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    return ranked.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: Vocabulary,
    text: str = "text",
    key: str = "doc_id",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    A null or empty text is the end mark alone. Rows with equal keys, null ones too, are
    packed one by one. ``key`` and the results are the only columns.
    """
    cut = settle(pieces(docs, tokenizer, text, [key], capacity, with_ids), "pieces")
    return packed(cut, [key, "piece", "ids_crc32"], capacity)
