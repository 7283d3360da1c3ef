"""Token ids in Arrow files of equal-length sequences.

A file is a complete Arrow file whose batches hold ``ids`` and ``mask`` as fixed-size lists of
``length`` values, neither compressed nor with nulls, so that a memory-mapped file gives
sequence i as two views, without a copy: row i % ``BATCH`` of batch i // ``BATCH``. The mask, a bit
each, is set for a token and not for padding. ``documents`` lists the documents that begin in a sequence,
with the place of their first token in it and their number of tokens; a document runs on
into the following sequences of its file.

Documents follow each other in ascending order of their keys through the files, which are
ordered by the ``range`` and ``number`` in their metadata. A file ends with a document, so each
can be read, checked and rewritten on its own; only its last sequence is padded. Spark's own
writer puts the files in place, so they reach any file system Spark writes to, and a task that
runs twice leaves one of each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from siltworks.llm.frames import binary_texts
from siltworks.llm.tokens import Vocabulary, encoder_of
from siltworks.llm.words import blocks
from siltworks.staging import settle, staged_path

LENGTH = 2048
END = 1
# Sequences of a batch, and of a file before it ends at the next end of a document.
BATCH = 256
FILE_SEQUENCES = 2048
# Rows and bytes of texts that are encoded at a time. Arrays of 8 bytes for each byte and each word
# come and go meanwhile, so few texts at a time keep a worker small.
ROWS = 1024
TEXT_BYTES = 1 << 19
# Bytes of texts in one range of the documents' order.
RANGE_BYTES = 32 << 20
# An Arrow file ends with these bytes. Spark's text writer puts them after each value,
# and a file gets one value.
MAGIC = b"ARROW1"


def sequence_schema(length: int, id_type: str) -> pa.Schema:
    documents = pa.struct([("key", pa.int64()), ("at", pa.int32()), ("n_tokens", pa.int64())])
    return pa.schema(
        [
            pa.field("ids", pa.list_(pa.field("id", pa.type_for_alias(id_type), False), length), False),
            pa.field("mask", pa.list_(pa.field("set", pa.bool_(), False), length), False),
            pa.field("documents", pa.list_(documents), False),
        ]
    )


def file_of(
    keys: list[int | None], tokens: list[np.ndarray], length: int, id_type: str, place: dict[str, int]
) -> pa.Buffer:
    """A file of whole documents; ``place`` goes into its metadata."""
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    total, starts = int(sizes.sum()), np.cumsum(sizes) - sizes
    rows = -(-total // length)
    ids = np.zeros(rows * length, id_type)
    np.concatenate(tokens, out=ids[:total], casting="same_kind")
    mask = np.zeros(rows * length, bool)
    mask[:total] = True
    schema = sequence_schema(length, id_type)
    documents = pa.StructArray.from_arrays(
        [pa.array(keys, pa.int64()), pa.array((starts % length).astype(np.int32)), pa.array(sizes)],
        fields=list(schema.field("documents").type.value_type),
    )
    first = np.searchsorted(starts, np.arange(rows + 1) * length).astype(np.int32)
    table = pa.RecordBatch.from_arrays(
        [
            pa.FixedSizeListArray.from_arrays(pa.array(ids), type=schema.field("ids").type),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), type=schema.field("mask").type),
            pa.ListArray.from_arrays(pa.array(first), documents),
        ],
        schema=schema,
    )
    described = schema.with_metadata({name: str(value) for name, value in place.items()})

    def write(sink) -> None:
        with pa.ipc.new_file(sink, described) as writer:
            for at in range(0, rows, BATCH):
                writer.write_batch(table.slice(at, BATCH).replace_schema_metadata(described.metadata))

    measured = pa.MockOutputStream()
    write(measured)
    content = pa.allocate_buffer(measured.size())
    write(pa.FixedSizeBufferWriter(content))
    return content


class Sequences:
    """Random access to the sequences of one file, by views into its bytes.

    ``source`` is a buffer or the path of a file to map into memory.
    """

    def __init__(self, source: pa.Buffer | str):
        opened = pa.memory_map(source) if isinstance(source, str) else pa.BufferReader(source)
        self.reader = pa.ipc.open_file(opened)
        self.length = self.reader.schema.field("ids").type.list_size
        self.place = {k.decode(): int(v) for k, v in (self.reader.schema.metadata or {}).items()}
        self.batches = [self.reader.get_batch(i) for i in range(self.reader.num_record_batches)]

    def __len__(self) -> int:
        if not self.batches:
            return 0
        return BATCH * (len(self.batches) - 1) + self.batches[-1].num_rows

    def ids(self, number: int) -> np.ndarray:
        """The ids of a batch, a row for each sequence."""
        return self.batches[number].column("ids").flatten().to_numpy().reshape(-1, self.length)

    def __getitem__(self, row: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= row < len(self):
            raise IndexError(row)
        number, row = divmod(row, BATCH)
        return self.ids(number)[row], self.batches[number].column("mask")[row].values

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Key, tokens before it in the file, and ids of each document, in order.

        The documents must cover the tokens that the masks tell, without gaps.
        """
        if not self.batches:
            return
        numbers = range(len(self.batches))
        ids = np.concatenate([self.ids(i).reshape(-1) for i in numbers])
        total = sum(batch.column("mask").flatten().true_count for batch in self.batches)
        at = row = 0
        for batch in self.batches:
            lists = batch.column("documents")
            of = row + np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            row += len(lists)
            keys, first, sizes = lists.flatten().flatten()
            starts = of * self.length + first.to_numpy()
            for key, start, size in zip(keys.to_pylist(), starts.tolist(), sizes.to_pylist()):
                if start != at:
                    raise ValueError(f"a document starts at token {start}, not at {at}")
                at += size
                yield key, start, ids[start:at]
        if at != total:
            raise ValueError(f"documents of {at} tokens among {total}")


def write_token_files(
    docs: DataFrame,
    vocabulary: Vocabulary,
    path: str,
    text: str = "text",
    key: str = "doc_id",
    length: int = LENGTH,
    end: int = END,
    id_type: str = "uint16",
    file_sequences: int = FILE_SEQUENCES,
    range_bytes: int = RANGE_BYTES,
) -> None:
    """The ids of all documents, each closed by ``end``, in files below ``path``.

    Documents are in ascending order of ``key``, an integer, null before all; rows with equal
    keys are documents of their own, ordered by length and hash of their texts. A null text is
    empty, so its document is the end mark alone. An empty table leaves no file with sequences. An
    id that ``id_type`` does not hold fails the job. Texts are put in order before they are
    encoded, so nothing but the files is written. A task holds one file, some texts and one
    document at a time.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # Rows alike in key and text are interchangeable; their place in the input keeps many of them
    # from ending up in one range.
    order = ["_key", "_size", "_print", "_place"]
    rows = docs.select(
        F.col(key).cast("long").alias("_key"),
        value.alias("_text"),
        F.octet_length(value).alias("_size"),
        F.xxhash64(value).alias("_print"),
        F.monotonically_increasing_id().alias("_place"),
    )
    size = rows.agg(F.sum(F.col("_size") + 1)).first()[0] or 0
    parts = max(1, -(-size // range_bytes))
    ordered = rows.repartitionByRange(int(parts), *order).sortWithinPartitions(*order)

    def files(batches):
        encoder, limit = encoder_of(vocabulary), np.iinfo(id_type).max
        least, place = file_sequences * length, {"range": TaskContext.get().partitionId(), "number": 0}
        keys, tokens, held = [], [], 0

        def file():
            content = file_of(keys, tokens, length, id_type, place)
            size = content.size - len(MAGIC)
            if content.slice(size).to_pybytes() != MAGIC:
                raise ValueError("an Arrow file has another end than expected")
            edges = pa.py_buffer(np.array([0, size], np.int32))
            value = pa.Array.from_buffers(pa.binary(), 1, [None, edges, content.slice(0, size)])
            return pa.RecordBatch.from_arrays([value], names=["value"])

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                texts, own = binary_texts(some, "_text"), some.column(0).to_pylist()
                for first, last in blocks(texts, TEXT_BYTES):
                    for row, ids in enumerate(encoder.encode(texts[first:last]), first):
                        if ids.max(initial=end) > limit:
                            raise ValueError(f"an id of {int(ids.max())} is no {id_type}")
                        keys.append(own[row])
                        tokens.append(np.append(ids, np.uint32(end)).astype(id_type))
                        held += len(tokens[-1])
                        if held >= least:
                            yield file()
                            keys, tokens, held = [], [], 0
                            place["number"] += 1
        if keys:
            yield file()

    written = ordered.select("_key", "_text").mapInArrow(files, "value binary")
    written.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).option(
        "lineSep", MAGIC.decode()
    ).text(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of the files below ``path``: ``key``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` is the number of tokens of all documents before; ``with_ids`` adds ``ids``. The
    checksum is of the ids as little-endian unsigned 32-bit integers.
    """
    fields = [
        *(T.StructField(n, T.LongType()) for n in ("range", "number", "key", "at", "n_tokens", "ids_crc32"))
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    kinds = [pa.int64()] * 6 + [pa.list_(pa.int64())] * with_ids

    def documents(batches):
        for batch in batches:
            for content in batch.column(0):
                file = Sequences(content.as_buffer())
                rows: list[list] = [[] for _ in fields]
                for key, start, ids in file.documents():
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    values = [file.place["range"], file.place["number"], key, start, len(ids), crc]
                    for to, value in zip(rows, values + [ids.astype(np.int64)] * with_ids):
                        to.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(rows, kinds)], names=[f.name for f in fields]
                )

    # An empty table is written as a file without a value.
    content = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")
    found = settle(content.mapInArrow(documents, T.StructType(fields)), "token_documents")
    sizes = found.groupBy("range", "number").agg(F.sum("n_tokens").alias("size"))
    # One row per file, then one per range.
    within = Window.partitionBy("range").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.groupBy("range").agg(F.sum("size").alias("size")).select(
        "range", F.coalesce(F.sum("size").over(across), F.lit(0)).alias("_range_start")
    )
    files = settle(
        sizes.join(ranges, "range").select(
            "range",
            "number",
            (F.coalesce(F.sum("size").over(within), F.lit(0)) + F.col("_range_start")).alias("_start"),
        ),
        "file_starts",
        plain=True,
    )
    names = ["key", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    return (
        found.join(files, ["range", "number"])
        .withColumn("start", F.col("_start") + F.col("at"))
        .select(*names)
    )


def token_documents(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", key: str = "doc_id", **settings
) -> DataFrame:
    """Documents written as token files and read back from them.

    Returns ``key``, ``start``, ``n_tokens`` and ``ids_crc32``; other columns are not written.
    """
    spark = docs.sparkSession
    path = staged_path(spark, "token_files")
    write_token_files(docs, vocabulary, path, text, key, **settings)
    return read_token_files(spark, path).withColumnRenamed("key", key)
