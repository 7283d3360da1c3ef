"""Documents and arrays packed into binary columns, for work by the block."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.llm.frames import binary_texts


def pack(values: np.ndarray) -> bytes:
    """Bytes of equal place side by side, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return len(values).to_bytes(8, "little") + pa.compress(
        planes.tobytes(), codec="zstd", asbytes=True
    )


def unpack(data: bytes, kind) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(data[8:], decompressed_size=n * width, codec="zstd", asbytes=True)
    rows = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return np.ascontiguousarray(rows).view(kind).reshape(-1)


def pack_bytes(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack_bytes(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True)


def document_blocks(
    docs: DataFrame, key: str, text: str, block_bytes: int, **flags: Column
) -> DataFrame:
    """Documents in blocks of about ``block_bytes``: ``block``, ``keys``, flags, ``lengths``, ``texts``.

    The texts of a block are one compressed value; a longer text is a block of its own. Blocks
    are numbered by the task that made them, so they are told apart only in a written table.
    """
    key_type, flag_columns = docs.schema[key].dataType, range(1, 1 + len(flags))
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("keys", T.ArrayType(key_type)),
            *(T.StructField(name, T.ArrayType(T.BooleanType())) for name in flags),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("texts", T.BinaryType()),
        ]
    )

    def blocks(batches):
        number = TaskContext.get().partitionId() << 32
        keys, marks, texts, size = [], [], [], 0

        def block():
            joined = pa.concat_arrays(keys)
            columns = [
                pa.array([number], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(joined)], pa.int32()), joined),
                *(pa.array([list(column)], pa.list_(pa.bool_())) for column in zip(*marks)),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                pa.array([pack_bytes(b"".join(texts))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            own = list(zip(*(batch.column(i).to_pylist() for i in flag_columns)))
            for row, value in enumerate(binary_texts(batch, "_text")):
                value = value or b""
                if texts and size + len(value) > block_bytes:
                    yield block()
                    number += 1
                    keys, marks, texts, size = [], [], [], 0
                keys.append(batch.column(0).slice(row, 1))
                marks.append(own[row] if own else ())
                texts.append(value)
                size += len(value)
        if texts:
            yield block()

    return docs.select(
        F.col(key).alias("_key"), *(c.alias(n) for n, c in flags.items()), F.col(text).alias("_text")
    ).mapInArrow(blocks, schema)


def block_texts(row: dict) -> list[bytes]:
    """The texts of a block, from its ``lengths`` and ``texts``."""
    data = unpack_bytes(row["texts"])
    edges = np.append(0, np.cumsum(row["lengths"])).astype(int).tolist()
    return [data[a:b] for a, b in zip(edges, edges[1:])]


def hash_range(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` even ranges a hash falls in; ascending with the hash."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def table_of(columns: dict[str, tuple[list, pa.DataType]]) -> pa.Table:
    return pa.table(
        [pa.array(values, kind) for values, kind in columns.values()], names=list(columns)
    )
