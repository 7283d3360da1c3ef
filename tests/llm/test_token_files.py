"""Token files: exact round trips, random access without copies, and order."""

import glob
import string
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltworks.llm import token_files
from siltworks.llm.tokens import PlainTokens, WordTokens, cuts_words, encoder_of, word_vocabulary
from siltworks.staging import staged_path
from tests.llm.conftest import SCHEMA, as_multiset, awkward_rows, invented

TOKENIZER = word_vocabulary()


def plain_documents(rows, path=TOKENIZER):
    """Key, start, size and checksum of the documents in order."""
    tokenizer, listed = Tokenizer.from_file(path), []
    for key, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [token_files.END]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        size = len((text or "").encode())
        listed.append(((key is not None, key or 0, size), key, len(ids), crc, ids))
    found, start = [], 0
    for _, key, size, crc, ids in sorted(listed, key=lambda x: x[0]):
        found.append((key, start, size, crc, ids))
        start += size
    return found


@pytest.mark.parametrize("settings", [{}, {"length": 16, "file_sequences": 3, "range_bytes": 4000}])
def test_round_trip(spark, clashing, nothing, settings):
    columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
    found = token_files.token_documents(
        clashing.withColumn("START", F.lit(1)).withColumn("key", F.lit("x")), word_vocabulary, **settings
    )
    assert found.columns == columns
    wanted = [row[:4] for row in plain_documents(awkward_rows())]
    assert as_multiset(found.collect()) == as_multiset(wanted)
    assert token_files.token_documents(nothing, word_vocabulary, **settings).count() == 0


def test_random_access(spark, awkward):
    path = staged_path(spark, "own_files")
    token_files.write_token_files(awkward, TOKENIZER, path, length=64, file_sequences=300)
    read = token_files.read_token_files(spark, path, with_ids=True)
    wanted = plain_documents(awkward_rows())
    assert as_multiset((r[0], r[1], r[4]) for r in read.collect()) == as_multiset(
        (key, start, ids) for key, start, _, _, ids in wanted
    )
    files = [token_files.Sequences(name) for name in glob.glob(f"{path}/part-*")]
    files.sort(key=lambda file: (file.place["range"], file.place["number"]))
    assert any(len(file) > token_files.BATCH for file in files)
    stream = []
    for file in files:
        whole, last = len(file) - 1, None
        for row in range(len(file)):
            ids, mask = file[row]
            assert ids.shape == (64,) and len(mask) == 64 and not ids.flags.owndata
            mask = mask.to_numpy(zero_copy_only=False)
            if row < whole:
                assert mask.all()
            stream += ids[mask].tolist()
            last = mask
        assert (np.diff(last.astype(int)) <= 0).all()
        with pytest.raises(IndexError):
            file[len(file)]
    assert stream == [i for row in wanted for i in row[4]]
    # A view lies inside the mapped file: no bytes are allocated for it.
    before = pa.total_allocated_bytes()
    views = [files[0][row] for row in range(len(files[0]))]
    assert pa.total_allocated_bytes() == before and len(views) == len(files[0])


def test_damaged_file():
    content = token_files.file_of([1, 2], [np.arange(5, dtype=np.uint16)] * 2, 4, "uint16", {"range": 0})
    assert [x[:2] for x in token_files.Sequences(content).documents()] == [(1, 0), (2, 5)]
    table = pa.ipc.open_file(pa.BufferReader(content)).read_all()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, table.schema) as writer:
        writer.write_table(table.slice(1))
    with pytest.raises(ValueError):
        list(token_files.Sequences(sink.getvalue()).documents())


def test_copies_are_dealt_out(spark):
    """A key with most of the rows does not end up in one range."""
    text = invented(9, 50)
    rows = [(7, text, None, None, None)] * 400 + [(i, text, None, None, None) for i in range(100)]
    docs = spark.createDataFrame(rows, SCHEMA)
    path = staged_path(spark, "copies")
    token_files.write_token_files(docs, TOKENIZER, path, length=128, range_bytes=8192)
    sizes = [len(token_files.Sequences(name)) for name in glob.glob(f"{path}/part-*")]
    assert len(sizes) > 5 and max(sizes) < sum(sizes) / 3
    found = token_files.read_token_files(spark, path)
    assert as_multiset(found.collect()) == as_multiset(r[:4] for r in plain_documents(rows))


def test_ids_too_large(spark, awkward):
    with pytest.raises(Exception, match="is no uint8"):
        token_files.token_documents(awkward, TOKENIZER, id_type="uint8").collect()


def test_encoders(tmp_path):
    """Only tokenizers of the known kind are encoded word by word."""
    texts = [row[1].encode() if row[1] is not None else None for row in awkward_rows()]
    assert cuts_words(Tokenizer.from_file(TOKENIZER))
    assert isinstance(encoder_of(TOKENIZER), WordTokens)
    other = TOKENIZER.replace("word_bpe_49k", "byte_bpe_50k")
    assert isinstance(encoder_of(other), PlainTokens)
    for path in (TOKENIZER, other):
        plain = Tokenizer.from_file(path)
        for text, ids in zip(texts, encoder_of(path).encode(texts)):
            assert ids.tolist() == plain.encode((text or b"").decode(), add_special_tokens=False).ids


def test_known_words_are_small():
    """A worker keeps the words it knows in arrays: some 40 bytes a word, and their ids."""
    tokens = WordTokens(encoder_of(TOKENIZER).tokenizer)
    words = [f"{a}{b}{c}" for a in string.ascii_lowercase for b in string.ascii_lowercase for c in ("xq", "zj", "kv", "wu")]
    words += [word + end for word in words for end in ("ab", "cd", "ef", "gh", "ij", "kl", "mn", "op", "qr")]
    tracemalloc.start()
    try:
        tokens._forget()
        before = tracemalloc.get_traced_memory()[0]
        for at in range(0, len(words), 5000):
            tokens.encode([" ".join(words[at : at + 5000]).encode()])
        used = tracemalloc.get_traced_memory()[0] - before
    finally:
        tracemalloc.stop()
    assert used < 130 * len(words)
    assert len(tokens.hashes) == len(words) and (np.diff(tokens.hashes.astype(object)) > 0).all()
    plain = PlainTokens(tokens.tokenizer)
    for text in (b"", " ".join(words[::7]).encode()):
        assert tokens.encode([text])[0].tolist() == plain.encode([text])[0].tolist()
