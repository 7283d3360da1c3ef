"""Packing, archives and the learned models."""

import base64
import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from siltworks.llm import archives, language, language_model, packing, quality
from siltworks.llm import tokens as token_module
from siltworks.llm.tokens import encoder_of, word_vocabulary
from tests.llm.conftest import SCHEMA, as_multiset, awkward_rows, invented

TOKENIZER = word_vocabulary()


def test_pieces(clashing):
    plain = Tokenizer.from_file(TOKENIZER)
    wanted = []
    for doc_id, text, *_ in awkward_rows():
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[at : at + 64], "<u4")
            wanted.append((doc_id, piece, at, len(part), zlib.crc32(part.tobytes())))
    found = packing.pack_documents(clashing, TOKENIZER, capacity=64)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert as_multiset(found.select(columns).collect()) == as_multiset(wanted)
    check_sequences(found, 64)


def check_sequences(found, capacity):
    filled = {}
    for row in found.collect():
        filled.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    total = 0
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
        total += at
    return len(filled), total


def test_packing_is_tight(spark, nothing):
    rng = np.random.default_rng(3)
    lengths = np.minimum(rng.geometric(0.004, 5000), 2048)
    rows = [(i, int(n)) for i, n in enumerate(lengths)] + [(i, 2048) for i in range(50)] + [(0, 1)] * 2000
    pieces = spark.createDataFrame(rows, "doc_id long, length long").repartition(5).cache()
    used, total = check_sequences(packing.packed(pieces, ["doc_id"]), 2048)
    assert used <= math.ceil(total / 2048) * 1.01 + 1
    assert packing.pack_documents(nothing, TOKENIZER).count() == 0


def test_words_are_learned_afresh(monkeypatch):
    monkeypatch.setattr(token_module, "KNOWN_TOKENS", 50)
    tokens, plain = encoder_of(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for seed in range(5):
        texts = [invented(seed, 30), "", "don't... STOP—it's 3.14% <|startoftext|>"]
        found = tokens.encode([t.encode() for t in texts])
        assert [f.tolist() for f in found] == [
            plain.encode(t, add_special_tokens=False).ids for t in texts
        ]


PAGES = [
    (1, "http://a/ b", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"),
    (3, None, ""), (4, "http://a/\r\nWARC/1.1", None), (5, "http://é", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (None, "http://n", "alone"), (None, "http://n", "<p>x</p>"), (6, "u", "é" * 50_000),
]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("least", [0, 6])
def test_archived(spark, version, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)
    found = archives.archived(pages, version, least).collect()
    assert len(found) == len(PAGES)
    payloads = {}
    for page_id, _, html in PAGES:
        payloads.setdefault((html or "").encode(), []).append(page_id)
    by_digest = {base64.b32encode(hashlib.sha1(p).digest()).decode(): (p, ids) for p, ids in payloads.items()}
    for row in found:
        payload, ids = by_digest[row["payload_digest"]]
        assert row["payload_bytes"] == len(payload)
        if row["record_type"] == "revisit":
            assert len(payload) >= least and row["refers_to"] == max(i for i in ids if i is not None)
        else:
            assert row["refers_to"] is None
    kinds = Counter((r["payload_digest"], r["record_type"]) for r in found)
    for digest, (payload, ids) in by_digest.items():
        copies = len(ids) - 1 if len(payload) >= least else 0
        assert kinds[digest, "revisit"] == copies and kinds[digest, "response"] == len(ids) - copies


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert archives.archived(pages).count() == 0


def test_foreign_records(spark, tmp_path):
    """DNS answers, HTTP heads without a length and longer than any buffer, and undeclared types."""
    body = b"same body" * 30
    heads = {
        b"1": b"HTTP/1.1 200 OK\r\nX-Page-Id: 1\r\nTransfer-Encoding: chunked",
        b"2": b"HTTP/1.0 200 OK\r\nX-Page-Id: 2\r\nX-Long: " + b"l" * 100_000,
    }
    blocks = [(f"http://a/{k.decode()}", "text/html", head + b"\r\n\r\n" + body) for k, head in heads.items()]
    blocks += [
        ("dns:a.example", "text/dns", b"20010203040506\na.example. 60 IN A 192.0.2.1"), ("ftp://a/x", "no-type", body),
        ("ftp://a/y", "-", body), ("http://a/3", "text/html", b"HTTP/1.1 200 OK without an end"),
    ]
    data = archives.arc_version_block(1, "f.arc") + b"\n"
    for url, kind, block in blocks:
        data += archives.arc_header(1, url=url, ip="192.0.2.1", date="2001", type=kind, length=len(block)) + b"\n" + block + b"\n"
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "f.arc").write_bytes(data)
    archives.arc_to_warc(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    records = [r for f in (tmp_path / "warc").glob("part-*") for r in archives.warc_records(archives._unpacked(f.read_bytes()))]
    found = {h["warc-target-uri"]: (h["warc-type"], h["content-type"], bytes(b)) for h, b in records}
    assert found["dns:a.example"] == ("resource", "text/dns", blocks[2][2])
    assert found["ftp://a/x"] == found["ftp://a/y"] == ("resource", archives.UNKNOWN_TYPE, body)
    assert found["http://a/3"][0] == "resource" and found["http://a/2"][:2] == ("response", archives.HTTP)
    read = {r["page_id"]: r for r in archives.read_warc(spark, str(tmp_path / "warc")).collect() if r["page_id"]}
    assert (read[1]["record_type"], read[1]["payload_bytes"]) == ("revisit", len(body))
    assert (read[2]["record_type"], read[2]["payload_bytes"]) == ("response", len(body))
    assert read[1]["payload_digest"] == read[2]["payload_digest"] == archives.base32_sha1(body)


def test_arc_headers():
    body = b"abc"
    data = archives.arc_version_block(2, "f.arc") + b"\n"
    head = archives.arc_header(
        2, url="http://x", ip="1.2.3.4", date="20010203", type="text/plain", code=200, length=len(body)
    )
    data += head + b"\n" + body + b"\n"
    [(fields, block)] = archives.arc_records(data)
    assert bytes(block) == body and fields["code"] == "200" and fields["checksum"] == "-"
    assert archives.warc_date(fields["date"]) == "2001-02-03T00:00:00Z"
    assert archives.warc_date("x") == "1996-01-01T00:00:00Z"
    with pytest.raises(ValueError):
        list(archives.arc_records(data[:-3]))


def plain_model(rows):
    train, out = Counter(), []
    texts = [((r[1] or "").encode().lower().split() + [None]) for r in rows]
    held = [zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 7 == 2 for r in rows]
    for tokens, flag in zip(texts, held):
        if not flag:
            train.update(tokens)
    n, v = sum(train.values()), len(train)
    for row, tokens, flag in zip(rows, texts, held):
        base = sum(math.log10((train[t] + 1) / (n + v + 1)) for t in tokens)
        out.append((row[0], flag, len(tokens), sum(train[t] > 0 for t in tokens), n, base))
    return out


def plain_interpolation(rows, weights):
    uni, bi, docs = Counter(), Counter(), 0
    for row in rows:
        if zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 7 != 2:
            tokens = (row[1] or "").encode().lower().split() + [None]
            uni.update(tokens)
            bi.update(zip(["<start>", *tokens], tokens))
            docs += 1
    n, v = sum(uni.values()), len(uni)
    scores = []
    for row in rows:
        tokens = (row[1] or "").encode().lower().split() + [None]
        score = 0.0
        for h, w in zip(["<start>", *tokens], tokens):
            c = docs if h == "<start>" else uni[h]
            l2, l1, l0 = weights[int(language_model.buckets(np.array([c]))[0])]
            score += math.log10((l2 * bi[h, w] / c if c else 0) + l1 * uni[w] / n + l0 / (v + 1))
        scores.append(score)
    return scores


@pytest.mark.parametrize("options", [{}, {"block_bytes": 2000, "range_bytes": 3000}])
def test_language_model(spark, clashing, options, monkeypatch):
    learned, learn = [], language_model.learn
    monkeypatch.setattr(
        language_model, "learn", lambda *a: learned.append(learn(*a)) or learned[-1]
    )
    found = sorted(language_model.scored(clashing, **options).collect(), key=repr)
    rows = awkward_rows()
    wanted = plain_model(rows)
    scores = plain_interpolation(rows, learned[0])
    wanted = sorted(((*w, s) for w, s in zip(wanted, scores)), key=repr)
    found = sorted((tuple(r) for r in found), key=repr)
    for a, b in zip(found, wanted, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_weights_prefer_what_predicts():
    """A context that always has the same successor trusts the bigram; deleted counts matter."""
    bigram, context = np.full(1000, 50), np.full(1000, 50)
    cell = language_model.cells(bigram, context, np.full(1000, 50), 10_000)
    weights = language_model.learn(*np.unique(cell, return_counts=True), 100)
    assert weights[language_model.buckets(np.array([50]))[0], 0] > 0.9
    once = language_model.cells(np.ones(1000, int), np.full(1000, 50), np.full(1000, 50), 10_000)
    weights = language_model.learn(*np.unique(once, return_counts=True), 100)
    assert weights[language_model.buckets(np.array([50]))[0], 0] < 0.01
    assert np.allclose(weights.sum(axis=1), 1)


def test_no_training_rows(spark, nothing):
    assert language_model.scored(nothing).count() == 0
    key = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    docs = spark.createDataFrame([(key, "a b", None, None, None)], SCHEMA)
    [row] = language_model.scored(docs).collect()
    assert row["held_out"] and row["train_tokens"] == 0 and row["n_known"] == 0
    assert row["score"] == row["base_score"] == 0


def test_languages(spark, clashing, nothing):
    rows = []
    for i in range(400):
        name, parts = [("xx", ("th", "er", "on")), ("yy", ("eau", "oi", "ç")), ("zz", ("ung", "sch", "ü"))][i % 3]
        rows.append((i, invented(i, 40, parts), None if i % 11 == 0 else name, None, None))
    docs = spark.createDataFrame(rows, SCHEMA)
    found = language.languages(docs).collect()
    truth = [("xx", "yy", "zz")[r["doc_id"] % 3] for r in found]
    held = [(r["lang_pred"], t) for r, t in zip(found, truth) if r["held_out"]]
    assert len(held) > 40 and sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)
    awkward = {r["doc_id"]: r for r in language.languages(clashing).collect()}
    assert {awkward[i]["lang_pred"] for i in (4, 5, 6)} == {"und"} and awkward[4]["score"] == 0
    assert awkward[10]["lang_pred"] != "und"
    assert language.languages(nothing).count() == 0


def test_convolution_forms_agree():
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 255, (5, 256)).astype(np.uint8)
    net = language.train(windows, ["a", "b", "a", "b", "c"], epochs=1)
    assert np.allclose(net.pooled(windows)[0], net.maxima(windows), atol=1e-4)


def test_quality(spark, clashing, nothing):
    docs, labels = [], []
    for i in range(500):
        good = i % 3 > 0
        docs.append((i, invented(i, 150) if good else invented(i, 60) + " | ### " * 40, None, None, None))
        labels.append((i, int(good) if i % 17 else None))
    docs = spark.createDataFrame(docs, SCHEMA)
    labels = spark.createDataFrame(labels + labels[:5] + [(None, 1)], "doc_id long, quality int")
    held = [r for r in quality.quality(docs, labels).collect() if r["held_out"]]
    assert len(held) > 50
    assert sum((r["predicted"] == 1) == (r["doc_id"] % 3 > 0) for r in held) >= 0.95 * len(held)
    found = quality.quality(clashing, labels)
    assert found.count() == clashing.count() and found.filter("score is null").count() == 0
    assert quality.quality(nothing, labels).count() == 0
    unlabelled = quality.quality(clashing, labels.limit(0)).select("score", "predicted").distinct()
    assert [tuple(r) for r in unlabelled.collect()] == [(0.5, 1)]
