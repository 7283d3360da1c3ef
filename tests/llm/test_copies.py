"""SimHash groups and repeated strings against brute force."""

import hashlib
import random
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siltworks.llm import repeats, simhash
from siltworks.llm.components import components
from siltworks.llm.suffixes import suffix_array
from siltworks.llm.winnow import sliding_argmin
from tests.llm.conftest import SCHEMA, as_multiset, awkward_rows, invented


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(4, len(words))
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42)
        for i in range(len(words) - size + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance):
    roots = list(range(len(prints)))

    def root(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                roots[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def test_groups(clashing, nothing):
    rows = awkward_rows()
    prints = [plain_print(row[1]) for row in rows]
    groups = plain_groups(prints, 4)
    least = {}
    for group, row in zip(groups, rows):
        ids = [x for x in (least.get(group), row[0]) if x is not None]
        least[group] = min(ids) if ids else None
    wanted = [(r[0], f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, groups)]
    found = simhash.grouped(clashing).select("doc_id", simhash.as_hex(), "component_id")
    assert as_multiset(found.collect()) == as_multiset(wanted)
    assert simhash.grouped(nothing).count() == 0
    kept = simhash.keep_first(clashing)
    assert kept.columns == clashing.columns and kept.count() == len(set(groups))


@pytest.mark.parametrize("seed", range(3))
def test_trie_links(spark, seed):
    """Chains and clusters of prints; every group is connected, whatever a slice's size."""
    rng = random.Random(seed)
    prints = {rng.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for value in list(prints):
        for _ in range(rng.randint(0, 6)):
            for _ in range(rng.randint(1, 5)):
                value ^= 1 << rng.randrange(64)
            prints.add(value)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    groups = {}
    for value, group in zip(signed, plain_groups(prints, 4)):
        groups.setdefault(group, set()).add(value)
    for hot in (simhash.HOT_SLICE, 3):
        edges = simhash.links(frame, 4, hot)
        joined = {}
        for row in components(edges).collect():
            joined.setdefault(row["root"], set()).add(row["node"])
        assert sorted(map(sorted, joined.values())) == sorted(
            sorted(g) for g in groups.values() if len(g) > 1
        )


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    roots = {row["node"]: row["root"] for row in components(edges).collect()}
    assert set(roots.values()) == {0, 500} and len(roots) == 203


def test_suffix_array():
    rng = np.random.default_rng(1)
    for _ in range(300):
        text = rng.integers(1, rng.integers(2, 5), rng.integers(1, 70))
        wanted = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert suffix_array(text).tolist() == wanted


def test_sliding_argmin():
    values = np.random.default_rng(2).integers(0, 9, 200).astype(np.uint64)
    for width in (1, 2, 7, 51, 200, 201):
        wanted = [i + int(values[i : i + width].argmin()) for i in range(201 - width)]
        assert sliding_argmin(values, width).tolist() == wanted


def test_sliding_argmin_is_quick():
    """Whole runs of values are compared, not looked up one by one at every doubling."""
    values = np.random.default_rng(3).integers(0, 1 << 40, 300_000).astype(np.uint64)

    def by_lookups():
        places, span = np.arange(len(values)), 1
        while span <= 51:
            step = min(span, 51 - span)
            left, right = places[: len(places) - step], places[step:]
            places, span = np.where(values[right] < values[left], right, left), 2 * span
        return places

    def seconds(work):
        start = time.perf_counter()
        work()
        return time.perf_counter() - start

    assert sliding_argmin(values, 51).tolist() == by_lookups().tolist()
    quick = min(seconds(lambda: sliding_argmin(values, 51)) for _ in range(7))
    assert quick < 0.6 * min(seconds(by_lookups) for _ in range(7))


def plain_repeats(rows, window):
    """Rows in the order of their ids; rows with equal ids are equal here."""
    seen, found = set(), []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    for i in order:
        data = (rows[i][1] or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - window + 1):
            part = data[at : at + window]
            if part in seen:
                gone[at : at + window] = True
            seen.add(part)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        found.append((rows[i][0], len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return found


def repeated_rows():
    passage, rows = invented(9, 40), []
    for i in range(30):
        at = 40 * (i % 3)
        rows.append((i, invented(20 + i, 25) + passage[at : at + 101 + i] + invented(60 + i, 20), None, None, None))
    rows += [(40, "a" * 1000, None, None, None), (41, "ab" * 300, None, None, None), (42, rows[3][1], None, None, None)]
    return rows + [r for r in awkward_rows() if r[0] not in {None, *range(43)}] + [
        (None, invented(1, 100), None, None, None), (7, rows[7][1], None, None, None),
    ]


@pytest.mark.parametrize("hot", [repeats.HOT_ANCHOR, 1])
@pytest.mark.parametrize("small", [False, True])
def test_repeats(spark, hot, small, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 700)
    rows = repeated_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    docs = docs.withColumns({name: F.lit(name) for name in ("N_BYTES", "spans", "block", "keys", "_key", "part")})
    options = {"block_bytes": 3000, "range_bytes": 2000, "sort_bytes": 1000} if small else {}
    found = repeats.repeated_spans(docs, hot_anchor=hot, **options).drop("spans")
    assert as_multiset(found.collect()) == as_multiset(plain_repeats(rows, 100))


def test_hot_passage(spark, monkeypatch):
    """Windows of an anchor with very many surroundings are dealt out one by one."""
    passage = invented(9, 30)
    rows = [(i, f"{i * 7919} {invented(1000 + i, 6)} {passage} {invented(5000 + i, 6)}", None, None, None) for i in range(1500)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    sizes = spark.sparkContext.accumulator(0)
    plain = repeats._sorted

    def noted(window):
        sort = plain(window)

        def counted(table):
            sizes.add(sum(len(repeats.unpack_bytes(x)) for x in table["texts"].to_pylist()))
            return sort(table)

        return counted

    monkeypatch.setattr(repeats, "_sorted", noted)
    found = repeats.repeated_spans(docs, hot_anchor=50, block_bytes=20_000).drop("spans")
    assert as_multiset(found.collect()) == as_multiset(plain_repeats(rows, 100))
    # Only anchors with few surroundings are left to the sort.
    assert sizes.value < sum(len(row[1]) for row in rows) / 4


def test_pieces_of_a_long_text(spark):
    """A text read in pieces has the anchors of the whole."""
    from siltworks.llm.winnow import Anchors

    text = (invented(1, 200) + invented(2, 100) + invented(1, 150)).encode()
    whole = Anchors(text, 100, 0, len(text))
    windows = {}
    for low in range(0, len(text), 37):
        part = Anchors(text, 100, low, low + 37)
        for h, x, p, f, n in zip(part.hashes, part.contexts, part.places, part.first, part.count):
            for w in range(f, f + n):
                windows[w] = (h, x, p)
    wanted = {}
    for h, x, p, f, n in zip(whole.hashes, whole.contexts, whole.places, whole.first, whole.count):
        for w in range(f, f + n):
            wanted[w] = (h, x, p)
    assert windows == wanted and len(windows) == len(text) - 99


def test_no_documents(nothing):
    assert repeats.repeated_spans(nothing).count() == 0
