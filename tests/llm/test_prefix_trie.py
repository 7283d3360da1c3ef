"""The prefix trie against plain Python."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from siltworks.llm import prefix_trie
from tests.llm.conftest import as_multiset

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_turns(rows):
    """Turns (role, text) of each conversation in order; equal numbers must be equal turns here."""
    found = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if conv is not None:
            found.setdefault(conv, []).append((role or "", text or ""))
    return found


def plain_opened(turns):
    found = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = turns.get(conv - int(conv - 20 * int(conv / 20)), [])
        found[conv] = base[:h] + own[h:]
    return found


def plain_trie(turns):
    members = {}
    for conv, own in turns.items():
        for depth in range(len(own) + 1):
            members.setdefault(tuple(own[:depth]), []).append(conv)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)

    def saved(path):
        if not path:
            return 0
        return (len(members[path]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1]))

    leaves, sums = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[p] for p in below) or 1
        sums[path] = saved(path) + sum(sums[p] for p in below)
    found = []
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(turns[c]) == len(path))
        found.append(
            (
                min(own), len(path), min(members[path[:-1]]) if path else None, len(own),
                len(children.get(path, [])), leaves[path], sums[path], hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return found


def invented_rows(seed, conversations=60, most=11):
    """Conversations that share openings, some of them whole copies, some of one turn."""
    rng, rows, told = random.Random(seed), [], []
    for conv in range(conversations):
        own = list(rng.choice(told))[: rng.randint(0, most)] if told and rng.random() < 0.7 else []
        while len(own) < rng.randint(1, most):
            own.append((rng.choice(["user", "assistant", None]), f"{rng.choice('abc')} word\x0b{rng.choice('xy')} "))
        told.append(own)
        key = conv * 3 - 20
        rows += [(key, i * 2 if i else rng.choice([None, -1]), *turn) for i, turn in enumerate(own)]
    rng.shuffle(rows)
    return rows


AWKWARD = [
    (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (2, None, "", ""), (2, 3, "user", "a"),
    (None, 0, "user", "lost"), (3, 0, "use", "ra"), (3, 1, "", ""), (20, 5, "user", "x" * 50_000), (21, 0, None, "b b"),
    (39, 0, "user", "a"), (-7, 1, "user", "a"), (-7, 2, "user", "a"), (40, 0, "user", "a"),
]


@pytest.mark.parametrize("rows", [AWKWARD, invented_rows(1), invented_rows(2, 150, 5), invented_rows(3, 30, 25)])
def test_trie(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    frame = frame.withColumns({name: F.lit(name) for name in ("depth", "PLACE", "n_convs", "x1", "words", "_n")})
    turns = plain_turns(rows)
    for block_turns in (4, 1, 3) if rows is AWKWARD else (4,):
        found = prefix_trie.conversation_trie(frame, block_turns=block_turns)
        assert found.columns == prefix_trie.RESULTS
        assert as_multiset(found.collect()) == as_multiset(plain_trie(turns))
    found = prefix_trie.opened_trie(frame)
    assert as_multiset(found.collect()) == as_multiset(plain_trie(plain_opened(turns)))


def test_nothing(spark):
    assert prefix_trie.opened_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    lost = spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)
    assert prefix_trie.conversation_trie(lost).count() == 0


def test_long_conversation(spark, monkeypatch):
    """A conversation of many segments, and copies beyond a piece of ids."""
    monkeypatch.setattr(prefix_trie, "SEGMENT", 8)
    long = [(5, i, "user", f"turn {i // 7}") for i in range(400)]
    long += [(6, i, "user", f"turn {i // 7}" if i < 333 else "else") for i in range(350)]
    long += [(100 + c, i, "user", f"turn {i}") for c in range(40) for i in range(3)]
    frame = spark.createDataFrame(long, SCHEMA)
    turns = prefix_trie.turn_digests(frame)
    found = prefix_trie.trie(turns, turns.select("conv_id").distinct(), chunk=4)
    assert as_multiset(found.collect()) == as_multiset(plain_trie(plain_turns(long)))


def test_running(spark):
    rows = [(k, i, i * k + 1) for k in (1, 2) for i in range(50)]
    frame = spark.createDataFrame(rows, "key long, at long, value long")
    for exclusive_or in (False, True):
        found = prefix_trie.running(frame, "key", "at", {"before": "value"}, exclusive_or, segment=7)
        for key, at, _, before in found.collect():
            values = [i * key + 1 for i in range(at)]
            wanted = 0
            for value in values:
                wanted = wanted ^ value if exclusive_or else wanted + value
            assert before == wanted


def test_copies_cost_a_row_each(spark):
    """Copies fall into one group per block, and only diverging blocks are told by turn."""
    rows = [(c, i, "user", f"t{i}") for c in range(50) for i in range(8)]
    rows += [(99, i, "user", f"t{i}" if i < 6 else "else") for i in range(8)]
    turns = prefix_trie.turn_digests(spark.createDataFrame(rows, SCHEMA))
    blocks = prefix_trie._blocks(turns, 4)
    groups = blocks.groupBy("block", "q1", "q2", "p1", "p2").count().orderBy("block", "count").collect()
    assert [r["count"] for r in groups] == [51, 1, 50]
