"""The prefix trie of conversations, by digests of fixed-length blocks of turns.

Conversations are cut into blocks of ``BLOCK_TURNS`` turns. A block's digest joins the digests
of its turns with their places, and the digests up to a block name everything before its
end, so conversations with equal openings fall into one group per block: copies cost one row
there, whatever their number. Where a group is the only continuation of what lies before, all
its members share every turn of the block, and its turns are nodes as they are. Only blocks
whose siblings diverge (a conversation that ends inside a block diverges too) are looked at
turn by turn, once for each different block.

Sums over subtrees need no walk along the depth. A node belongs to its least member; a
conversation owns the nodes from some depth on, its chain. A node's subtree is the rest of its
own chain and every whole chain that hangs below it, so each conversation adds the sum of its
chain to the nodes above, which it does by blocks again.

No conversation, node or group is gathered whole: places and running sums are made in ordered
ranges or segments, and the checksums of members are read in order as a stream. Digests are
128 bits; a collision among 10^12 nodes has a probability of about 10^-15.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltworks.operators.keys import dense_key
from siltworks.staging import settle

BLOCK_TURNS = 4
# Blocks or nodes of one conversation that one task puts in order.
SEGMENT = 1024
# Members of a node whose ids are joined into one text.
CHUNK = 256
WORD = r"[^\x20\x09-\x0D]+"

RESULTS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
]
_NODE = ["depth", "id1", "id2"]
_EMPTY = hashlib.sha256(b"").hexdigest()


def _zero() -> Column:
    return F.lit(0).cast("long")


def turn_digests(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv_id``, ``place`` from 1, the turn's digest ``x1``, ``x2``, and its ``words``.

    Turns are in order of ``turn``, null first; where it is equal, in order of a hash of role and
    text. A null role or text is empty. Rows without a conversation are no part of any.
    """
    said = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in (role, text)]
    turns = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.xxhash64(*said).alias("x1"),
        F.xxhash64(F.lit("second"), *reversed(said)).alias("x2"),
        F.regexp_count(said[1], F.lit(WORD)).cast("long").alias("words"),
    )
    numbered = dense_key(settle(turns, "turns"), "_n", ["conv_id", "turn"], replayable=True)
    numbered = settle(numbered, "numbered_turns")
    first = numbered.groupBy("conv_id").agg(F.min("_n").alias("_first"))
    return numbered.join(first, "conv_id").select(
        "conv_id", (F.col("_n") - F.col("_first") + 1).alias("place"), "x1", "x2", "words"
    )


def with_openings(turns: DataFrame, every: int = 20, longest: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the opening of another: their turns, and all their ids.

    Conversation c opens with the first h turns of conversation c - c % ``every``, h being the
    crc32 of c as text modulo ``longest``, and goes on with its own turns after its first h.
    An opening that is shorter or absent gives what there is, so a rebuilt conversation can
    be without turns.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("size"))
    conversations = sizes.select(
        "conv_id",
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
    )
    bases = sizes.select(F.col("conv_id").alias("base"), "size")
    known = settle(
        conversations.join(bases, "base", "left").withColumn(
            "opening", F.least("h", F.coalesce("size", _zero()))
        ),
        "openings",
    )
    own = turns.join(known.select("conv_id", "h", "opening"), "conv_id").filter("place > h")
    own = own.withColumn("place", F.col("place") - F.col("h") + F.col("opening"))
    # At most ``longest`` turns of a base, for at most 2 * ``every`` conversations.
    heads = turns.filter(F.col("place") < longest).withColumnRenamed("conv_id", "base")
    opening = heads.join(known.select("conv_id", "base", "h"), "base").filter("place <= h")
    return opening.select(turns.columns).unionByName(own.select(turns.columns)), known.select("conv_id")


def running(
    rows: DataFrame, key: str, at: str, totals: dict[str, str], exclusive_or: bool, segment: int = SEGMENT
) -> DataFrame:
    """Sums (or exclusive ors) of columns over the rows of a key before this one.

    ``totals`` names the results. Rows are ordered within segments of ``at`` // ``segment``; the
    segments before are reduced to a row each, so a key with very many rows is many tasks.
    """
    total = F.bit_xor if exclusive_or else F.sum

    def joined(a: Column, b: Column) -> Column:
        return a.bitwiseXOR(b) if exclusive_or else a + b

    def or_zero(column: Column) -> Column:
        return F.coalesce(column, _zero())

    parted = rows.withColumn("_segment", F.floor(F.col(at) / segment))
    before = Window.partitionBy(key).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    segments = (
        parted.groupBy(key, "_segment")
        .agg(*(total(name).alias(name) for name in totals.values()))
        .select(key, "_segment", *(total(name).over(before).alias(f"_{name}") for name in totals.values()))
        .filter("_segment > 0")
    )
    within = Window.partitionBy(key, "_segment").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return (
        parted.join(segments, [key, "_segment"], "left")
        .select(
            *rows.columns,
            *(
                joined(or_zero(total(name).over(within)), or_zero(F.col(f"_{name}"))).alias(result)
                for result, name in totals.items()
            ),
        )
    )


def _blocks(turns: DataFrame, block_turns: int) -> DataFrame:
    """A row per conversation and block, with the digests before it (q) and at its end (p)."""
    placed = turns.withColumns(
        {
            "y1": F.xxhash64("place", "x1", "x2"),
            "y2": F.xxhash64("x2", "x1", "place"),
            "block": F.floor((F.col("place") - 1) / block_turns),
        }
    )
    blocks = placed.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("place", "y1", "y2", "words"))).alias("turns"),
        F.bit_xor("y1").alias("d1"),
        F.bit_xor("y2").alias("d2"),
        F.max("place").alias("end"),
    )
    named = running(blocks, "conv_id", "block", {"q1": "d1", "q2": "d2"}, exclusive_or=True)
    return named.select(
        "conv_id", "block", "turns", "end", "q1", "q2",
        F.col("q1").bitwiseXOR(F.col("d1")).alias("p1"),
        F.col("q2").bitwiseXOR(F.col("d2")).alias("p2"),
    )


def _by_turn(groups: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The nodes of each group's turns, with their parents."""

    def up_to(name: str, start: str, i: Column) -> Column:
        return F.aggregate(
            F.slice("turns", 1, i + 1), F.col(start), lambda x, turn: x.bitwiseXOR(turn[name])
        )

    nodes = F.transform(
        "turns",
        lambda turn, i: F.struct(
            turn["place"].alias("depth"),
            up_to("y1", "q1", i).alias("id1"),
            up_to("y2", "q2", i).alias("id2"),
            turn["y1"].alias("y1"),
            turn["y2"].alias("y2"),
            turn["words"].alias("words"),
        ),
    )
    return groups.select(*keep, F.explode(nodes).alias("node")).select(
        *keep,
        *(f"node.{name}" for name in _NODE),
        F.col("node.id1").bitwiseXOR(F.col("node.y1")).alias("up1"),
        F.col("node.id2").bitwiseXOR(F.col("node.y2")).alias("up2"),
        "node.words",
    )


def _nodes(groups: DataFrame, conversations: DataFrame) -> DataFrame:
    """Every node with its members' number and least id, its parent's name and its last words."""
    continued = groups.groupBy("block", "q1", "q2").agg(F.count("*").alias("siblings"))
    told = _by_turn(
        groups.join(continued, ["block", "q1", "q2"]), ["siblings", "n_convs", "conv_id"]
    )
    columns = [*_NODE, "up1", "up2", "words", "n_convs", "conv_id"]
    alike = told.filter("siblings = 1").select(columns)
    refined = (
        told.filter("siblings > 1")
        .groupBy(*_NODE)
        .agg(
            *(F.first(name).alias(name) for name in ("up1", "up2", "words")),
            F.sum("n_convs").alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
        )
    )
    nothing = F.lit(None).cast("long")
    root = (
        conversations.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
        .filter("n_convs > 0")
        .select(
            *(_zero().alias(name) for name in _NODE), nothing.alias("up1"), nothing.alias("up2"),
            _zero().alias("words"), "n_convs", "conv_id",
        )
    )
    return alike.unionByName(refined.select(columns)).unionByName(root)


def _of_chains(blocks: DataFrame, groups: DataFrame, owners: DataFrame, block_turns: int) -> DataFrame:
    """What whole chains add to the nodes above them, but for the root.

    A chain's conversation shares the blocks above its first own node with others; what it adds
    is summed by block and by how much of the block lies above, then told by turn.
    """
    above = blocks.join(owners, "conv_id").filter(F.col("block") * block_turns + 1 < F.col("own"))
    added = settle(
        above.groupBy("block", "p1", "p2", F.least("end", F.col("own") - 1).alias("upto")).agg(
            F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")
        ),
        "added",
    )
    nodes = _by_turn(groups, ["block", "p1", "p2"]).select("block", "p1", "p2", *_NODE)
    return (
        nodes.join(added, ["block", "p1", "p2"])
        .filter("depth <= upto")
        .groupBy(*_NODE)
        .agg(F.sum("saved").alias("saved_below"), F.sum("leaves").alias("leaves_below"))
    )


def _ends(blocks: DataFrame, conversations: DataFrame, chunk: int) -> DataFrame:
    """The checksum of the ids of the conversations that end in a node, in ascending order.

    Ids are numbered in order of node and id and joined in pieces; a node's pieces are read
    one after the other.
    """
    last = blocks.groupBy("conv_id").agg(
        F.max(F.struct("end", "p1", "p2")).alias("last")
    )
    ends = conversations.join(last, "conv_id", "left").select(
        "conv_id",
        *(
            F.coalesce(F.col(f"last.{name}"), _zero()).alias(result)
            for result, name in zip(_NODE, ("end", "p1", "p2"))
        ),
    )
    numbered = dense_key(ends, "_n", [*_NODE, "conv_id"])
    pieces = numbered.groupBy(*_NODE, F.floor(F.col("_n") / chunk).alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )

    def read(batches):
        node, digest = None, None
        for batch in batches:
            done = []
            *names, _, ids = (column.to_pylist() for column in batch.columns)
            for own, piece in zip(zip(*names), ids):
                if own != node:
                    if digest is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = own, hashlib.sha256(piece.encode())
                else:
                    digest.update(b"," + piece.encode())
            yield _rows(done)
        if digest is not None:
            yield _rows([(*node, digest.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [[]] * 4
        kinds = [*[pa.int64()] * 3, pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=[*_NODE, "ends_sha256"]
        )

    ordered = pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "piece")
    return ordered.mapInArrow(read, "depth long, id1 long, id2 long, ends_sha256 string")


def trie(
    turns: DataFrame, conversations: DataFrame, block_turns: int = BLOCK_TURNS, chunk: int = CHUNK
) -> DataFrame:
    """The nodes of the prefix trie of conversations given as :func:`turn_digests`.

    ``conversations`` holds every ``conv_id`` once, those without turns too; they are members of
    the root alone. Returns ``RESULTS`` per node: its least member, its depth, its parent's
    least member (null for the root), the numbers of its members, of its children, and of the
    childless nodes in its subtree, the words that sharing saves in its subtree, and the
    checksum of the members that end in it. No conversations: no nodes.
    """
    conversations = settle(conversations, "conversations")
    blocks = settle(_blocks(turns, block_turns), "blocks")
    groups = settle(
        blocks.groupBy("block", "q1", "q2", "p1", "p2").agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns")
        ),
        "groups",
    )
    nodes = settle(_nodes(groups, conversations), "nodes")
    children = nodes.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("up1").alias("id1"), F.col("up2").alias("id2")
    ).agg(F.count("*").alias("n_children"))
    nodes = settle(
        nodes.join(children, _NODE, "left")
        .withColumn("n_children", F.coalesce("n_children", _zero()))
        .withColumn("own_leaves", (F.col("n_children") == 0).cast("long"))
        .withColumn("own_saved", (F.col("n_convs") - 1) * F.col("words")),
        "nodes",
    )
    owners = settle(
        nodes.groupBy("conv_id").agg(
            F.min("depth").alias("own"), F.sum("own_saved").alias("saved"), F.sum("own_leaves").alias("leaves")
        ),
        "owners",
    )
    chains = running(
        nodes, "conv_id", "depth", {"saved_before": "own_saved", "leaves_before": "own_leaves"}, exclusive_or=False
    ).join(owners, "conv_id")
    everything = owners.agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    below = _of_chains(blocks, groups, owners, block_turns)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("id1").alias("up1"), F.col("id2").alias("up2"),
        F.col("conv_id").alias("parent_conv_id"),
    )

    def in_subtree(name: str) -> Column:
        rest = F.col(name) - F.col(f"{name}_before") + F.coalesce(F.col(f"{name}_below"), _zero())
        return F.when(F.col("depth") == 0, everything.select(name).scalar()).otherwise(rest)

    return (
        chains.join(below, _NODE, "left")
        .join(_ends(blocks, conversations, chunk), _NODE, "left")
        .join(parents, ["depth", "up1", "up2"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            in_subtree("leaves").alias("n_leaves"),
            in_subtree("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )


def conversation_trie(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """The trie of conversations as they are; see :func:`turn_digests` and :func:`trie`.

    Repeated rows are turns of their own. Other columns are not read.
    """
    turns = settle(turn_digests(conversations, conv, turn, role, text), "turn_digests")
    return trie(turns, turns.select("conv_id").distinct(), block_turns)


def opened_trie(
    conversations: DataFrame, every: int = 20, longest: int = 4, block_turns: int = BLOCK_TURNS
) -> DataFrame:
    """The trie of conversations rebuilt by :func:`with_openings`."""
    turns = settle(turn_digests(conversations), "turn_digests")
    rebuilt, ids = with_openings(turns, every, longest)
    return trie(rebuilt, ids, block_turns)
