"""A trie of conversation prefixes from vertical bitmaps.

A node is a distinct sequence of first turns; its members are the conversations
that begin with it. Conversations are dealt to shards. Each shard indexes
(position, turn) to a bitset of its conversations and walks depth first: a
node's bitset, intersected with the postings of the next position, gives its
children, popcounts give their members, and the conversations that end at a
node are its end list.

Nodes of several shards are merged by a digest of their path. Most nodes
are in one shard only, together with their whole subtree, and are finished
there. What several shards share is the top of the trie; its sums are gathered by
doubling the distance to an ancestor each round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobweave.llm.common import flush_every, map_batches, stage
from jobweave.session import ship_package

# Rows of turns that a shard gets on average: its postings stay within some 50 MB.
SHARD_TURNS = 12_000
SALTS = 16
ROOT = bytes(16)

_NODE = pa.schema(
    [("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64())]
    + [("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64())]
    + [("size", pa.int64()), ("saved", pa.int64()), ("ends", pa.list_(pa.int64())), ("ups", pa.list_(pa.binary()))]
)
_NODE_DDL = (
    "node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, size long, saved long, ends array<long>, ups array<binary>"
)

Turn = tuple[bytes, int]  # digest of role and text, bytes of the text


def turn_digest(role: Column, text: Column) -> Column:
    """32 bytes that stand for a pair of role and text."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def borrowed(conv_id: Column) -> Column:
    """How many turns a rebuilt conversation takes from the first of its five: 0 to 8."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 9


def shard_nodes(convs: list[tuple[int, list[Turn]]]) -> Iterator[tuple]:
    """A row of ``_NODE`` for every node of the conversations (id, turns) of one shard, ids ascending.

    Sums over subtrees are those of this shard; ``ups`` are the ancestors 1, 2, 4 and so on steps up. A node's children are found one
    intersection each: the lowest conversation that no child holds yet names the
    turn whose posting the node's bitset meets next.
    """
    postings: dict[tuple[int, bytes], int] = {}
    ending: dict[int, int] = {}
    for i, (_, turns) in enumerate(convs):
        for position, (digest, _) in enumerate(turns):
            key = position, digest
            postings[key] = postings.get(key, 0) | 1 << i
        ending[len(turns)] = ending.get(len(turns), 0) | 1 << i
    if not convs:
        return

    def lowest(bits: int) -> int:
        return (bits & -bits).bit_length() - 1

    def ids(bits: int) -> list[int]:
        found = []
        while bits:
            found.append(convs[lowest(bits)][0])
            bits &= bits - 1
        return found

    def children(path: bytes, depth: int, live: int) -> Iterator[tuple[bytes, int, int]]:
        while live:
            digest, size = convs[lowest(live)][1][depth]
            bits = live & postings[depth, digest]
            live ^= bits
            yield hashlib.sha256(path + digest).digest()[:16], size, bits

    def opened(path: bytes, parent: bytes, parent_conv: int | None, depth: int, size: int, bits: int) -> dict:
        ends = bits & ending.get(depth, 0)
        first, n = convs[lowest(bits)][0], bits.bit_count()
        node = {"row": [path, parent, depth, first, parent_conv, n], "size": size, "ends": ends}
        return node | {"next": children(path, depth, bits & ~ends), "children": 0, "leaves": 0, "saved": (n - 1) * size}

    stack = [opened(ROOT, None, None, 0, 0, (1 << len(convs)) - 1)]
    while stack:
        top = stack[-1]
        path, _, depth, first, _, _ = top["row"]
        if (child := next(top["next"], None)) is not None:
            top["children"] += 1
            stack.append(opened(child[0], path, first, depth + 1, child[1], child[2]))
            continue
        stack.pop()
        leaves = top["leaves"] or 1
        if stack:
            stack[-1]["leaves"] += leaves
            stack[-1]["saved"] += top["saved"]
        ups = [stack[-step]["row"][0] for step in (1 << k for k in range(len(stack).bit_length()))]
        yield (*top["row"], top["children"], leaves, top["size"], top["saved"], ids(top["ends"]), ups)


def numbered_turns(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, position, digest, size): the turns of every conversation in order, counted from 1.

    Null turns come first, equal turns by their digest. Null roles and texts are
    empty. Rows without a conversation id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    turns = df.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        turn_digest(role, text).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return turns.select("conv_id", F.row_number().over(order).alias("position"), "digest", "size")


def borrow_turns(turns: DataFrame, group: int = 5) -> DataFrame:
    """Numbered turns with the first turns of every conversation c taken from conversation ``c - c % group``.

    As many as ``borrowed`` says are taken, all if there are fewer, and the same
    number of own turns goes. A conversation left without turns has one row
    whose position is null.
    """
    turns = stage(turns, "trie-turns")
    wanted = borrowed(F.col("conv_id"))
    ids = turns.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), wanted.alias("n"))
    # At most eight turns of a conversation go to at most ``2 * group - 1`` others.
    taken = ids.join(turns.filter("position <= 8").withColumnRenamed("conv_id", "base"), "base").filter("position <= n")
    first = taken.select("conv_id", F.lit(0).alias("own"), "position", "digest", "size")
    rest = turns.filter(F.col("position") > wanted).select("conv_id", F.lit(1).alias("own"), "position", "digest", "size")
    none = ids.select("conv_id", F.lit(2).alias("own"), *(F.lit(None).alias(c) for c in ("position", "digest", "size")))
    # A marker row keeps conversations without turns; it goes where there are turns.
    order = Window.partitionBy("conv_id").orderBy("own", "position")
    held = first.union(rest).union(none).select("*", F.row_number().over(order).alias("at"))
    return held.filter("own < 2 or at = 1").select("conv_id", F.when(F.col("own") < 2, F.col("at")).alias("position"), "digest", "size")


def trie_nodes(turns: DataFrame, near: Column | None = None, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of every shard, a row per node and shard (see ``_NODE``).

    ``turns`` has (conv_id, position, digest, size). Conversations with equal
    ``near``, the id itself by default, share a shard, which makes more nodes
    private to it; only a bounded number of them should be equal. A shard holds
    whole conversations, so its memory is bounded by ``shard_turns`` and the longest.
    """
    near = F.col("conv_id") if near is None else near
    turns = stage(turns, "trie-input")
    shards = max(1, -(-turns.count() // shard_turns))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("conv_id", "ascending"), ("position", "ascending")])
        convs: list[tuple[int, list[Turn]]] = []
        for conv, position, digest, size in zip(*(table[c].to_pylist() for c in ("conv_id", "position", "digest", "size"))):
            if not convs or convs[-1][0] != conv:
                convs.append((conv, []))
            if position is not None:
                convs[-1][1].append((digest, size))
        return pa.Table.from_batches(flush_every(5_000, _NODE)(shard_nodes(convs)), _NODE)

    ship_package(turns.sparkSession)
    dealt = turns.withColumn("shard", F.pmod(F.xxhash64(near), F.lit(shards)).cast("int"))
    return stage(dealt.groupBy("shard").applyInArrow(run, _NODE_DDL), "trie-nodes")


def _digest_of_ends(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): the ids in ascending order with commas between.

    Ids are sorted by ranges of (node, id), so an end list of any length is joined
    to long strings by many tasks; what hashes a list reads those strings one at a time.
    """
    piece = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("piece", pa.string())])
    done = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held_node, held = None, []
            for batch in batches:
                for node, conv in zip(batch["node"].to_pylist(), batch["conv_id"].to_pylist()):
                    if held and (node != held_node or len(held) >= 4096):
                        yield held_node, held[0], ",".join(map(str, held))
                        held = []
                    held_node = node
                    held.append(conv)
            if held:
                yield held_node, held[0], ",".join(map(str, held))

        yield from flush_every(200, piece)(rows())

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held_node, state = None, None
            for batch in batches:
                for node, text in zip(batch["node"].to_pylist(), batch["piece"].to_pylist()):
                    if node != held_node:
                        if state:
                            yield held_node, state.hexdigest()
                        held_node, state = node, hashlib.sha256()
                    else:
                        state.update(b",")
                    state.update(text.encode())
            if state:
                yield held_node, state.hexdigest()

        yield from flush_every(1_000, done)(rows())

    ranged = stage(ends, "trie-ends").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    joined = map_batches(ranged, pieces, "node binary, first long, piece string")
    return map_batches(joined.repartition("node").sortWithinPartitions("node", "first"), hashed, "node binary, ends_sha256 string")


def _joined_ids(ends: Column) -> Column:
    return F.array_join(F.transform(ends, lambda c: c.cast("string")), ",")


def _merged(rows: DataFrame) -> DataFrame:
    """One row per node that several shards have, with sums over its whole subtree.

    What the shards count below a node is right for children of one shard only.
    So the shards' sums of its shared children are taken off, which leaves the
    private ones, and the true values of shared nodes are summed upwards.
    """
    own = (F.col("n_convs") - 1) * F.col("size")
    no_child = (F.col("n_children") == 0).cast("long")
    sums = rows.groupBy("node").agg(
        *[F.min(c).alias(c) for c in ("parent", "depth", "conv_id", "size", "ups")],
        F.sum("n_convs").alias("n_convs"),
        F.count("*").alias("shards"),
        F.sum("n_children").alias("kids"),
        F.sum(F.col("n_leaves") - no_child).alias("kid_leaves"),
        F.sum(F.col("saved") - own).alias("kid_saved"),
        F.sum("n_leaves").alias("all_leaves"),
        F.sum("saved").alias("all_saved"),
    )
    sums = stage(sums, "trie-shared")
    below = sums.groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("shared_kids"),
        *[F.sum(c).alias(f"less_{c}") for c in ("shards", "all_leaves", "all_saved")],
    )
    less = lambda c: F.coalesce(f"less_{c}", F.lit(0))
    n_children = F.col("kids") - less("shards") + F.coalesce("shared_kids", F.lit(0))
    state = sums.join(below, "node", "left").withColumn("n_children", n_children).select(
        *["node", "parent", "depth", "conv_id", "n_convs", "n_children", "ups"],
        (F.col("kid_leaves") - less("all_leaves") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        (F.col("kid_saved") - less("all_saved") + own).alias("saved"),
    )
    state = stage(state, "trie-sums")
    deepest = state.agg(F.max("depth")).first()[0] or 0
    for k in range(deepest.bit_length()):
        # Sums over fewer than 2^k steps become sums over fewer than 2^(k+1).
        up = state.filter(F.size("ups") > k).select(F.get("ups", F.lit(k)).alias("node"), "n_leaves", "saved")
        more = up.groupBy("node").agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        state = state.join(more, "node", "left").withColumns({
            "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
            "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0)),
        }).drop("more_leaves", "more_saved")
        state = stage(state, f"trie-sums-{k}")
    return state.drop("ups")


def prefix_trie(turns: DataFrame, near: Column | None = None, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie over ``turns`` (conv_id, position, digest, size).

    Columns: conv_id (smallest member), depth, parent_conv_id (the parent's
    conv_id), n_convs, n_children, n_leaves, saved_tokens (over the subtree, each
    node's (n_convs - 1) times the size of its last turn) and ends_sha256 (of the
    ids that end at the node). A conversation without turns, a row with a null
    position, ends at the root. Without conversations there are no nodes.
    """
    nodes = trie_nodes(turns, near, shard_turns)
    several = stage(nodes.groupBy("node").count().filter("count > 1").select("node"), "trie-several")
    rows = nodes.join(several, "node", "left_semi")
    shared = _merged(rows)
    ends = _digest_of_ends(rows.select("node", F.explode("ends").alias("conv_id")))
    shared = shared.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    shared = stage(shared.withColumn("parent_conv_id", F.lit(None).cast("long")), "trie-merged")

    columns = ["parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    private = nodes.join(several, "node", "left_anti").withColumn("ends_sha256", F.sha2(_joined_ids(F.col("ends")), 256))
    # A shard knows a private parent's smallest member; a shared parent's comes by a join, salted as the root has many children.
    salted = private.select(columns).union(shared.select(columns)).withColumn("salt", F.pmod("conv_id", F.lit(SALTS)))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    parents = shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("shared_conv"), salts)
    return salted.join(parents, ["parent", "salt"], "left").select(
        "conv_id",
        "depth",
        F.coalesce("shared_conv", "parent_conv_id").alias("parent_conv_id"),
        *["n_convs", "n_children", "n_leaves"],
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )
