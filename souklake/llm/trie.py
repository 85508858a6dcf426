"""Prefix tree over conversations: which turns many of them begin with, and what sharing them saves.

A turn is known by 16 bytes of the SHA-256 of its role and text, so a conversation is a key of fixed-width
big-endian turn ids. Tasks insert the keys of their conversations into adaptive radix trees: nodes keep their
children in one of four layouts that grow with their number, and a chain without branches is one node with a
compressed path. Bytes are walked one by one, but only depths that are whole turns emit a node of the result. The
trees of the tasks are partial aggregates: their nodes are summed by a hash of their prefix, wherever they were
found, so a prefix that most conversations share reaches the sum as one row per tree.

Sums over subtrees need no walk over the tree. Every node is owned by its smallest member, and owned nodes lie at
the end of their owner's path. A node's subtree holds the owned nodes of all its members, except that its owner's
count only from its own depth on. So every owner's totals are inserted once more, under its key, and summed per
node as the members were.

A conversation's turn ids (24 bytes a turn, no texts) are one key and meet in one task. SHA-256 over the ids
of the conversations that end at a node is sequential by definition: ids are sorted in a range partitioning, packed
into chunks there, and one task streams the chunks of a node through the digest, holding one of them at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souklake.llm.common import ship, store

WIDTH = 16
# Conversations and bytes of keys that one tree takes before it is handed on, ids per chunk of a digest, and rows
# per batch of a result.
TREE_KEYS, TREE_BYTES = 50_000, 8 << 20
CHUNK_IDS = 8_192
OUT_ROWS = 20_000


class _Few:
    """Up to 4 or 16 children, by their bytes in ascending order."""

    __slots__ = ("room", "bytes", "nodes")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.nodes = room, bytearray(), []

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return None if at < 0 else self.nodes[at]

    def put(self, byte: int, node: Node) -> _Few | _Indexed:
        if len(self.nodes) == self.room:
            larger = _Few(16) if self.room == 4 else _Indexed()
            for one, child in self.items():
                larger = larger.put(one, child)
            return larger.put(byte, node)
        at = 0
        while at < len(self.bytes) and self.bytes[at] < byte:
            at += 1
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def items(self):
        return zip(self.bytes, self.nodes)


class _Indexed:
    """Up to 48 children: 256 places that tell where a byte's child is."""

    __slots__ = ("places", "nodes")

    def __init__(self):
        self.places, self.nodes = bytearray(256), []

    def get(self, byte: int):
        place = self.places[byte]
        return self.nodes[place - 1] if place else None

    def put(self, byte: int, node: Node) -> _Indexed | _Full:
        if len(self.nodes) == 48:
            larger = _Full()
            for one, child in self.items():
                larger.put(one, child)
            return larger.put(byte, node)
        self.nodes.append(node)
        self.places[byte] = len(self.nodes)
        return self

    def items(self):
        return ((byte, self.nodes[place - 1]) for byte, place in enumerate(self.places) if place)


class _Full:
    """A place for every byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> _Full:
        self.nodes[byte] = node
        return self

    def items(self):
        return ((byte, node) for byte, node in enumerate(self.nodes) if node is not None)


class Node:
    """A branch or an end: the bytes that lead to it from its parent's edge, its children, and what ends here."""

    __slots__ = ("path", "children", "ends", "n", "least", "saved", "leaves")

    def __init__(self, path: bytes):
        self.path, self.children = path, _Few()
        self.ends: list[int] | None = None
        self.n, self.least, self.saved, self.leaves = 0, None, 0, 0

    def split(self, at: int) -> None:
        """Keep the first bytes of the path; what follows becomes a child."""
        below = Node(self.path[at + 1 :])
        below.children, below.ends = self.children, self.ends
        below.n, below.least, below.saved, below.leaves = self.n, self.least, self.saved, self.leaves
        edge, self.path, self.children, self.ends = self.path[at], self.path[:at], _Few(), None
        self.n, self.least, self.saved, self.leaves = 0, None, 0, 0
        self.children = self.children.put(edge, below)

    def count(self, conv: int, saved: int, leaves: int) -> None:
        if self.ends is None:
            self.ends = []
        self.ends.append(conv)
        self.n += 1
        self.least = conv if self.least is None else min(self.least, conv)
        self.saved += saved
        self.leaves += leaves


class Tree:
    """An adaptive radix tree over keys of whole turns."""

    def __init__(self):
        self.root, self.sizes, self.keys, self.bytes = Node(b""), {}, 0, 0

    def insert(self, ids: list[bytes], sizes: list[int], conv: int, saved: int = 0, leaves: int = 0) -> None:
        key = b"".join(ids)
        self.sizes.update(zip(ids, sizes))
        self.keys += 1
        self.bytes += len(key)
        node, at = self.root, 0
        while True:
            path = node.path
            if not key.startswith(path, at):
                same = 0
                while at + same < len(key) and key[at + same] == path[same]:
                    same += 1
                node.split(same)
                at += same
            else:
                at += len(path)
            if at == len(key):
                break
            child = node.children.get(key[at])
            if child is None:
                child = Node(key[at + 1 :])
                node.children = node.children.put(key[at], child)
                node = child
                break
            node, at = child, at + 1
        node.count(conv, saved, leaves)

    def rows(self) -> Iterator[tuple]:
        """node, parent, depth, n_convs, least, size, saved, leaves, ends for every whole-turn depth."""
        order = [(self.root, -1, b"")]
        for at, (node, _, _) in enumerate(order):
            order.extend((child, at, bytes((byte,))) for byte, child in node.children.items())
        totals = [[node.n, node.least, node.saved, node.leaves] for node, _, _ in order]
        for at in range(len(order) - 1, 0, -1):
            own, above = totals[at], totals[order[at][1]]
            above[0] += own[0]
            above[1] = own[1] if above[1] is None else min(above[1], own[1])
            above[2] += own[2]
            above[3] += own[3]
        # Prefix hash and depth at the last whole turn, and the bytes since.
        state: list[tuple[bytes, int, bytes]] = []
        for at, (node, above, edge) in enumerate(order):
            if above < 0:
                prefix, depth, rest = ROOT, 0, b""
                emitted = [(ROOT, None, 0, 0)]
            else:
                prefix, depth, rest = state[above]
                rest, emitted = rest + edge + node.path, []
            used = 0
            while len(rest) - used >= WIDTH:
                turn, parent = rest[used : used + WIDTH], prefix
                prefix, depth, used = prefix_hash(parent, turn), depth + 1, used + WIDTH
                emitted.append((prefix, parent, depth, self.sizes[turn]))
            state.append((prefix, depth, rest[used:]))
            n, least, saved, leaves = totals[at]
            for k, (prefix, parent, depth, size) in enumerate(emitted):
                ends = node.ends if k + 1 == len(emitted) else None
                yield prefix, parent, depth, n, least, size, saved, leaves, ends


def prefix_hash(parent: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(parent + turn, digest_size=WIDTH).digest()


ROOT = hashlib.blake2b(b"", digest_size=WIDTH).digest()

_PARTS = pa.schema([
    ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("n_convs", pa.int64()),
    ("least", pa.int64()), ("size", pa.int64()), ("saved", pa.int64()), ("leaves", pa.int64()),
    ("ends", pa.list_(pa.int64())),
])
_PARTS_DDL = (
    "node binary, parent binary, depth long, n_convs long, least long, size long, saved long, leaves long, "
    "ends array<bigint>"
)


def _insert_all(tree_keys: int, tree_bytes: int):
    """The nodes of one tree after another, from rows (conv_id, ids, sizes, saved, leaves)."""

    def emit(tree: Tree) -> Iterator[pa.RecordBatch]:
        waiting = []
        for row in tree.rows():
            waiting.append(row)
            if len(waiting) >= OUT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), _PARTS)], schema=_PARTS)
                waiting = []
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), _PARTS)], schema=_PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree()
        for batch in batches:
            for i in range(batch.num_rows):
                conv, ids, sizes, saved, leaves = (column[i].as_py() for column in batch.columns)
                tree.insert(ids, sizes, conv, saved, leaves)
                if tree.keys >= tree_keys or tree.bytes >= tree_bytes:
                    yield from emit(tree)
                    tree = Tree()
        if tree.keys:
            yield from emit(tree)

    return run


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes that tell a turn from every other one."""
    told = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(told, 256)), 1, WIDTH)


def conversation_paths(
    rows: DataFrame, family: Column | None = None, conv_id="conv_id", turn="turn", role="role", text="text"
) -> DataFrame:
    """family, conv_id, turns: one row per conversation, its turns (id, size in bytes) in their order.

    Null turns come first; rows of one turn follow each other by their turn id (a hash), so that no text is
    shuffled; repeated rows stay. Null roles and texts are empty. Rows without a conv_id belong to no conversation
    and are left out. ``family`` tells which conversations are to meet in one task; by default each is alone.
    """
    conv, said = F.col(conv_id).cast("long"), F.coalesce(F.col(text), F.lit(""))
    turns = rows.select(
        (conv if family is None else family).alias("family"),
        conv.alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            turn_id(F.coalesce(F.col(role), F.lit("")), said).alias("id"),
            F.octet_length(said).cast("long").alias("size"),
        ).alias("turn"),
    )
    # One exchange by family serves the conversations and the families.
    grouped = turns.where("conv_id is not null").repartition("family").groupBy("family", "conv_id")
    return grouped.agg(
        F.transform(F.sort_array(F.collect_list("turn")), lambda t: t.dropFields("turn")).alias("turns")
    )


def share_heads(paths: DataFrame, base: Column, head: Column, longest: int) -> DataFrame:
    """``paths`` rebuilt: the first ``head`` turns (``longest`` at most) of the conversation ``base`` of the family,
    then the conversation's own turns after its first ``head``. An absent base gives none."""
    first = F.when(F.col("conv_id") == base, F.slice("turns", 1, longest))
    heads = F.max(first).over(Window.partitionBy("family"))
    none = F.slice("turns", 1, 0)
    rebuilt = F.concat(
        F.slice(F.coalesce(F.col("_heads"), none), F.lit(1), head), F.slice(F.col("turns"), head + 1, F.size("turns") + 1)
    )
    with_heads = paths.withColumn("_heads", heads)
    return with_heads.select("family", "conv_id", rebuilt.alias("turns"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the chunks of each node, which arrive in order."""
    node, digest = None, None
    nodes, found = [], []
    for batch in batches:
        for one, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if one == node:
                digest.update(b"," + text.encode())
                continue
            if node is not None:
                nodes.append(node)
                found.append(digest.hexdigest())
            node, digest = one, hashlib.sha256(text.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(found, pa.string())], ["node", "ends_sha256"])
        nodes, found = [], []
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one node that follow each other, joined by commas, as node, first id and text."""
    node, ids = None, []
    for batch in batches:
        out = []
        for one, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if one != node or len(ids) >= CHUNK_IDS:
                if ids:
                    out.append((node, ids[0], ",".join(map(str, ids))))
                node, ids = one, []
            ids.append(conv)
        yield _chunk_rows(out)
    if ids:
        yield _chunk_rows([(node, ids[0], ",".join(map(str, ids)))])


def _chunk_rows(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("text", pa.string())])
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def prefix_nodes(paths: DataFrame, tree_keys: int = TREE_KEYS, tree_bytes: int = TREE_BYTES) -> DataFrame:
    """One row per distinct sequence of first turns, from rows (conv_id, turns), a conversation once.

    conv_id: its smallest member; depth; parent_conv_id: its parent's smallest member (root: null); n_convs: members;
    n_children; n_leaves: childless nodes in its subtree, itself included; saved_tokens: over its subtree, the bytes
    of each node's last text times its members but one; ends_sha256: of the members that end here, ascending, joined
    by commas. The root has no text. Without conversations there are no nodes.
    """
    ship(paths.sparkSession)
    zero = F.lit(0).cast("long")
    keys = store(
        paths.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.size").alias("sizes")), "trie-keys"
    )
    grow = _insert_all(tree_keys, tree_bytes)
    parts = store(
        keys.select("*", zero.alias("saved"), zero.alias("leaves")).mapInArrow(grow, _PARTS_DDL), "trie-parts"
    )
    nodes = store(
        parts.groupBy("node").agg(
            F.min("parent").alias("parent"),
            F.min("depth").alias("depth"),
            F.sum("n_convs").alias("n_convs"),
            F.min("least").alias("least"),
            F.min("size").alias("size"),
        ),
        "trie-nodes",
    )
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    weight = F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("size")).otherwise(0)
    known = nodes.join(children, "node", "left").select(
        *nodes.columns,
        F.coalesce("n_children", zero).alias("n_children"),
        weight.alias("weight"),
        F.col("n_children").isNull().cast("long").alias("leaf"),
    )
    # Of its owner's nodes, those from here on, and those before.
    whole = Window.partitionBy("least")
    before = whole.orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    owned = store(
        known.select(
            "*",
            *(F.coalesce(F.sum(c).over(before), zero).alias(f"{c}_before") for c in ("weight", "leaf")),
            *(F.sum(c).over(whole).alias(f"{c}_total") for c in ("weight", "leaf")),
        ),
        "trie-owned",
    )
    owners = owned.groupBy(F.col("least").alias("conv_id")).agg(
        F.max("weight_total").alias("saved"), F.max("leaf_total").alias("leaves")
    )
    again = keys.join(owners.where("saved > 0 or leaves > 0"), "conv_id").select(
        "conv_id", "ids", "sizes", "saved", "leaves"
    )
    sums = again.mapInArrow(grow, _PARTS_DDL).groupBy("node").agg(
        F.sum("saved").alias("all_saved"), F.sum("leaves").alias("all_leaves")
    )
    ends = parts.where("ends is not null").select("node", F.explode("ends").alias("conv_id"))
    chunks = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        _chunks, "node binary, first long, text string"
    )
    digests = (
        store(chunks, "trie-chunks").repartition("node").sortWithinPartitions("node", "first")
        .select("node", "text").mapInArrow(_digest, "node binary, ends_sha256 string")
    )
    whole_nodes = store(
        owned.join(sums, "node", "left").join(digests, "node", "left").select(
            "node", "parent", "least", "depth", "n_convs", "n_children",
            (F.coalesce("all_leaves", zero) - F.col("leaf_before")).alias("n_leaves"),
            (F.coalesce("all_saved", zero) - F.col("weight_before")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        ),
        "trie-whole",
    )
    # Many children may share a parent: both sides come straight out of an exchange, so that a hot one is split.
    parents = nodes.select(F.col("node").alias("parent"), F.col("least").alias("parent_conv_id"))
    return whole_nodes.join(parents, "parent", "left").select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    )
