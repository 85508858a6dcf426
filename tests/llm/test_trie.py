from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from souklake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """The contract's conversations in a plain loop."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            told = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, told, role, text))
    turns = {c: [(t[3], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + ts[h:]
    return out


def plain(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        childless = [b for b in below if not any(len(m) == len(b) + 1 and m[: len(b)] == b for m in below)]
        saved = sum((len(members[b]) - 1) * len(b[-1][1].encode()) for b in below if b)
        ends = ",".join(str(c) for c in sorted(convs) if len(conversations[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(m) == len(node) + 1 for m in below), len(childless), saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(spark, rows, **limits):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    conv = F.col("conv_id")
    head = (F.crc32(conv.cast("string").cast("binary")) % 9).cast("int")
    paths = trie.share_heads(trie.conversation_paths(df, family=conv - conv % 5), F.col("family"), head, 8)
    return sorted((tuple(r) for r in trie.prefix_nodes(paths, **limits).collect()), key=str)


def log(seed, n=60, longest=7, choices=2):
    rng = random.Random(seed)
    rows = []
    for c in range(0, 3 * n, 3) if seed % 2 else range(n):
        for t in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", None])
            text = rng.choice(["é" * k for k in range(choices)] + [None])
            rows.append((c, rng.choice([t, t, None]), role, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("limits", [{}, {"tree_keys": 3}])
def test_equal_to_a_plain_loop(spark, seed, limits):
    """Null turns, roles and texts, ties and repeated rows included."""
    rows = log(seed) + [(None, 0, "user", "nobody")]
    rows += rows[:5]
    assert found(spark, rows, **limits) == plain(rebuilt(rows))


def test_many_equal_conversations_and_a_very_long_one(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 16)
    rows = [(5 * c, t, "user", f"same {t}") for c in range(150) for t in range(3)]
    rows += [(1000, t, "user", "same 0" if t == 0 else "x" * (t % 50)) for t in range(400)]
    rows += [(1005, 0, "user", "y" * 300_000)]
    assert found(spark, rows, tree_keys=20) == plain(rebuilt(rows))


def test_no_conversations_no_nodes(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "a")]) == []


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "a") for c in range(1, 40) if c % 5]
    want = plain(rebuilt(rows))
    assert found(spark, rows) == want and any(r[1] == 0 and r[3] > 10 for r in want)


def test_extra_columns_with_working_names_are_ignored(spark):
    df = spark.createDataFrame(
        [(5, 0, "user", "a", 1, 2), (10, 0, "user", "a", 3, 4)], SCHEMA + ", turns long, family long"
    )
    nodes = trie.prefix_nodes(trie.conversation_paths(df)).collect()
    assert sorted((r["depth"], r["n_convs"], r["saved_tokens"]) for r in nodes) == [(0, 2, 1), (1, 2, 1)]


def test_node_layouts_grow_and_paths_split():
    tree, rng = trie.Tree(), random.Random(3)
    ids = [bytes([b]) + rng.randbytes(trie.WIDTH - 1) for b in range(256)]
    shared = rng.randbytes(trie.WIDTH - 1)
    keys = [[one] for one in ids] + [[ids[0], shared + bytes([b])] for b in range(20)] + [[ids[0]], []]
    kinds = set()
    for conv, key in enumerate(keys):
        tree.insert(key, [1] * len(key), conv)
        kinds.add((type(tree.root.children).__name__, getattr(tree.root.children, "room", 0)))
    assert kinds == {("_Few", 4), ("_Few", 16), ("_Indexed", 0), ("_Full", 0)}
    rows = {(r[2], r[0]): r for r in tree.rows()}
    assert len(rows) == 1 + 256 + 20
    root = rows[0, trie.ROOT]
    assert root[3] == len(keys) and root[8] == [len(keys) - 1]
    first = rows[1, trie.prefix_hash(trie.ROOT, ids[0])]
    assert first[3] == 22 and first[8] == [0, 276]
    assert sum(r[3] for (depth, _), r in rows.items() if depth == 2) == 20
