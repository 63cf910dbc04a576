from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from maskloom.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
# Extra columns under names that the operator uses itself.
TURNS = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.IntegerType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in ("node", "depth", "key", "unit", "size", "place", "conv", "part")]
)


def plain_trie(rows) -> list[tuple]:
    """Every node by comparing whole prefixes."""
    own: dict = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    # Equal turns are ordered by their digest.
    digest = lambda t: hashlib.md5(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest()
    own = {c: [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1], digest(t)))] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + turns[h:])
    nodes = {s[:d] for s in whole.values() for d in range(len(s) + 1)}
    members = {p: [c for c, s in whole.items() if s[: len(p)] == p] for p in nodes}
    children = {p: [q for q in nodes if len(q) == len(p) + 1 and q[:-1] == p] for p in nodes}
    found = []
    for p in nodes:
        below = [q for q in nodes if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in members[p] if whole[c] == p)))
        found.append(
            (
                min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), sum(not children[q] for q in below),
                sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def odd_turns() -> list[tuple]:
    draw = random.Random(4)
    rows = []
    for c in [*range(40), *range(100, 130), 207, 208, 350]:
        start = draw.randint(0, 1)
        rows += [(c, t, draw.choice(["user", "assistant"]) if t > 2 else "user", f"turn {t} {start if t < 3 else draw.randint(0, 1)} é日") for t in range(draw.randint(1, 7))]
    rows += [(c, t, "user", f"the same {t}") for c in range(500, 530) for t in range(6)]
    rows += [(600, t, "user", f"{'x' * (t % 5)}") for t in range(150)]
    rows += [(601, None, "user", "no turn"), (601, None, None, None), (601, 3, None, "tie a"), (601, 3, "user", "tie b"), (601, 3, "user", "tie b")]
    rows += [(602, 1, "us", "er"), (603, 1, "u", "ser"), (604, 0, "", ""), (605, 0, None, None), (None, 1, "user", "nobody"), (None, None, None, None)]
    rows += [(-5, 0, "user", "below zero"), (700, 0, "user", "y" * 200_000), (3, 0, "user", "turn 0 0 é日")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["z"] * 8) for r in rows], TURNS)


def listed(nodes) -> list[tuple]:
    return sorted((tuple(r[c] for c in COLUMNS) for r in nodes.collect()), key=str)


@pytest.mark.parametrize(("group", "parts"), [(1_000, 3), (4, 7), (1, 1)])
def test_all_nodes_of_odd_conversations(spark, group, parts):
    rows = odd_turns()
    assert listed(prefix_trie.conversation_trie(frame(spark, rows).repartition(parts), group)) == plain_trie(rows)


def test_no_conversations(spark):
    assert listed(prefix_trie.conversation_trie(frame(spark, []))) == []
    assert listed(prefix_trie.conversation_trie(frame(spark, [(None, 1, "user", "x")]))) == []


def test_only_a_conversation_without_turns_left(spark):
    # 8 borrows all it has turns for, and there is nobody to borrow from.
    assert zlib.crc32(b"108") % 6 >= 1
    rows = [(108, 0, "user", "gone")]
    assert listed(prefix_trie.conversation_trie(frame(spark, rows))) == plain_trie(rows) and len(plain_trie(rows)) == 1


def test_the_sql_says_the_same():
    rows = [r for r in odd_turns() if r[0] != 600]
    db = duckdb.connect()
    db.execute("create table conversations (conv_id bigint, turn int, role varchar, text varchar)")
    db.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    assert sorted(db.execute(prefix_trie.ORACLE).fetchall(), key=str) == plain_trie(rows)


def test_peel_in_blocks_of_prefixes(monkeypatch):
    """Blocks that end inside a prefix carry it over whole."""
    import pyarrow as pa

    rows = []
    for key in range(30):
        for seq in range(5):
            for depth in range(1, 2 + (seq + key) % 4):
                name = bytes([key, min(seq, depth), depth]).ljust(16, b"\1")
                rows.append((bytes([key]), key * 10 + seq, depth, name, b"p" * 16, depth, 1))
    table = pa.table({n: pa.array(c) for n, c in zip(["key", "conv", "depth", "node", "parent", "size", "copies"], zip(*rows))})

    def all_nodes(block):
        monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", block)
        found = [b.to_pylist() for b in prefix_trie._peeled(iter(table.to_batches(max_chunksize=7)))]
        return len(found), sorted((r for b in found for r in b), key=str)

    whole, small = all_nodes(10_000), all_nodes(10)
    assert whole[0] == 1 and small[0] > 5 and whole[1] == small[1]
