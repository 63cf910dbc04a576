"""Conversation prefix trie by truncation peeling.

A conversation is a sequence of turns, a node a distinct sequence of first turns. The peel starts at the deepest
nodes: conversations that end at a depth join the nodes that survived from below, equal sequences become one node,
its last turn is stripped, and what is left is regrouped one level up. Counts, leaves and saved tokens are summed on
the way, so a node is complete when it is found.

Turns travel as digests with lengths, never as texts. Copies of a conversation are one sequence with a count. Sequences
that share a prefix are peeled together in one task as far as at most ``GROUP`` of them do; above such
prefixes the peel goes on level by level as grouped tables, so no task holds a common beginning's conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskloom.llm.tables import map_batches, stored

#: Fixed values of the rebuilding rule: conversations that borrow from one, and the borrowed turns' modulus.
FAMILY, BORROWED = 100, 6
#: Different sequences under one prefix that a task peels by itself.
GROUP = 1_000
#: Rows that a task peels at a time; a prefix's rows stay together.
BLOCK_ROWS = 100_000
ROOT = bytes(16)
EMPTY_HASH = hashlib.sha256(b"").hexdigest()
NODE = "node binary, parent binary, conv_id bigint, depth bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"


def turns_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, place, unit, size): the turns in order, each as a digest of role and text and the text's code points.

    Turns are ordered by ``turn``, nulls first, and equal ones by their digest. Null role or text is empty; rows
    without a conversation are left out; repeated rows are turns of their own.
    """
    said, body = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    unit = F.unhex(F.md5(F.concat(F.char_length(said).cast("string"), F.lit(":"), said, body)))
    rows = conversations.where(F.col(conv).isNotNull()).select(F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"), unit.alias("unit"), F.char_length(body).cast("bigint").alias("size"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "unit")
    return rows.withColumn("place", F.row_number().over(order)).drop("turn")


def borrowed(conv: Column) -> Column:
    return F.crc32(conv.cast("string")) % BORROWED


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, part, place, unit, size): the first turns of the family's first conversation, then a conversation's own.

    Every conversation also has one row of part -1, which stands for its beginning.
    """
    convs = turns.where("place = 1").select("conv", borrowed(F.col("conv")).alias("h"))
    start = convs.select("conv", F.lit(-1).alias("part"), F.lit(0).alias("place"), F.lit(ROOT).alias("unit"), F.lit(0).cast("bigint").alias("size"))
    heads = turns.where((F.col("conv") % FAMILY == 0) & (F.col("place") < BORROWED)).withColumnRenamed("conv", "first")
    lent = convs.withColumn("first", F.col("conv") - F.col("conv") % FAMILY).join(heads, "first").where("place <= h").select("conv", F.lit(0).alias("part"), "place", "unit", "size")
    own = turns.where(F.col("place") > borrowed(F.col("conv"))).select("conv", F.lit(1).alias("part"), "place", "unit", "size")
    return start.unionByName(lent).unionByName(own)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place become (conv, depth, node, parent, size, last)."""
    held: tuple | None = None
    for batch in batches:
        out = []
        for conv, unit, size in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or held[0] != conv:
                new = (conv, 0, ROOT, None, 0)
            else:
                new = (conv, held[1] + 1, hashlib.blake2b(held[2] + unit, digest_size=16).digest(), held[2], size)
            if held is not None:
                out.append((*held, held[0] != conv))
            held = new
        if out:
            yield _path_batch(out)
    if held is not None:
        yield _path_batch([(*held, True)])


def _path_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["conv", "depth", "node", "parent", "size", "last"])


def _paths(sequences: DataFrame) -> DataFrame:
    """One row per conversation and depth, the root included."""
    # Of a hash: a union whose parts are partitioned by the plain column may be taken as partitioned by it, which fails
    # where the parts' partitions have been coalesced apart.
    ordered = sequences.repartition(F.xxhash64("conv")).sortWithinPartitions("conv", "part", "place").select("conv", "unit", "size")
    return map_batches(ordered, _chained, "conv bigint, depth bigint, node binary, parent binary, size bigint, last boolean")


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, SHA-256 of its ids) of rows sorted by node and id; ids pass by one at a time."""

    def made(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())], ["node", "ends_sha256"])

    node, running = None, None
    for batch in batches:
        found = []
        for at, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if at != node:
                if running is not None:
                    found.append((node, running.hexdigest()))
                node, running = at, hashlib.sha256(str(conv).encode())
            else:
                running.update(b",%d" % conv)
        if found:
            yield made(found)
    if running is not None:
        yield made([(node, running.hexdigest())])


def peel(conv: np.ndarray, depth: np.ndarray, node: np.ndarray, size: np.ndarray, copies: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """All nodes of some sequences from the deepest up, and which row of the input shows each.

    Rows are sorted by sequence and depth, from any one depth of the sequence's to its last; ``node`` are numbers of
    prefixes, ``conv`` the smallest conversation of a sequence, ``copies`` how many it has. Returns the arrays of the nodes:
    conv_id, n_convs, n_children, n_leaves, saved_tokens, and ``parent_at``, the number of the parent in the
    result (-1: above the rows).
    """
    starts = np.flatnonzero(np.append(True, conv[1:] != conv[:-1])) if len(conv) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(conv)) - 1 if len(conv) else starts
    by_end = np.argsort(-depth[ends], kind="stable")
    found = {k: [] for k in ("row", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "parent_at")}
    total, entered = 0, 0
    row = low = n = saved = leaves = own = np.zeros(0, np.int64)  # the survivors, by a row of theirs
    level = int(depth[ends].max()) if len(conv) else 0
    bottom = int(depth[starts].min()) if len(conv) else 1
    while level >= bottom:
        new = entered
        while new < len(by_end) and depth[ends[by_end[new]]] == level:
            new += 1
        fresh = ends[by_end[entered:new]]
        entered = new
        rows, zero = np.concatenate([row, fresh]), np.zeros(len(fresh), np.int64)
        if len(rows):
            _, first, at = np.unique(node[rows], return_index=True, return_inverse=True)
            k = len(first)
            lowest = np.full(k, np.iinfo(np.int64).max)
            np.minimum.at(lowest, at, np.concatenate([low, conv[fresh]]))

            def summed(values: np.ndarray) -> np.ndarray:
                result = np.zeros(k, np.int64)
                np.add.at(result, at, values)
                return result

            n, children = summed(np.concatenate([n, copies[fresh]])), summed(np.concatenate([np.ones(len(row), np.int64), zero]))
            saved, leaves = summed(np.concatenate([saved, zero])), summed(np.concatenate([leaves, zero]))
            row, low = rows[first], lowest
            # Strip the last turn: the row before shows the parent, unless the rows begin here. Such tops come first.
            top = np.isin(row, starts)
            order = np.argsort(~top, kind="stable")
            place = np.empty(k, np.int64)
            place[order] = np.arange(k)
            found["parent_at"] += [total + place[at[: len(own)]], np.full(int(top.sum()), -1)]
            leaves += children == 0
            saved += (n - 1) * size[row]
            for name, values in (("row", row), ("conv_id", low), ("n_convs", n), ("n_children", children), ("n_leaves", leaves), ("saved_tokens", saved)):
                found[name].append(values[order])
            keep = ~top
            total += k
            row, low, n, saved, leaves = row[keep] - 1, low[keep], n[keep], saved[keep], leaves[keep]
            own = row
        level -= 1
    joined = {k: np.concatenate([np.zeros(0, np.int64), *v]) for k, v in found.items()}
    return joined, joined.pop("row")


def _numbered(values: pa.Array) -> np.ndarray:
    """A number for each 16-byte value, equal for equal ones."""
    raw = np.frombuffer(b"".join(values.to_pylist()), np.dtype([("a", "<u8"), ("b", "<u8")]))
    return np.unique(raw, return_inverse=True)[1]


def _peeled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole prefixes; rows come sorted by (key, conv, depth)."""

    def nodes(rows: pa.Table) -> pa.RecordBatch:
        ids = rows.column("node").combine_chunks()
        numbers = [rows.column(c).to_numpy() for c in ("conv", "depth", "size", "copies")]
        found, at = peel(numbers[0], numbers[1], _numbered(ids), numbers[2], numbers[3])
        up = found["parent_at"]
        parent_conv = pa.array(found["conv_id"][np.maximum(up, 0)], mask=up < 0)
        taken = rows.take(pa.array(at))
        return pa.RecordBatch.from_arrays(
            [taken.column("node").combine_chunks(), taken.column("parent").combine_chunks(), pa.array(found["conv_id"]), taken.column("depth").combine_chunks(), *(pa.array(found[c]) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), parent_conv],
            ["node", "parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "parent_conv_id"],
        )

    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += len(batch)
        if count < BLOCK_ROWS:
            continue
        rows = pa.Table.from_batches(held)
        keys = rows.column("key").combine_chunks()
        whole = pa.compute.index(keys, keys[-1]).as_py()  # where the last prefix begins: it may go on
        if whole:
            yield nodes(rows.slice(0, whole))
        held = rows.slice(whole).combine_chunks().to_batches()
        count = len(rows) - whole
    if held:
        yield nodes(pa.Table.from_batches(held))


def _dealt(paths: DataFrame, sequences: DataFrame, group: int) -> tuple[DataFrame, int]:
    """((conv, key, top), levels): for each sequence the first depth at which at most ``group`` different ones share its prefix.

    Sequences that end above such a depth have no row. ``levels`` is the deepest depth that is above some prefix.
    """
    done, left, top = None, sequences.select("conv"), 1
    while True:
        at = paths.where(F.col("depth") == top).join(left, "conv").select("conv", F.col("node").alias("key"))
        at = stored(at, "trie-keys")
        hot = at.groupBy("key").count().where(F.col("count") > group).select("key")
        hot = stored(hot, "trie-hot")
        some = hot.limit(1).count() > 0
        small = (at.join(hot, "key", "left_anti") if some else at).select("conv", "key", F.lit(top).cast("bigint").alias("top"))
        done = small if done is None else done.unionByName(small)
        if not some:
            return done, top - 1
        left, top = at.join(hot, "key", "left_semi").select("conv"), top + 1


def trie(sequences: DataFrame, group: int = GROUP) -> DataFrame:
    """Every node of the trie of rebuilt sequences (columns conv, part, place, unit, size).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves`` and ``saved_tokens`` (over the subtree), ``ends_sha256`` (of the ids that end there), and ``node``,
    the node's own 128-bit name. Without conversations there is no node, not even the root.
    """
    paths = stored(_paths(sequences), "trie-paths")
    ended = paths.where("last").select("conv", "node", "depth")
    hashes = map_batches(ended.select("node", "conv").repartition("node").sortWithinPartitions("node", "conv"), _end_hashes, "node binary, ends_sha256 string")
    whole = stored(ended.groupBy("node", "depth").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("copies")), "trie-ends")
    ways = stored(paths.join(whole.select("conv", "copies"), "conv").select("conv", "depth", "node", "parent", "size", "copies"), "trie-ways")
    dealt, levels = _dealt(ways, whole, group)
    rows = ways.join(dealt, "conv").where("depth >= top").select("key", "conv", "depth", "node", "parent", "size", "copies")
    rows = rows.repartition("key").sortWithinPartitions("key", "conv", "depth")
    inside = stored(map_batches(rows, _peeled, NODE + ", parent_conv_id bigint"), "trie-nodes")
    finished = [inside.where("parent_conv_id is not null")]
    waiting = inside.where("parent_conv_id is null")  # tops of prefixes, of any depth up to levels + 1
    for depth in range(levels, -1, -1):
        below = waiting.where(F.col("depth") == depth + 1)
        child = below.select(F.col("parent").alias("node"), "conv_id", "n_convs", F.lit(1).cast("bigint").alias("n_children"), "n_leaves", "saved_tokens")
        zero = F.lit(0).cast("bigint")
        new = whole.where(F.col("depth") == depth).select("node", F.col("conv").alias("conv_id"), F.col("copies").alias("n_convs"), zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"))
        if depth:
            # An end at this depth may also lie in a prefix that a task has peeled.
            new = new.join(dealt.where(F.col("top") <= depth).select(F.col("conv").alias("conv_id")), "conv_id", "left_anti")
        shown = ways.where(F.col("depth") == depth).groupBy("node").agg(F.first("parent").alias("parent"), F.first("size").alias("size"))
        sums = child.unionByName(new).groupBy("node").agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
        level = stored(
            sums.join(shown, "node").select(
                "node", "parent", "conv_id", F.lit(depth).cast("bigint").alias("depth"), "n_convs", "n_children",
                (F.col("n_leaves") + (F.col("n_children") == 0).cast("bigint")).alias("n_leaves"), (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
            ),
            "trie-level",
        )
        named = level.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv"))
        finished.append(below.join(named, "parent").withColumn("parent_conv_id", F.col("parent_conv")).drop("parent_conv"))
        waiting = waiting.where(F.col("depth") <= depth).unionByName(level.withColumn("parent_conv_id", F.lit(None).cast("bigint")))
    finished.append(waiting.where("depth = 0"))
    nodes = finished[0]
    for part in finished[1:]:
        nodes = nodes.unionByName(part)
    return nodes.join(hashes, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_HASH)).alias("ends_sha256"), "node"
    )


def conversation_trie(conversations: DataFrame, group: int = GROUP) -> DataFrame:
    """The trie of all conversations after rebuilding. See :func:`turns_of` for odd rows; other columns are not read."""
    return trie(rebuilt(turns_of(conversations)), group)


#: The same in SQL: prefixes are lists, and every node is compared with the nodes that begin with it.
ORACLE = """
with given as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
), own as (
    select conv_id as c, list({'role': role, 'text': text} order by turn nulls first, md5(length(role) || ':' || role || text)) as turns from given group by 1
), hashed as (
    select c, turns, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)),
        lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, k: case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end))) % 6 as h from own
), rebuilt as (
    select x.c, list_concat(coalesce(y.turns[1:x.h], []), x.turns[x.h + 1:]) as turns from hashed x left join own y on y.c = x.c - x.c % 100
), members as (
    select c, len(turns) as whole, unnest(range(len(turns) + 1)) as depth, turns from rebuilt
), prefixes as (
    select c, whole, depth, turns[1:depth] as prefix from members
), nodes as (
    select depth, prefix, min(c) as conv_id, count(*) as n_convs, string_agg(c::varchar, ',' order by c) filter (whole = depth) as ends,
        coalesce(length(any_value(prefix[depth].text)), 0) as size from prefixes group by 1, 2
), children as (
    select prefix[1:depth - 1] as above, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by 1, 2
), counted as (
    select n.*, coalesce(n_children, 0) as n_children from nodes n left join children k on k.above = n.prefix and k.depth = n.depth
), up as (
    select depth, prefix, n_convs, size, n_children, unnest(range(depth + 1)) as level from counted
), subtree as (
    select prefix[1:level] as prefix, level as depth, sum((n_children = 0)::int) as n_leaves, sum((n_convs - 1) * size) as saved_tokens from up group by 1, 2
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, sha256(coalesce(n.ends, '')) as ends_sha256
from counted n join subtree s on s.prefix = n.prefix and s.depth = n.depth left join counted p on n.depth > 0 and p.prefix = n.prefix[1:n.depth - 1] and p.depth = n.depth - 1
"""
