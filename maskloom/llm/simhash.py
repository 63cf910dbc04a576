"""SimHash near-duplicates: fingerprints of word shingles, linked through vantage-point trees.

Distinct fingerprints are dealt to shards by the top of one tree, fitted on a bounded sample. A fingerprint is
stored in one shard and asked for in every shard that the triangle inequality leaves open; inside a shard
a further tree prunes in the same way, so the pairs within the distance are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.components import components, spanning
from maskloom.llm.tables import fresh_name, map_batches, schema_text, stored

SHINGLE = 3
SEED = 42
DISTANCE = 2
#: Fingerprints of the sample that fits the top of the tree; every fingerprint is then indexed.
SAMPLE = 16_384
#: Fingerprints that a shard should store.
SHARD = 4_096
LEAF = 96


def fingerprint(text: bytes) -> int:
    """A-Z lower-cased, words between ASCII white space, majority of the bits of the shingles' XXH64."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, total, count = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(words) - SHINGLE + 1
    for at in range(0, count, 65_536):
        part = words[at : at + 65_536 + SHINGLE - 1]
        hashes = np.fromiter((digest(s, SEED) for s in map(b" ".join, zip(part, part[1:], part[2:]))), ">u8")
        total += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > count).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint as a signed 64-bit integer; null text counts as empty. Other columns are not read."""

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = np.array([fingerprint(t.as_py() or b"") for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], [id_col, "fp"])

    rows = docs.select(id_col, text_col)
    return map_batches(rows, computed, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, fp bigint")


def _apart(values: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ point)


class Tree:
    """The top of the tree: at each node a vantage point and the median distance of the sample below it."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int = 11):
        self.nodes: dict[int, tuple[np.uint64, int]] = {}
        draw = np.random.default_rng(seed)

        def grow(values: np.ndarray, node: int, left: int) -> None:
            if left == 0 or len(values) < 2:
                return
            point = values[draw.integers(len(values))]
            away = _apart(values, point)
            middle = int(np.median(away))
            near = away <= middle
            if near.all():
                middle = int(away.max()) - 1
                near = away <= middle
                if middle < 0:
                    return
            self.nodes[node] = (point, middle)
            grow(values[near], 2 * node, left - 1)
            grow(values[~near], 2 * node + 1, left - 1)

        grow(sample, 1, depth)

    def place(self, values: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of values, shard) for every shard that may store a fingerprint within ``reach``; 0: where it is stored itself."""
        rows, shards, stack = [], [], [(1, np.arange(len(values)))]
        while stack:
            node, at = stack.pop()
            if len(at) == 0:
                continue
            if node not in self.nodes:
                rows.append(at)
                shards.append(np.full(len(at), node, np.int64))
                continue
            point, middle = self.nodes[node]
            away = _apart(values[at], point).astype(np.int64)
            stack += [(2 * node, at[away - reach <= middle]), (2 * node + 1, at[away + reach > middle])]
        return np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *shards])


def close_pairs(stored_values: np.ndarray, asked: np.ndarray, reach: int, seed: int = 5) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (stored, asked) values at most ``reach`` apart, found by a vantage-point tree over the stored ones."""
    draw, stack = np.random.default_rng(seed), [(stored_values, asked)]
    while stack:
        held, wanted = stack.pop()
        if len(held) == 0 or len(wanted) == 0:
            continue
        near = None
        if len(held) > LEAF:
            point = held[draw.integers(len(held))]
            away = _apart(held, point).astype(np.int64)
            middle = int(np.median(away))
            near = away <= middle
            if near.all():
                middle = int(away.max()) - 1
                near = away <= middle
            if not near.any():
                near = None
        if near is None:
            step = max(1, 4_000_000 // len(held))
            for at in range(0, len(wanted), step):
                block = wanted[at : at + step]
                i, j = np.nonzero(np.bitwise_count(held[:, None] ^ block[None, :]) <= reach)
                if len(i):
                    yield held[i], block[j]
            continue
        far = _apart(wanted, point).astype(np.int64)
        stack += [(held[near], wanted[far - reach <= middle]), (held[~near], wanted[far + reach > middle])]


def links(values: DataFrame, reach: int = DISTANCE, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints (column fp) that chains of close pairs connect.

    A shard returns a spanning forest of its pairs, not the pairs, so dense groups stay small.
    """
    count = values.count()
    depth = int(np.ceil(np.log2(count / shard))) if count > shard else 0
    picked = [r.fp for r in values.orderBy(F.xxhash64("fp")).limit(sample).collect()] if depth else []
    tree = Tree(np.array(picked, np.int64).view(np.uint64), min(depth, int(np.log2(sample / 8))))
    shared = values.sparkSession.sparkContext.broadcast(tree)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for asks in (False, True):
                row, where = shared.value.place(fps, reach if asks else 0)
                yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(np.full(len(row), asks)), pa.array(fps[row].view(np.int64))], ["shard", "asks", "fp"])

    def searched(part: pd.DataFrame) -> pd.DataFrame:
        fps, asks = part["fp"].to_numpy().view(np.uint64), part["asks"].to_numpy()
        a = b = np.zeros(0, np.uint64)
        for x, y in close_pairs(fps[~asks], fps[asks], reach):
            differ = x != y
            a, b = np.concatenate([a, x[differ]]), np.concatenate([b, y[differ]])
            if len(a) > 2_000_000:
                a, b = spanning(a, b)
        if len(a):
            a, b = spanning(a, b)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    placed = map_batches(values.select("fp"), dealt, "shard bigint, asks boolean, fp bigint")
    return placed.groupBy("shard").applyInPandas(searched, "a bigint, b bigint")


def _grouped(docs: DataFrame, reach: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: id, ``fp``, ``component`` (a fingerprint that stands for the group) and ``component_id``."""
    prints = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    values = prints.groupBy("fp").agg(F.min(id_col).alias("first"))
    known = stored(values, "values")
    member = components(links(known.select("fp"), reach))
    rooted = known.join(member.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    smallest = rooted.groupBy("component").agg(F.min("first").alias("component_id"))
    # A fingerprint on very many rows is one row on this side; the optimizer splits the other.
    answer = rooted.join(smallest, "component").select("fp", "component", "component_id")
    return prints.join(answer, "fp").select(id_col, "fp", "component", "component_id")


def near_duplicates(docs: DataFrame, reach: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id that links reach).

    Copies share a fingerprint and are linked through it without being paired. Empty and null texts have
    fingerprint zero. A null id has its fingerprint's component and is never the smallest. Repeated rows stay.
    """
    return _grouped(docs, reach, id_col, text_col).select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, reach: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, with all its columns: one of the smallest id.

    An id with several texts may so stay once for each group that it names. A document without an id stays only if
    none with an id is in its group. Ids that occur once decide by the id alone; for the others, and for
    those without, the fingerprint is made again, as the id does not tell the texts apart.
    """
    found = stored(_grouped(docs, reach, id_col, text_col), "groups")
    key = F.col(id_col)
    twice = stored(found.where(key.isNotNull()).groupBy(key.alias("twice")).count().where("count > 1").select("twice"), "repeated-ids")
    rest = found.where(key != F.col("component_id")).select(key.alias("gone")).unionByName(twice.select(F.col("twice").alias("gone"))).distinct()
    kept = docs.join(rest, docs[id_col] == rest["gone"], "left_anti").where(key.isNotNull())
    named = found.where(key == F.col("component_id")).join(twice, key == F.col("twice"), "left_semi")
    unsure = named.unionByName(found.where(key.isNull() & F.col("component_id").isNull())).select(key.alias("known"), F.col("fp").alias("print"), "component").distinct()
    if not unsure.limit(1).count():
        return kept
    name, group, at = fresh_name(docs, "fingerprint"), fresh_name(docs, "component"), docs.columns.index(text_col)

    def with_print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py() or b"") for t in batch.column(at).cast(pa.large_binary())], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints.view(np.int64))], [*batch.schema.names, name])

    asked = docs.join(twice, docs[id_col] == twice["twice"], "left_semi").unionByName(docs.where(key.isNull()))
    marked = map_batches(asked, with_print, f"{schema_text(docs)}, `{name}` bigint")
    same = marked[id_col].eqNullSafe(unsure["known"]) & (marked[name] == unsure["print"])
    chosen = marked.join(unsure, same).select(*[marked[c] for c in docs.columns], unsure["component"].alias(group)).dropDuplicates([group])
    return kept.unionByName(chosen.drop(group))
