"""Embedding near-duplicates through a robust-pruned flat graph.

Different vectors of a label are dealt to overlapping cluster shards. Each shard builds a pruned neighbour graph,
the adjacency lists of a vector are united over its shards, and a search from the medoid that widens where it finds
links answers for every vector. A vector then asks every further shard that stores one of its near neighbours, until none is
new, so that the walk crosses shards. Only pairs whose cosine is checked in double precision are linked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.components import components
from maskloom.llm.tables import map_batches, stored

COSINE = 0.93
#: Vectors that ask a shard at once; more are dealt over copies of the shard.
ASKS = 20_000


@dataclass(frozen=True)
class Settings:
    """``shard``: vectors a cluster should hold; ``sample``: vectors that fit the cluster centres (every vector is then
    indexed); ``overlap``: clusters a vector is put into; ``degree`` and ``beam`` of the graph; ``slack``: how far below
    the threshold a search still widens."""

    shard: int = 500
    sample: int = 65_536
    overlap: int = 2
    degree: int = 16
    beam: int = 32
    alpha: float = 1.2
    slack: float = 0.08


def greedy(units: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of many queries at once: (nodes, cosines) of the best ``beam`` nodes of each query.

    ``graph`` has the neighbours of each node in a row, padded with -1.
    """
    count, lines = len(queries), np.arange(len(queries))[:, None]
    nodes = np.full((count, beam), -1)
    cosines = np.full((count, beam), -2.0)
    open_ = np.zeros((count, beam), bool)
    visited = np.zeros((count, len(units) + 1), bool)
    nodes[:, 0], cosines[:, 0], open_[:, 0] = start, queries @ units[start], True
    visited[:, start] = visited[:, -1] = True
    while True:
        busy = np.flatnonzero(open_.any(1))
        if len(busy) == 0:
            return nodes, cosines
        best = np.where(open_[busy], cosines[busy], -3).argmax(1)
        picked = nodes[busy, best]
        open_[busy, best] = False
        near = graph[picked]
        fresh = ~visited[busy[:, None], near]
        visited[busy[:, None], near] = True
        found = np.where(fresh, np.einsum("bd,brd->br", queries[busy], units[near]), -2.0)
        all_nodes = np.concatenate([nodes[busy], np.where(fresh, near, -1)], 1)
        all_cosines = np.concatenate([cosines[busy], found], 1)
        all_open = np.concatenate([open_[busy], fresh], 1)
        keep = np.argsort(-all_cosines, 1, "stable")[:, :beam]
        rows = lines[: len(busy)]
        nodes[busy], cosines[busy], open_[busy] = all_nodes[rows, keep], all_cosines[rows, keep], all_open[rows, keep]


def prune(units: np.ndarray, owners: np.ndarray, pools: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning of candidate pools (rows padded with -1): a candidate goes when a kept one is ``alpha`` times
    closer to it than the owner is."""
    at = units[pools]
    # Vectors that are all but equal count as this far apart, give or take: then none of them stands for all others.
    chance = ((pools * 2_654_435_761 ^ owners[:, None] * 40_503) % 1_009) / 1_009
    away = np.sqrt(np.maximum(2 - 2 * np.einsum("bd,bcd->bc", units[owners], at), 1e-12)) * (1 + 1e-3 * chance)
    between = np.sqrt(np.maximum(2 - 2 * (at @ at.transpose(0, 2, 1)), 1e-12))
    alive = (pools >= 0) & (pools != owners[:, None])
    kept, lines = np.full((len(owners), degree), -1), np.arange(len(owners))
    for place in range(degree):
        if not alive.any():
            break
        best = np.where(alive, away, np.inf).argmin(1)
        ok = alive[lines, best]
        kept[ok, place] = pools[lines, best][ok]
        alive &= ~((alpha * between[lines, best] <= away) & ok[:, None])
        alive[lines, best] = False
        alive &= pools != np.where(ok, pools[lines, best], -2)[:, None]
    return kept


def medoid(units: np.ndarray) -> int:
    return int((units @ units.mean(0)).argmax())


def build(units: np.ndarray, settings: Settings, seed: int = 3, step: int = 256) -> np.ndarray:
    """The graph of one shard: a random start, then two passes of search, pruning and back edges."""
    count, draw = len(units), np.random.default_rng(seed)
    degree = min(settings.degree, max(count - 1, 1))
    if count <= degree + 1:
        others = np.tile(np.arange(count), (count, 1))
        others[np.arange(count), np.arange(count)] = -1
        return others
    graph = draw.integers(0, count, (count, degree))
    start = medoid(units)
    for alpha in (1.0, settings.alpha):
        order = draw.permutation(count)
        for low in range(0, count, step):
            part = order[low : low + step]
            nodes, _ = greedy(units, graph, start, units[part], settings.beam)
            graph[part] = prune(units, part, np.concatenate([nodes, graph[part]], 1), degree, alpha)
            to, at = graph[part].ravel(), np.repeat(part, degree)
            to, at = to[to >= 0], at[to >= 0]
            line = np.argsort(to, kind="stable")
            to, at = to[line], at[line]
            ends, first, held = np.unique(to, return_index=True, return_counts=True)
            for at_once in range(0, len(ends), 512):
                some = slice(at_once, at_once + 512)
                wide = np.full((len(ends[some]), int(held[some].max())), -1)
                place = np.arange(first[some][0], first[some][-1] + held[some][-1])
                row = np.repeat(np.arange(len(ends[some])), held[some])
                wide[row, place - np.repeat(first[some], held[some])] = at[place]
                graph[ends[some]] = _with_back_edges(units, ends[some], graph[ends[some]], wide, degree, alpha)
    return graph


def _with_back_edges(units: np.ndarray, owners: np.ndarray, old: np.ndarray, new: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Old neighbours and new ones together; pruned where there is no room for all."""
    pools = np.sort(np.concatenate([old, new], 1), 1)[:, ::-1]
    pools[:, 1:][pools[:, 1:] == pools[:, :-1]] = -1
    pools = np.sort(pools, 1)[:, ::-1]
    full = (pools >= 0).sum(1) > degree
    out = pools[:, :degree].copy()
    width = 8 * degree
    for row in np.flatnonzero(full):
        pool = pools[row][pools[row] >= 0]
        while len(pool) > degree:  # very many back edges are pruned in runs
            kept = prune(units, owners[row : row + 1], pool[None, :width], degree, alpha)[0]
            pool = np.concatenate([kept[kept >= 0], pool[width:]])
        out[row] = -1
        out[row, : len(pool)] = pool
    return out


def in_range(units: np.ndarray, graph: np.ndarray, settings: Settings, least: float, step: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (query, node, cosine) down to ``slack`` below ``least``; every node is a query.

    A beam from the medoid finds the neighbourhood; from what lies in range or a little below, the search goes on
    along the graph's edges, in both directions, until nothing new is in range.
    """
    start, wide = medoid(units), least - settings.slack
    at, place = np.nonzero(graph >= 0)
    one, other = np.concatenate([at, graph[at, place]]), np.concatenate([graph[at, place], at])
    order = np.argsort(one, kind="stable")
    other, bounds = other[order], np.searchsorted(one[order], np.arange(len(units) + 1))
    for low in range(0, len(units), step):
        asked = np.arange(low, min(low + step, len(units)))
        nodes, cosines = greedy(units, graph, start, units[asked], settings.beam)
        line, place = np.nonzero((cosines >= wide) & (nodes >= 0))
        visited = np.zeros((len(asked), len(units)), bool)  # what fell out of the beam may be met again
        visited[line, nodes[line, place]] = True
        # A query is a node itself: its own edges are a second way in.
        own = np.flatnonzero(~visited[np.arange(len(asked)), asked])
        visited[own, asked[own]] = True
        front, where = np.concatenate([line, own]), np.concatenate([nodes[line, place], asked[own]])
        hits = [(front, where, np.concatenate([cosines[line, place], np.ones(len(own))]))]
        while len(front):
            found_here = []
            for some in range(0, len(front), 4_096):
                held = bounds[where[some : some + 4_096] + 1] - bounds[where[some : some + 4_096]]
                line = np.repeat(front[some : some + 4_096], held)
                near = other[np.repeat(bounds[where[some : some + 4_096]], held) + np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)]
                fresh = ~visited[line, near]
                code = np.unique(line[fresh] * len(units) + near[fresh])
                line, near = code // len(units), code % len(units)
                visited[line, near] = True
                cosine = np.einsum("nd,nd->n", units[asked[line]], units[near])
                found_here.append((line[cosine >= wide], near[cosine >= wide], cosine[cosine >= wide]))
            front, where, found = (np.concatenate([f[i] for f in found_here]) for i in range(3))
            hits.append((front, where, found))
        line, node, cosine = (np.concatenate([h[i] for h in hits]) for i in range(3))
        ok = asked[line] != node
        yield asked[line[ok]], node[ok], cosine[ok]


def _units(vectors) -> np.ndarray:
    rows = np.array([np.asarray(v, np.float64) for v in vectors])
    # Scaled first, so that neither very large nor very small components overflow or vanish.
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt(np.einsum("nd,nd->n", rows, rows))[:, None]


def _nodes(rows: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    """id, label, vector and ``node``, which is null where a vector can link with nothing."""
    usable = F.expr("label is not null and v is not null and exists(v, x -> x <> 0) and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    read = rows.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    # 0.0 and -0.0 are the same component.
    same = read.withColumn("v", F.expr("transform(v, x -> if(x = 0, 0 * abs(x), x))"))
    return same.withColumn("node", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("label", "v")))


def _centres(points: DataFrame, settings: Settings) -> dict:
    """(label, dimension) -> centres, for groups that need more than one shard."""
    groups = {(r.label, r.dim): r.n for r in points.groupBy("label", F.size("v").alias("dim")).agg(F.count("*").alias("n")).where(F.col("n") > settings.shard).collect()}
    if not groups:
        return {}
    big = points.groupBy("label", F.size("v").alias("dim")).agg(F.count("*").alias("n")).where(F.col("n") > settings.shard).drop("n")
    picked = points.withColumn("dim", F.size("v")).join(F.broadcast(big), ["label", "dim"]).orderBy(F.xxhash64("node")).limit(settings.sample).select("label", "v").collect()
    held: dict = {}
    for row in picked:
        held.setdefault((row.label, len(row.v)), []).append(row.v)
    centres = {}
    for key, vectors in held.items():
        units = _units(vectors)
        wanted = min(-(-groups[key] // settings.shard), max(1, len(units) // 8))
        at = units[np.random.default_rng(1).choice(len(units), wanted, replace=False)]
        for _ in range(8):
            owner = (units @ at.T).argmax(1)
            sums = np.zeros_like(at)
            np.add.at(sums, owner, units)
            length = np.linalg.norm(sums, axis=1, keepdims=True)
            at = np.where(length > 0, sums / np.maximum(length, 1e-300), at)
        centres[key] = at
    return centres


def _found(asking: np.ndarray, part: pd.DataFrame, blocks: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]], least: float) -> pd.DataFrame:
    """Rows (a, b, null) for links and (a, null, shard) for the shards that store near neighbours of ``a``."""
    ids = part["node"].to_numpy()
    many = np.array([len(h) for h in part["homes"]], np.int64)
    homes = np.full((len(ids), max(1, int(many.max(initial=0)))), -1)
    for place in range(homes.shape[1]):
        homes[many > place, place] = [h[place] for h in part["homes"] if len(h) > place]
    names, where = np.unique(homes, return_inverse=True)
    where = where.reshape(homes.shape)
    a, b, routes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for query, node, cosine in blocks:
        a.append(asking[query[cosine >= least]])
        b.append(ids[node[cosine >= least]])
        routes.append(np.unique(query[:, None] * len(names) + where[node]))
    route = np.unique(np.concatenate(routes))
    query, shard = route // max(1, len(names)), names[route % max(1, len(names))] if len(names) else route
    query, shard = query[shard >= 0], shard[shard >= 0]
    a, b = np.concatenate(a), np.concatenate(b)
    nodes = pd.concat([pd.Series(b, dtype="Int64"), pd.Series(pd.NA, index=range(len(query)), dtype="Int64")], ignore_index=True)
    shards = pd.concat([pd.Series(pd.NA, index=range(len(a)), dtype="Int32"), pd.Series(shard, dtype="Int32")], ignore_index=True)
    return pd.DataFrame({"a": np.concatenate([a, asking[query]]), "b": nodes, "shard": shards})


def links(points: DataFrame, settings: Settings, least: float) -> DataFrame:
    """(a, b): both directions of every link found between different nodes (label, v, node)."""
    shared = points.sparkSession.sparkContext.broadcast(_centres(points, settings))
    label_type = points.schema["label"].dataType.simpleString()
    shape = f"label {label_type}, dim int, shard int, node bigint, v array<double>, homes array<int>"

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, vectors = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            if not vectors:
                continue
            rows, shards, homes = [], [], []
            for i, (label, v) in enumerate(zip(labels, vectors)):
                at = shared.value.get((label, len(v)))
                near = [0] if at is None else np.argsort(-(at @ _units([v])[0]))[: settings.overlap].tolist()
                rows += [i] * len(near)
                shards += near
                homes += [near] * len(near)
            take = pa.array(rows, pa.int64())
            dims = pa.array([len(vectors[i]) for i in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), dims, pa.array(shards, pa.int32()), batch.column(1).take(take), pa.array([vectors[i] for i in rows], pa.list_(pa.float64())), pa.array(homes, pa.list_(pa.int32()))], ["label", "dim", "shard", "node", "v", "homes"])

    doubles = points.select("label", "node", F.col("v").cast("array<double>").alias("v"))
    members = stored(map_batches(doubles, dealt, shape), "shards")
    key = ["label", "dim", "shard"]

    def built(part: pd.DataFrame) -> pd.DataFrame:
        ids = part["node"].to_numpy()
        graph = build(_units(part["v"]), settings)
        return pd.DataFrame({"node": ids, "near": [ids[g[g >= 0]] for g in graph]})

    lists = members.groupBy(key).applyInPandas(built, "node bigint, near array<bigint>")
    united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))

    def searched(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node", ignore_index=True)
        ids, units = part["node"].to_numpy(), _units(part["v"])
        lists_ = [np.asarray(n, np.int64) for n in part["near"]]
        owner, flat = np.repeat(np.arange(len(ids)), [len(n) for n in lists_]), np.concatenate([np.zeros(0, np.int64), *lists_])
        place = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
        here = ids[place] == flat  # neighbours from a vector's other shards that are in this one too
        owner, place = owner[here], place[here]
        held = np.bincount(owner, minlength=len(ids))
        graph = np.full((len(ids), max(1, int(held.max()))), -1)
        graph[owner, np.arange(len(owner)) - np.repeat(np.cumsum(held) - held, held)] = place
        return _found(ids, part, in_range(units, graph, settings, least), least)

    def compared(some: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        asking, left, right = some["node"].to_numpy(), _units(some["v"]), _units(part["v"])

        def blocks() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for low in range(0, len(left), 256):
                cosines = left[low : low + 256] @ right.T
                query, node = np.nonzero(cosines >= least - settings.slack)
                yield low + query, node, cosines[query, node]

        return _found(asking, part, blocks(), least)

    out = "a bigint, b bigint, shard int"
    found = stored(members.join(united, "node").groupBy(key).applyInPandas(searched, out), "found")
    asked, pairs = members.select("node", "shard"), found.where("b is not null").select("a", "b")
    while True:
        # Each round asks the shards that the last one's neighbours are in; what has been asked is not asked again.
        routes = found.where("b is null").select(F.col("a").alias("node"), "shard").distinct()
        fresh = stored(routes.join(asked, ["node", "shard"], "left_anti"), "routes")
        if fresh.isEmpty():
            break
        asks = fresh.join(doubles.withColumn("dim", F.size("v")), "node")
        deals = stored(asks.groupBy(key).agg(F.ceil(F.count("*") / ASKS).alias("deals")), "deals")
        dealt_asks = asks.join(deals, key).select(*key, "node", "v", F.expr("pmod(xxhash64(node), deals)").alias("deal"))
        copies = members.join(deals.select(*key, F.col("deals").alias("copies")), key).select(*key, "node", "v", "homes", F.expr("explode(sequence(0L, copies - 1))").alias("deal"))
        found = stored(dealt_asks.groupBy(*key, "deal").cogroup(copies.groupBy(*key, "deal")).applyInPandas(compared, out), "found")
        asked, pairs = asked.unionByName(fresh), pairs.unionByName(found.where("b is not null").select("a", "b"))
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def near_duplicates(rows: DataFrame, least: float = COSINE, settings: Settings = Settings(), id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` (smallest id that links reach, itself included), ``kept``.

    Equal vectors of one label are one node with its number of copies; they link with each other. A null label, and a
    vector that is null, empty, zero or has a null or non-finite component, links with nothing. A null id is never
    a component's name, and is kept only never. Vectors of different length do not link. Repeated rows stay.
    """
    given = stored(_nodes(rows, id_col, vector, label), "vectors")
    points = stored(given.where("node is not null").groupBy("node").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.min("id").alias("first"), F.count("*").alias("copies")), "nodes")
    pairs = stored(links(points.select("label", "node", "v"), settings, least), "links")
    partners = pairs.join(points.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("others"))
    member = components(pairs.where("a > b"))
    named = points.select("node", "first", "copies").join(member, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    answer = named.join(smallest, "component").join(partners, "node", "left").select("node", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = given.select("id", "node").join(answer, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def audit(rows: DataFrame, least: float = COSINE, settings: Settings = Settings(), every: int = 20, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row: ``true_links`` and ``found_links`` of the vectors whose id is divisible by ``every``, and ``recall``.

    The queries are compared with all vectors of their label in blocks.
    """
    given = stored(_nodes(rows, id_col, vector, label).where("node is not null"), "audit")
    asked = given.where(F.col("id") % every == 0).select("label", F.col("node").alias("a"), F.col("v").cast("array<double>").alias("v")).distinct()
    held = given.select("label", F.col("node").alias("b"), F.col("v").cast("array<double>").alias("v")).distinct()
    deals = 16
    blocks = held.withColumn("deal", F.pmod(F.xxhash64("b"), F.lit(deals))).groupBy("label", "deal")
    spread = asked.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1)))).groupBy("label", F.col("deal").cast("bigint").alias("deal"))

    def compared(some: pd.DataFrame, all_: pd.DataFrame) -> pd.DataFrame:
        out = []
        for size in set(map(len, some["v"])) if len(some) and len(all_) else ():
            left, right = some[some["v"].map(len) == size], all_[all_["v"].map(len) == size]
            if len(right):
                a, b = _units(left["v"]), _units(right["v"])
                for low in range(0, len(a), 256):
                    i, j = np.nonzero(a[low : low + 256] @ b.T >= least)
                    out.append(pd.DataFrame({"a": left["a"].to_numpy()[low + i], "b": right["b"].to_numpy()[j]}))
        both = pd.concat(out) if out else pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        return both[both["a"] != both["b"]]

    true = spread.cogroup(blocks).applyInPandas(compared, "a bigint, b bigint").distinct()
    points = given.groupBy("node").agg(F.first("label").alias("label"), F.first("v").alias("v"))
    found = links(points.select("label", "node", "v"), settings, least).withColumn("hit", F.lit(1))
    counts = true.join(found, ["a", "b"], "left").agg(F.count("*").alias("true_links"), F.count("hit").alias("found_links"))
    return counts.withColumn("recall", F.when(F.col("true_links") > 0, F.col("found_links") / F.col("true_links")).otherwise(1.0))
