"""Operators that link rows, against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from maskloom.llm import components, decontam, flat_graph, simhash
from tests.llm.conftest import DOCS, ordered, pairs, sentences


def roots(nodes, edges) -> dict:
    """The smallest node that each node reaches."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(300)], [(0, i) for i in range(1, 400)], [(9, 9)], [(5, 1), (1, 5), (7, 5), (30, 31), (31, 32), (40, 30)]])
def test_components(spark, edges):
    got = components.components(spark.createDataFrame(edges, "a long, b long").repartition(7))
    real = [e for e in edges if e[0] != e[1]]
    assert dict(pairs(got, "node", "component")) == roots({n for e in real for n in e}, real)
    assert got.count() == got.distinct().count()


def test_components_of_random_graphs_and_none(spark):
    draw = random.Random(3)
    edges = [(draw.randint(0, 500), draw.randint(0, 500)) for _ in range(420)]
    got = components.components(spark.createDataFrame(edges, "a long, b long").repartition(6))
    real = [e for e in edges if e[0] != e[1]]
    assert dict(pairs(got, "node", "component")) == roots({n for e in real for n in e}, real)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_print(text) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_simhash_groups(spark, odd_docs, odd_rows, no_docs):
    near = [(300 + i, t + " tail") for i, t in enumerate(sentences(12, 8)) for _ in range(2)]
    rows = odd_rows + near
    docs = odd_docs.unionByName(spark.createDataFrame([(i, t, *["z"] * (len(DOCS) - 2)) for i, t in near], DOCS))
    prints = [plain_print(t) for _, t in rows]
    values = sorted(set(prints))
    root = roots(values, [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2])
    least: dict = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    expected = ordered((i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(rows, prints))
    assert pairs(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ordered((i,) for i in ids if i is not None) == ordered((i,) for i in least.values())  # one for each group, also where an id names two
    assert simhash.near_duplicates(no_docs).count() == simhash.keep_one(no_docs).count() == 0


def test_nameless_documents_keep_one_of_each_print(spark):
    docs = spark.createDataFrame([(None, "a b c d", "x"), (None, "a b c d", "y"), (None, "quite another text here", "x"), (1, "one more text with an id", "x"), (None, "one more text with an id", "x")], "doc_id long, text string, fingerprint string")
    assert ordered((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()) == ordered([(None, "a b c d"), (None, "quite another text here"), (1, "one more text with an id")])


def test_trees_find_all_close_pairs(spark):
    draw = np.random.default_rng(1)
    seeds = draw.integers(0, 1 << 63, 3_000, dtype=np.uint64)
    flips = seeds[:900] ^ (np.uint64(1) << draw.integers(0, 64, 900).astype(np.uint64))
    chain = [np.uint64((1 << k) - 1) for k in range(60)]
    values = np.unique(np.concatenate([seeds, flips, flips[:300] ^ np.uint64(5), np.array(chain)]))
    true = {(int(a), int(b)) for i, a in enumerate(values) for b in values[i + 1 :][np.bitwise_count(values[i + 1 :] ^ a) <= 2]}
    got = {(min(int(x), int(y)), max(int(x), int(y))) for a, b in simhash.close_pairs(values, values, 2) for x, y in zip(a, b) if x != y}
    assert got == true
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long").repartition(4)
    edges = simhash.links(frame, sample=2_000, shard=128)
    found = [(a & (2**64 - 1), b & (2**64 - 1)) for a, b in pairs(edges, "a", "b")]
    nodes = [int(v) for v in values]
    assert roots(nodes, found) == roots(nodes, true)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_hits(docs, items):
    cut = lambda t: WORD.findall("".join(c.lower() if c.isascii() else c for c in (t or "")))
    out = []
    for i, text in docs:
        words, hit, named = cut(text), set(), set()
        for item, passage in items:
            other = cut(passage)
            span = min(13, len(other))
            for a in range(len(other) - span + 1) if other else ():
                for b in range(len(words) - span + 1):
                    if words[b : b + span] == other[a : a + span]:
                        hit.update(range(b, b + span))
                        named.add(item)
        listed = sorted(str(n) for n in named if n is not None)
        out.append((i, len(words), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)))
    return ordered(out)


@pytest.mark.parametrize("short", [False, True])
def test_every_shared_span_is_hit(spark, odd_docs, odd_rows, no_docs, short):
    draw, passages = random.Random(6), [" ".join(s.split()[:40]) for s in sentences(60, 9) if len(s.split()) >= 13]
    items = list(enumerate(passages[:20])) + [(3, passages[3]), (10, passages[0]), (None, passages[1]), (30, None), (31, ""), (32, "-- ..")]
    items += [(40, " ".join(["la"] * 20)), (41, passages[2].upper().replace(" ", " - "))]
    if short:
        items += [(50, "one two"), (51, "la"), (52, "never there at all"), (53, passages[5].split()[0])]
    rows = list(odd_rows)
    for n in range(60):
        words, length = passages[n % 20].split(), draw.randint(11, 16)
        start = draw.randint(0, max(0, len(words) - length))
        middle = draw.choice([" ", ", ", "\n"]).join(words[start : start + length])
        rows.append((400 + n, f"{draw.choice(passages[20:])} {middle} {draw.choice(passages[20:])}"))
    rows += [(500, "la " * 40), (501, "la " * 12), (502, passages[4] + " " + passages[4]), (500, "la " * 40)]
    docs = spark.createDataFrame([(i, t, *["z"] * (len(DOCS) - 2)) for i, t in rows], DOCS).repartition(4)
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, key string")
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    expected = plain_hits(rows, items)
    assert pairs(decontam.contamination(docs, bench), *columns) == expected
    kept = decontam.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    assert pairs(kept, "doc_id") == [(e[0],) for e in expected if not e[5]]
    if not short:
        assert decontam.contamination(no_docs, bench).count() == 0
        assert not decontam.contamination(docs, bench.limit(0)).where("n_hit > 0").count()


VECTORS = "vec_id long, embedding array<float>, label int, node long, v string"


def vectors(seed: int, groups: int, size: int, spread: float) -> list[tuple]:
    draw, rows = np.random.default_rng(seed), []
    for g in range(groups):
        centre = draw.normal(size=24)
        for _ in range(size):
            rows.append((len(rows), [float(x) for x in (centre + draw.normal(size=24) * spread) * draw.uniform(0.1, 10)], g % 3, 1, "v"))
    return rows


def test_vectors_link_within_labels(spark):
    rows = vectors(2, 60, 6, 0.2)
    rows += [(1000 + i, rows[0][1], 0, 1, "v") for i in range(30)] + [(1100, rows[0][1], 1, 1, "v"), (1101, rows[0][1], None, 1, "v")]
    rows += [(1102, None, 0, 1, "v"), (1103, [0.0] * 24, 0, 1, "v"), (1104, [float("nan")] * 24, 0, 1, "v"), (1105, [None] * 24, 0, 1, "v"), (1106, [1.0, 2.0], 0, 1, "v"), (1107, [], 0, 1, "v")]
    rows += [(1108, [float("inf")] + [1.0] * 23, 0, 1, "v"), (None, rows[0][1], 0, 1, "v"), (None, None, 0, 1, "v"), (7, rows[7][1], rows[7][2], 1, "v"), (1109, [2.0, 4.0], 0, 1, "v")]
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    good = [n for n, (_, v, label, *_) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for at, a in enumerate(good):
        for b in good[at + 1 :]:
            if rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.float32(rows[a][1]).astype(float), np.float32(rows[b][1]).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                    links.append((a, b))
    root, count, least = roots(range(len(rows)), links), [0] * len(rows), {}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    for n, row in enumerate(rows):
        if row[0] is not None:
            least[root[n]] = min(row[0], least.get(root[n], row[0]))
    names = [least.get(root[n], rows[n][0]) for n in range(len(rows))]
    expected = ordered((row[0], count[n], names[n], row[0] is not None and row[0] == names[n]) for n, row in enumerate(rows))
    assert pairs(flat_graph.near_duplicates(frame), "vec_id", "n_links", "component_id", "kept") == expected
    assert flat_graph.near_duplicates(frame.limit(0)).count() == 0


def test_recall_over_shards_and_dense_groups(spark):
    rows = vectors(5, 40, 20, 0.15) + [(10_000 + n, v, 0, 1, "v") for n, (_, v, *_) in enumerate(vectors(6, 1, 400, 0.05))]
    frame = spark.createDataFrame(rows, VECTORS)
    settings = flat_graph.Settings(shard=150)
    out = flat_graph.audit(frame, settings=settings, every=3).first()
    assert out.true_links > 1_000 and out.recall >= 0.9
    assert flat_graph.audit(frame.limit(0)).first().recall == 1.0


def test_links_cross_shards_in_a_dense_group(spark):
    draw = np.random.default_rng(4)
    centre, plane = draw.normal(size=64) / 8, np.linalg.qr(draw.normal(size=(64, 6)))[0]
    # 8,000 different near copies on a patch that is wider than the threshold, among 8,000 other vectors of their label.
    dense = centre + draw.normal(size=(8_000, 6)) @ plane.T * 0.24 + draw.normal(size=(8_000, 64)) * 0.01
    rows = np.concatenate([dense, draw.normal(size=(8_000, 64))])
    frame = spark.createDataFrame([(n, v.tolist(), 0, 1, "v") for n, v in enumerate(rows)], VECTORS)
    out = flat_graph.audit(frame, every=100).first()
    assert out.true_links > 1_000 and out.recall >= 0.99, out


def test_links_are_never_below_the_threshold(spark, shop_folder):
    frame = spark.read.parquet(f"{shop_folder}/embeddings.parquet")
    pts = flat_graph._nodes(frame, "vec_id", "embedding", "label").select("label", "node", "v").dropDuplicates(["node"])
    held = {r.node: np.array(r.v, float) for r in pts.collect()}
    for a, b in pairs(flat_graph.links(pts, flat_graph.Settings(), 0.93), "a", "b"):
        x, y = held[a], held[b]
        assert x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93 - 1e-12


def test_one_document_of_every_group_when_ids_repeat(spark):
    """An id with several texts names several groups; the texts show whether each kept one."""
    a, b, c = "alpha beta gamma delta epsilon zeta", "one two three four five six seven", "red orange yellow green blue indigo"
    texts = lambda rows: ordered((r.doc_id, r.text) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert texts([(5, a), (5, b), (3, b)]) == ordered([(5, a), (3, b)])
    assert texts([(5, a), (5, c)]) == ordered([(5, a), (5, c)])
    assert texts([(5, a), (5, a), (5, c), (7, c), (7, b)]) == ordered([(5, a), (5, c), (7, b)])
    assert texts([(None, a), (None, a), (9, a), (None, c), (None, c)]) == ordered([(9, a), (None, c)])
