from __future__ import annotations

from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import types as T

from maskloom.llm import whitening

VECTORS = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]
    + [T.StructField(n, T.StringType()) for n in ("i", "j", "total", "size", "deviation", "whitened", "at", "component", "n")]
)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, *["z"] * 9) for i, v in rows], VECTORS)


def exact(rows):
    """Count, sums, covariance (as fractions) and deviations of whole numbers, straight from the definitions."""
    kept = [(i, [floor(float(np.float32(c)) * 64) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and isfinite(c) for c in v)]
    n, dim = len(kept), len(kept[0][1])
    sums = [sum(x[k] for _, x in kept) for k in range(dim)]
    away = [[n * x[k] - sums[k] for k in range(dim)] for _, x in kept]
    cov = [[Fraction(sum(a[p] * a[q] for a in away), n**3) for q in range(dim)] for p in range(dim)]
    return kept, n, sums, cov, [sum(c * c for c in a) for a in away]


def vectors(count, dim, seed=3, scale=1.0):
    draw = np.random.default_rng(seed)
    mixing = draw.normal(size=(dim, dim))
    return [(i, (draw.normal(size=dim) @ mixing * scale).astype(np.float32).tolist()) for i in range(count)]


@pytest.mark.parametrize(("dim", "scale", "parts"), [(6, 1.0, 3), (40, 0.2, 5), (3, 3e7, 2)])
def test_equals_the_definitions(spark, dim, scale, parts):
    rows = vectors(200, dim, scale=scale)
    rows += [(5, rows[5][1]), (None, rows[7][1]), (900, None), (901, [None] * dim), (902, [float("nan")] * dim), (903, [float("inf")] + [0.0] * (dim - 1)), (904, [0.0] * dim)]
    kept, n, sums, cov, deviations = exact(rows)
    docs = frame(spark, rows).repartition(parts)
    model = whitening.fit(docs)
    assert (model.n, model.sums) == (n, sums)
    v = np.array([[float(c) for c in line] for line in cov])
    values, axes = np.linalg.eigh(v)
    order = np.argsort(-values)[:32]
    np.testing.assert_allclose(model.values, values[order], rtol=1e-9)
    assert model.trace == pytest.approx(np.trace(v), rel=1e-12)
    got: dict = {}
    for r in whitening.by_component(docs).collect():
        assert r.n == n and r.identity_error < 1e-6 and r.explained == pytest.approx(values[order][r.component - 1] / np.trace(v), rel=1e-6)
        got.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    mean = [Fraction(s, n) for s in sums]
    fits = [d if d < 2**63 else None for d in deviations]
    assert set(got) == {(i, d) for (i, _), d in zip(kept, fits)}
    for (i, x), deviation in zip(kept, fits):
        centred = np.array([float(c - m) for c, m in zip(x, mean)])
        for at, k in enumerate(order):
            want = abs(float(centred @ axes[:, k])) / np.sqrt(values[k])
            assert any(abs(abs(w) - want) < 1e-6 * max(1, want) for w in got[i, deviation][at + 1])


def test_far_from_zero_and_one_sign_for_all(spark):
    """A large mean over a small spread: what centring after the products would lose."""
    rows = [(i, [1e5 + (i % 7) / 64, 2e5 + (i % 3) / 64, -3e5]) for i in range(50)]
    _, n, _, cov, deviations = exact(rows)
    got = whitening.by_component(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2}  # the third entry does not vary
    assert sorted({(r.vec_id, r.deviation) for r in got}) == sorted((i, d) for (i, _), d in zip(rows, deviations))
    assert all(r.identity_error < 1e-9 for r in got)
    by_id = {c: [r.whitened for r in got if r.component == c] for c in (1, 2)}
    assert all(abs(np.mean(w)) < 1e-9 and np.mean(np.square(w)) == pytest.approx(1) for w in by_id.values())


def test_other_dimensions_and_nothing_to_fit(spark):
    rows = vectors(20, 3) + [(100, [1.0]), (101, []), (102, [1.0] * 5)]
    got = whitening.by_component(frame(spark, rows)).collect()
    assert {r.vec_id for r in got} == set(range(20)) and {r.n for r in got} == {20}
    for none in ([], [(1, None)], [(1, [])], [(1, [2.0, 3.0])], [(1, [2.0]), (2, [2.0]), (3, [float("nan")])]):
        assert whitening.by_component(frame(spark, none)).collect() == []


def test_sums_beyond_64_bits_stay_exact():
    big = np.full((4, 2), 2**52, np.int64)
    roomy = whitening._roomy(big, 2 * whitening._largest(big), len(big))
    assert (roomy * roomy).sum(0).tolist() == [4 * 2**104] * 2
