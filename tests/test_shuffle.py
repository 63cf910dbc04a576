from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from maskloom.operators.shuffle import keyed_position, shuffle_column


def expected(rows, salt=""):
    order = sorted(rows, key=lambda r: (hashlib.md5((salt + str(r[0])).encode()).hexdigest(), r[0]))
    return {row[0]: order[(i + 1) % len(order)][1] for i, row in enumerate(order)}


@pytest.mark.parametrize("digits", [1, 2, 4])
@pytest.mark.parametrize("partitions", [1, 7])
def test_cyclic_shift_in_hash_order(spark, digits, partitions):
    rows = [(i, None if i % 3 == 0 else f"v{i % 40}") for i in range(700)]
    frame = spark.createDataFrame(rows, "k int, v string").repartition(partitions)
    out = shuffle_column(frame, "v", ["k"], salt="z", bucket_digits=digits).collect()
    assert {r["k"]: r["v"] for r in out} == expected(rows, "z")
    assert Counter(r["v"] for r in out) == Counter(v for _, v in rows)


def test_every_row_gets_another_rows_value(spark):
    frame = spark.range(500).select(F.col("id").alias("k"), F.col("id").alias("v"), F.lit("x").alias("other"))
    out = shuffle_column(frame, "v", ["k"])
    assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in frame.schema.fields]
    assert out.where("k = v").count() == 0


@pytest.mark.parametrize("n", [0, 1, 2])
def test_tiny_tables(spark, n):
    frame = spark.range(n).select(F.col("id").alias("k"), (F.col("id") + 10).alias("v"))
    out = {r["k"]: r["v"] for r in shuffle_column(frame, "v", ["k"]).collect()}
    assert out == {0: {}, 1: {0: 10}, 2: {0: 11, 1: 10}}[n]


def test_within_groups_one_of_them_hot_and_one_null(spark):
    rows = [(i, "hot" if i % 3 else None if i % 2 else f"g{i % 5}", i) for i in range(600)]
    frame = spark.createDataFrame(rows, "k int, g string, v int")
    out = shuffle_column(frame, "v", ["k"], within=["g"], bucket_digits=2).collect()
    by_group = {}
    for k, g, v in rows:
        by_group.setdefault(g, []).append((k, v))
    want = {k: v for group in by_group.values() for k, v in expected(group).items()}
    assert {r["k"]: r["v"] for r in out} == want


def test_position_is_the_global_rank(spark):
    frame = spark.range(300).select(F.col("id").alias("k"))
    got = {r["k"]: r["position"] for r in keyed_position(frame.repartition(5), ["k"], bucket_digits=2).collect()}
    order = sorted(range(300), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())
    assert got == {k: i + 1 for i, k in enumerate(order)}
