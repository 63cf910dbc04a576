from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from maskloom.operators.shuffle import derange_column, derangement_bounds, shuffle_columns
from maskloom.plans.mask import mask
from maskloom.plans.rulebook import rulebook_from


def moved(frame, digits=4, **options):
    out = derange_column(frame.withColumn("was", F.col("v")), "v", ["k"], salt="z", bucket_digits=digits, **options).collect()
    return {r.k: r.v for r in out}, [(r.was, r.v) for r in out]


@pytest.mark.parametrize("values", [["a", "b"], ["a", "a", "b", "b"], [None, "a", "a", None], ["a", "b", "c"] * 40, list("aaab"), ["x"] * 9, ["a"] * 50 + ["b"] * 30 + [None] * 20 + [str(i) for i in range(11)], [str(i) for i in range(97)]])
def test_as_few_as_possible_keep_their_value(spark, values):
    frame = spark.createDataFrame(list(enumerate(values)), "k int, v string")
    rows, largest, unavoidable = derangement_bounds(frame, "v")
    by_key, pairs = moved(frame)
    assert (rows, largest) == (len(values), max(Counter(values).values())) and unavoidable == max(0, 2 * largest - rows)
    assert sum(a == b for a, b in pairs) == unavoidable and Counter(b for _, b in pairs) == Counter(values)


def test_the_same_whatever_the_partitions_and_buckets(spark):
    frame = spark.createDataFrame([(i, i % 7 if i % 3 else None) for i in range(400)], "k int, v int")
    found = [moved(frame.repartition(p), d)[0] for p, d in ((1, 4), (9, 2), (5, 1))]
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("count", [0, 1])
def test_tiny_tables(spark, count):
    frame = spark.createDataFrame([(i, "a") for i in range(count)], "k int, v string")
    assert moved(frame)[0] == {i: "a" for i in range(count)}


def test_types_and_columns_stay(spark):
    frame = spark.createDataFrame([(i, [float(i % 4), None], {"m": i}) for i in range(12)], "k int, v array<double>, extra map<string,int>")
    out = derange_column(frame, "v", ["k"], salt="z")
    assert out.schema == frame.schema
    assert sorted((r.k, r.extra["m"]) for r in out.collect()) == [(i, i) for i in range(12)]


def test_repeated_keys(spark):
    frame = spark.createDataFrame([(1, "a", i) for i in range(10)] + [(1, "b", i) for i in range(10)] + [(None, "c", 0)] * 4, "k int, v string, w int")
    found = [Counter((r.k, r.w, r.v) for r in derange_column(frame.repartition(p), "v", ["k"], salt="z").collect()) for p in (1, 6)]
    assert found[0] == found[1] and sum(found[0].values()) == 24


def test_by_rule(spark):
    data = {"t": spark.createDataFrame([(i, "ab"[i % 2], "xyz"[i % 3], f"n{i}") for i in range(60)], "id int, a string, b string, c string")}
    derange = {"strategy": "shuffle_within_column", "derange": True, "salt": "q"}
    book = rulebook_from({"00_strategies": {"strategies": dict.fromkeys(["shuffle_within_column", "drop"])}, "10": {"t": {"key": ["id"], "fields": {"a": derange, "b": {**derange, "derange": False}, "c": derange, "id": "drop"}}}})
    rows = mask(data, book).dataset["t"].withColumn("n", F.lit(1)).collect()
    assert Counter(r.a for r in rows) == {"a": 30, "b": 30} and Counter(r.b for r in rows) == dict.fromkeys("xyz", 20) and {r.id for r in rows} == {None}
    one = rulebook_from({"00_strategies": {"strategies": {"shuffle_within_column": None}}, "10": {"t": {"key": ["id"], "fields": {"a": derange, "c": derange}}}})
    after = {r.id: r for r in mask(data, one).dataset["t"].collect()}
    assert all(after[r.id].a != r.a and after[r.id].c != r.c and after[r.id].b == r.b for r in data["t"].collect())


def test_shuffled_columns_of_repeated_keys_are_numbered_by_content(spark):
    frame = spark.createDataFrame([(1.5, i, f"v{i}") for i in range(30)] + [(None, i, f"w{i}") for i in range(30)], "k double, i int, v string")
    from maskloom.operators.shuffle import row_key

    found = []
    for parts in (1, 7):
        source = frame.repartition(parts)
        out = shuffle_columns(source, source.withColumn("__row", row_key(["k"])), {"v": "s:"}, ["k"])
        found.append(Counter((r.k, r.i, r.v) for r in out.collect()))
    assert found[0] == found[1] and Counter(v for _, _, v in found[0].elements()) == Counter(r.v for r in frame.collect())


def test_few_classes_are_told_by_place(spark, monkeypatch):
    """Rows of a column of few values do not meet each other, and take what they would take from another row."""
    from maskloom.operators import shuffle

    frame = spark.createDataFrame([(i % 50, None if i % 9 == 0 else "abcde"[i % 5], i) for i in range(300)], "k int, v string, w int")
    told = shuffle.derange_column(frame, "v", ["k"], salt="z")
    assert told._jdf.queryExecution().optimizedPlan().toString().count("Window [row_number") == 1
    monkeypatch.setattr(shuffle, "FEW_CLASSES", 0)
    met = shuffle.derange_column(frame, "v", ["k"], salt="z")
    assert Counter(map(tuple, told.collect())) == Counter(map(tuple, met.collect()))
