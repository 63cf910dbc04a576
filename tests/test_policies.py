from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from maskloom.operators.policies import (
    ContentPolicy,
    KeyValuePolicy,
    Rotation,
    name_pairs,
    rotation_for,
    scoped_replace,
    with_parents,
)
from maskloom.plans.strategies import MaskError


def test_named_rotation_beats_the_regex_and_null_follows_the_schema(spark):
    frame = spark.createDataFrame([("a.secret", "1"), ("b.secret", "2"), ("c", "3"), (None, "4")], "key string, value string")
    policy = KeyValuePolicy("t", drop_regex="secret", rotations={"a.secret": Rotation(constant="new")})
    assert [r["value"] for r in policy.apply(frame).collect()] == ["new", None, "3", "4"]
    strict = KeyValuePolicy("t", drop_regex="secret", nullable=False)
    assert [r["value"] for r in strict.apply(frame).collect()] == ["", "", "3", "4"]


def test_rotations():
    assert rotation_for("hr.employee", "pin").constant == "0000"
    assert rotation_for("m", "f", "token").fresh == "token"
    with pytest.raises(MaskError, match="no implementation"):
        rotation_for("m", "f")
    with pytest.raises(MaskError, match="unknown fresh value"):
        rotation_for("m", "f", {"fresh": "nope"})


def test_content_policy_without_the_optional_columns(spark):
    frame = spark.createDataFrame([(1, "a.pdf")], "id int, name string")
    assert ContentPolicy(scrub_parents=["p"], exclude_parents=["q"]).apply(frame).first() == (1, "a.pdf")


def test_excluded_parents_lose_their_rows_and_null_parents_stay(spark):
    frame = spark.createDataFrame([(1, "a", "p"), (2, "b", "q"), (3, "c", None)], "id int, name string, res_model string")
    assert [r["id"] for r in ContentPolicy(exclude_parents=["q"]).apply(frame).collect()] == [1, 3]


def test_dropped_content_is_not_read(spark, shop_folder):
    pages = spark.read.parquet(f"{shop_folder}/pages.parquet")
    plan = ContentPolicy(drop_columns=["html"]).apply(pages)._jdf.queryExecution().executedPlan().toString()
    assert "html" not in plan.split("ReadSchema:")[1]


def test_parents_from_a_table(spark):
    frame = spark.createDataFrame([(1, "p"), (2, "q"), (3, None)], "id int, m string")
    parents = spark.createDataFrame([("p",), ("p",)], "name string")
    assert with_parents(frame, "m", parents).count() == with_parents(frame, "m", ["p"]).count() == 1


def names(spark):
    before = spark.createDataFrame([(1, "Acme"), (2, "Acme North"), (3, "Same"), (4, ""), (5, None)], "id int, name string")
    after = spark.createDataFrame([(1, "Blue"), (2, "Acme Fake"), (3, "Same"), (4, "x"), (5, "y")], "id int, name string")
    return name_pairs(before, after, ["id"], "name")


def python_replace(text, pairs):
    for old, new in sorted(pairs, key=lambda p: (-len(p[0]), p[0])):
        text = text.replace(old, new)
    return text


def test_pairs_keep_real_changes_only(spark):
    assert sorted(map(tuple, names(spark).collect())) == [("Acme", "Blue"), ("Acme North", "Acme Fake")]


@pytest.mark.parametrize("max_pairs", [100, 1])
def test_sequential_longest_first(spark, max_pairs):
    frame = spark.createDataFrame([(1, "Acme North, Acme, acme"), (2, "Acme"), (3, None)], "id int, t string")
    out = scoped_replace(frame, "t", F.col("id") != 2, names(spark), max_pairs=max_pairs)
    want = python_replace("Acme North, Acme, acme", [("Acme", "Blue"), ("Acme North", "Acme Fake")])
    assert want == "Blue Fake, Blue, acme"
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, want), (2, "Acme"), (3, None)]


def test_json_of_any_shape_stays_json_and_keeps_its_keys(spark):
    body = {"Acme": ["Acme", {"x": "by Acme North \"q\""}, 1, None, True]}
    frame = spark.createDataFrame([(1, json.dumps(body)), (2, json.dumps(body)), (3, None)], "id int, t string")
    out = scoped_replace(frame, "t", F.col("id") != 2, names(spark), json_text=True).orderBy("id").collect()
    assert json.loads(out[0]["t"]) == {"Acme": ["Blue", {"x": "by Blue Fake \"q\""}, 1, None, True]}
    assert json.loads(out[1]["t"]) == body and out[2]["t"] is None


def test_no_pairs_change_nothing(spark):
    frame = spark.createDataFrame([(1, "Acme")], "id int, t string")
    assert scoped_replace(frame, "t", F.lit(True), names(spark).where("old = 'none'")).first() == (1, "Acme")


def test_pairs_are_replaced_one_after_the_other(spark):
    import random

    from maskloom.functions.text import PairReplacer

    draw = random.Random(5)
    word = lambda low, high: "".join(draw.choice("ab ") for _ in range(draw.randint(low, high)))
    for _ in range(300):
        pairs = sorted({word(1, 4): word(0, 4) for _ in range(8)}.items(), key=lambda p: (-len(p[0]), p[0]))
        text = expected = word(0, 25)
        for old, new in pairs:
            expected = expected.replace(old, new)
        assert PairReplacer(pairs).text(text) == expected
    assert PairReplacer([]).text("x") == "x" and PairReplacer([("a", "b")]).json('{"a": ["a", {"x": "ca"}, 1, null]}') == '{"a": ["b", {"x": "cb"}, 1, null]}'


def test_a_long_pair_list_is_one_job_over_the_rows(spark):
    names = spark.range(100_000).select(F.concat(F.lit("Name "), F.lpad(F.col("id").cast("string"), 6, "0")).alias("old"), F.concat(F.lit("N"), F.col("id").cast("string")).alias("new"))
    frame = spark.range(2_000).select("id", F.concat(F.lit("seen Name "), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit(" here")).alias("text"))
    out = scoped_replace(frame, "text", F.col("id") % 2 == 0, names)
    got = {r.id: r.text for r in out.collect()}
    assert got[40] == "seen N40 here" and got[41] == "seen Name 000041 here" and len(got) == 2_000
