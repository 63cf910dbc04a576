from __future__ import annotations

import random
from itertools import combinations, permutations, product

import pytest
from pyspark.sql import functions as F

from maskloom.operators import inventory, references, verify
from maskloom.plans import schema


def clean(spark):
    make = spark.createDataFrame
    return {
        "ir_config_parameter": make([("database.secret", "x"), ("database.uuid", "y")], "key string, value string"),
        "payment_token": make([(None,)], "provider_ref string"),
        "payment_provider": make([("disabled",)], "state string"),
        "mail_tracking_value": make([(None, None)], "old_value_char string, new_value_char string"),
    }


def failed(report):
    return {row["check"] for row in report.where("not passed").collect()}


def test_clean_copy_passes(spark):
    report = verify.run_expectations(spark, clean(spark), verify.secret_expectations())
    assert failed(report) == set()
    verify.assert_expectations(report)


def test_each_promise_can_break(spark):
    make = spark.createDataFrame
    data = clean(spark)
    data["payment_token"] = make([("tok",)], "provider_ref string")
    data["payment_provider"] = make([("enabled",), (None,)], "state string")
    data["mail_tracking_value"] = make([("a", None)], "old_value_char string, new_value_char string")
    data["ir_config_parameter"] = make([("database.secret", None), ("database.uuid", "")], "key string, value string")
    report = verify.run_expectations(spark, data, verify.secret_expectations())
    assert {r["check"]: r["violations"] for r in report.where("not passed").collect()} == {
        "database_secret_nonnull": 1, "database_uuid_nonnull": 1, "payment_token_provider_ref_null": 1,
        "payment_provider_disabled": 2, "mail_tracking_values_null": 1,
    }
    with pytest.raises(verify.VerificationError, match="payment_provider_disabled"):
        verify.assert_expectations(report)


def test_empty_or_foreign_target_fails(spark):
    assert "has_tables" in failed(verify.run_expectations(spark, {}, verify.secret_expectations()))
    foreign = {"other": spark.range(1)}
    assert failed(verify.run_expectations(spark, foreign, verify.secret_expectations())) == {"database_secret_nonnull", "database_uuid_nonnull"}


def test_conflicts_collisions_and_join_counts(spark):
    pairs = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "2"), ("b", "2")], "original string, masked string")
    assert [tuple(r) for r in verify.mapping_conflicts(pairs).collect()] == [("a", 2, 2)]
    assert [tuple(r) for r in verify.collisions(pairs).collect()] == [("2", 2)]
    left, right = pairs.select(F.col("masked").alias("k")), pairs.select(F.col("masked").alias("k"))
    assert verify.join_matches(left, "k", right, "k").first()["matches"] == 1 + 9
    assert verify.join_matches(left.limit(0), "k", right, "k").first()["matches"] == 0


def test_unchanged_secrets_compare_values(spark):
    before = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    after = spark.createDataFrame([("a", "1"), ("b", "9")], "k string, v string")
    assert [tuple(r) for r in verify.unchanged_secrets(before, after, "k", "v").collect()] == [("a", "1")]
    assert verify.unchanged_secrets(before, after, "k", "v", ["b"]).count() == 0


def test_properties_count_nulls_as_broken(spark):
    frame = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    assert verify.property_report(frame, {"positive": F.col("v") > 0}).first() == ("positive", 3, 1, 2)


def test_inventory(spark):
    make = spark.createDataFrame
    modules = make(
        [("base", "19.0.1.3", "installed"), ("b", None, "installed"), ("a", "1", "installed"), ("off", "1", "uninstalled")],
        "name string, latest_version string, state string",
    )
    found = make(
        [(1, "/y", "a", "2"), (0, "/z", "a", "3"), (0, "/z", "base", "4")], "path_ordinal int, path string, name string, version string"
    )
    installed = inventory.installed_modules(modules)
    assert [tuple(r) for r in installed.collect()] == [("a", "1"), ("b", ""), ("base", "19.0.1.3")]
    assert inventory.base_version(modules).first() == ("19.0.1.3", "19.0", 19)
    assert sorted(map(tuple, inventory.reconcile(installed, found).collect())) == [
        ("a", "1", "/z", "3", False), ("b", "", None, None, True), ("base", "19.0.1.3", "/z", "4", False),
    ]
    assert [r["name"] for r in inventory.missing_modules(installed, found).collect()] == ["b"]
    assert [r["name"] for r in inventory.undeclared_modules(installed, ["a"]).collect()] == ["b", "base"]
    paths = make([("/z", 2), ("/y", 1), ("/z", 0)], "path string, ordinal int")
    assert [r["path"] for r in inventory.ordered_distinct(paths, "path", "ordinal").collect()] == ["/z", "/y"]


def test_composite_references_equal_brute_force(spark):
    rng = random.Random(5)
    keys = [(a, f"k{b}", c) for a in range(6) for b in range(5) for c in range(4)]
    rng.shuffle(keys)
    twos = sorted({k[:2] for k in keys})
    rows = {
        "three": [(*k, "1:t1") for k in keys],
        "two": [(*k, None, None) for k in twos],
        "child": [(*rng.choice(keys), rng.choice(["k1", "k2", None])) for _ in range(80)] + [(None, "k0", 1, "k1"), (99, "k0", 2, None), (1, None, None, "k4")] + [(*keys[0], "k3")] * 60,
        "inside": [(*rng.choice(keys), "k1") for _ in range(50)] + [(None, "k0", 1, "k1"), (1, None, None, "k4")],
        "none": [(None, None, None, None)] * 2,
    }
    columns = ["a", "b", "c", "d"]
    data = {t: spark.createDataFrame(r, "a bigint, b string, c int, d string") for t, r in rows.items()}
    kind = {"a": 0, "b": 1, "c": 0, "d": 1}

    def tuples(table, some):
        found = [tuple(row[columns.index(c)] for c in some) for row in rows[table]]
        return [f for f in found if None not in f]

    def holds(ct, cc, pt, pc):
        child = set(tuples(ct, cc))
        return bool(child) and child <= set(tuples(pt, pc)) and all((ct, c) != (pt, p) and kind[c] == kind[p] for c, p in zip(cc, pc))

    def unique(table, some):
        return len(tuples(table, some)) == len(set(tuples(table, some)))

    want = set()
    for size in (2, 3):
        parts = [p for k in range(1, size) for p in combinations(range(size), k)]
        pick = lambda some, part: [some[i] for i in part]
        for ct, pt in product(rows, rows):
            for cc, pc in product(combinations(columns, size), permutations(columns, size)):
                if holds(ct, cc, pt, pc) and unique(pt, pc) and all(holds(ct, pick(cc, p), pt, pick(pc, p)) and not unique(pt, pick(pc, p)) for p in parts):
                    want.add((ct, cc, pt, pc, len(set(tuples(ct, cc)))))
    got = references.infer_composite_references(data)
    assert {(r[0], tuple(r[1]), r[2], tuple(r[3]), r[4]) for r in got.collect()} == want
    assert {len(w[1]) for w in want} == {2, 3} and ("inside", ("a", "b"), "two", ("a", "b")) in {w[:4] for w in want}
    assert references.infer_composite_references({"none": data["none"]}).count() == 0


def test_inferred_references_equal_brute_force(spark):
    rng = random.Random(3)
    columns = {
        "p": {"id": list(range(60)), "code": [f"c{i}" for i in range(60)]},
        "q": {"id": list(range(10, 40)), "p_id": [rng.randrange(60) for _ in range(29)] + [None], "code": [f"c{rng.randrange(70)}" for _ in range(30)]},
        "hot": {"p_id": [7] * 80 + [rng.randrange(80) for _ in range(20)], "q_id": [rng.randrange(10, 40) for _ in range(100)]},
        "empty": {"x": [None] * 3},
    }
    data = {}
    for table, cols in columns.items():
        rows = list(zip(*cols.values()))
        ddl = ", ".join(f"{c} {'string' if isinstance(v[0], str) else 'bigint'}" for c, v in cols.items())
        data[table] = spark.createDataFrame(rows, ddl)
    every = [(t, c, v) for t, cols in columns.items() for c, v in cols.items()]
    want = set()
    for ct, cc, cv in every:
        for pt, pc, pv in every:
            child, parent = {x for x in cv if x is not None}, [x for x in pv if x is not None]
            if (ct, cc) != (pt, pc) and child and child <= set(parent) and len(parent) == len(set(parent)):
                want.add((ct, cc, pt, pc, len(child)))
    got = references.infer_references(data)
    assert {tuple(r) for r in got.collect()} == want and want
    filled = references.with_references(schema.scan_schema(spark, data).drop("shape"), got)
    assert filled.where("table = 'q' and column = 'p_id'").first()["fk_target"] == "p.id"


def test_values_cross_the_network_once(spark):
    """One exchange of values by value; repeats are told by counts, nulls and repeated rows included."""
    rows = [(1, 1), (1, 2), (2, None), (2, None), (None, 3)]
    data = {"t": spark.createDataFrame(rows, "a long, b long"), "u": spark.createDataFrame([(i,) for i in (1, 2, 3)], "c long")}
    got = references.infer_references(data)
    assert sorted(map(tuple, got.collect())) == [("t", "a", "t", "b", 2), ("t", "a", "u", "c", 2), ("t", "b", "u", "c", 3), ("u", "c", "t", "b", 3)]
    assert "hashpartitioning(id" not in got._jdf.queryExecution().executedPlan().toString()


def test_lots_are_made_once(spark, tmp_path, monkeypatch):
    """The levels read the different lots as written, and do not make them anew each time."""
    from maskloom.workload import queries

    lines = [(1, 5, 7, 1), (1, 5, 7, 2), (2, 6, 7, 1), (2, None, 8, 1), (2, None, 8, 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, infer = {}, references.infer_composite_references
    monkeypatch.setattr(queries.references, "infer_composite_references", lambda data, columns: seen.update(data) or infer(data, columns))
    queries.QUERIES["infer_composite_references"](spark, str(tmp_path)).collect()
    assert {name: frame.count() for name, frame in seen.items()} == {"lineitem": 5, "lots": 3, "numbered_lots": 4}
    assert all("Aggregate" not in frame._jdf.queryExecution().optimizedPlan().toString() for frame in seen.values())


@pytest.mark.parametrize("low, high", [(-3, 4), (2**40, 2**40 + 9), (-(2**63), 2**63 - 1)])
@pytest.mark.parametrize("parts", [1, 2, 64])
def test_tuples_of_numbers_are_compared_as_one_number(spark, monkeypatch, low, high, parts):
    """Narrow and wide ranges give what sets give, and what a part of the tuples refutes is not read whole."""
    read, included = [], references._included

    def seen(values, rows, count):
        read.append((values.schema["value"].dataType.typeName(), count))
        return included(values, rows, count)

    monkeypatch.setattr(references, "_included", seen)
    monkeypatch.setattr(references, "PARTS", parts)
    rng = random.Random(parts)
    numbers = sorted({low, high, *[rng.randint(low, high) for _ in range(6)]})
    lots = sorted({(rng.choice(numbers), rng.choice(numbers)) for _ in range(30)} | {(n, n) for n in numbers})
    rows = {"lots": lots, "lines": [rng.choice(lots) for _ in range(90)] + [(None, low), (high, None)], "other": [(b, a) for a, b in lots if a != b] + [(n, n) for n in numbers]}
    data = {t: spark.createDataFrame([(a, b) for a, b in r], f"{t}_a long, {t}_b long") for t, r in rows.items()}
    tuples = {t: {r for r in rs if None not in r} for t, rs in rows.items()}
    want = set()
    for child, parent, turned in product(rows, rows, [False, True]):
        there = {(b, a) for a, b in tuples[parent]} if turned else tuples[parent]
        pairs = zip("ab", "ba" if turned else "ab")
        single = all({r["ab".index(c)] for r in tuples[child]} <= {r["ab".index(p)] for r in tuples[parent]} for c, p in pairs)
        if tuples[child] <= there and single and (child != parent) and len(tuples[parent]) == len([r for r in rows[parent] if None not in r]):
            want.add((child, parent, turned, len(tuples[child])))
    want |= {(t, t, True, len(tuples[t])) for t in rows if {(b, a) for a, b in tuples[t]} == tuples[t] and t != "lines"}
    found = references.infer_composite_references(data).collect()
    got = {(r.child_table, r.parent_table, [c[-1] for c in r.child_columns] != [c[-1] for c in r.parent_columns], r.child_values) for r in found}
    assert got == want and {("lots", "other"), ("lines", "lots")} <= {w[:2] for w in want}
    assert {kind for kind, _ in read[1:]} == {"binary" if high - low > 2**62 else "long"}


def test_a_part_of_the_tuples_refutes_most_pairs(spark, monkeypatch):
    """Sides that a part of the tuples shows not to be included are left out of the whole comparison."""
    read, included = [], references._included
    monkeypatch.setattr(references, "_included", lambda values, rows, count: read.append(count) or included(values, rows, count))
    rows = spark.range(4096).select((F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b")).where((F.col("a") + 2 * F.col("b")) % 5 == 0)
    data = {"t": rows.union(rows), "u": rows.select(F.col("a").alias("x"), F.col("b").alias("y"))}
    found = references.infer_composite_references(data).collect()
    assert [(r.child_table, r.child_columns, r.parent_table, r.parent_columns, r.child_values) for r in found] == [("t", ["a", "b"], "u", ["x", "y"], rows.count())]
    assert read == [4, 2]


def test_a_tuple_is_read_in_one_order():
    """Both directions of an inclusion read the same two tuples."""
    place = {column: i for i, column in enumerate([("t", "a"), ("t", "b"), ("u", "y"), ("u", "x")])}
    down, up = (("t", ("a", "b")), ("u", ("x", "y"))), (("u", ("y", "x")), ("t", ("b", "a")))
    assert references._aligned(down, place) == down and references._aligned(up, place) == (down[1], down[0])
