from __future__ import annotations

import pytest

from maskloom.operators import coverage
from maskloom.plans import schema
from maskloom.plans.mask import mask
from maskloom.plans.rulebook import default_rules_dir, load_and_validate, rulebook_from

pytest.importorskip("yaml")

ROWS = [
    ("res_partner", "id", "integer", None),
    ("res_partner", "name", "character varying(80)", None),
    ("res_partner", "image_1920", "bytea", None),
    ("crm_lead", "id", "integer", None),
    ("crm_lead", "name", "varchar", None),
    ("crm_lead", "partner_id", "integer", "res_partner.id"),
    ("crm_lead", "stage_id", "integer", "crm_stage.id"),
    ("x_custom_ticket", "subject", "TEXT", None),
    ("x_custom_ticket", "customer_id", "integer", "res_partner.id"),
    ("x_custom_ticket", "payload", "bytea", None),
    ("x_custom_ticket", "opened", "timestamp", None),
    ("account_move", "invoice_partner_display_name", "varchar", None),
    ("x_random_model", "sum_display_name", "integer", None),
    ("x_random_model", "some_display_name", "varchar", None),
    ("x_random_model", "email_normalized", "varchar", None),
]


@pytest.fixture(scope="module")
def rules():
    return load_and_validate(default_rules_dir())


@pytest.fixture(scope="module")
def columns(spark):
    rows = [(t, c, d, fk, True, i) for i, (t, c, d, fk) in enumerate(ROWS)]
    return schema.with_shape(spark.createDataFrame(rows, schema.SCHEMA_DDL))


def test_shapes(spark):
    cases = {
        ("varchar(10)", None): "free_text", ("TEXT", None): "free_text", ("character", None): "free_text", ("bytea", None): "binary",
        ("integer", "res_partner.id"): "partner_ref", ("text", "other.id"): "other", ("numeric(15,8)", None): "other",
        ("jsonb", None): "free_text", ("map<string,string>", None): "free_text", ("array<float>", None): "other",
        ("array<struct<string:int,b:binary>>", None): "binary", ("struct<a:int,b:string>", None): "free_text", ("string", None): "free_text",
    }
    rows = [("t", str(i), d, fk, True, i) for i, (d, fk) in enumerate(cases)]
    got = {int(r["column"]): r["shape"] for r in schema.with_shape(spark.createDataFrame(rows, schema.SCHEMA_DDL)).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_findings(columns, rules):
    report = coverage.analyze(columns, rules)
    found = [(r["table"], r["column"], r["outcome"], r["shape"]) for r in coverage.findings(report).collect()]
    assert found == [
        ("crm_lead", "name", "uncovered", "free_text"),
        ("crm_lead", "partner_id", "uncovered", "partner_ref"),
        ("x_custom_ticket", "customer_id", "undeclared_model", "partner_ref"),
        ("x_custom_ticket", "payload", "undeclared_model", "binary"),
        ("x_custom_ticket", "subject", "undeclared_model", "free_text"),
    ]
    assert [r["model"] for r in coverage.undeclared_models(report).collect()] == ["x.custom.ticket"]
    assert [(r["table"], r["column"]) for r in coverage.pattern_covered(report).collect()] == [
        ("x_random_model", "email_normalized"), ("x_random_model", "some_display_name"),
    ]
    assert coverage.summary(report).first() == (15, 3, 2, 5)


def test_ignored_models_and_gate(columns, rules):
    report = coverage.analyze(columns, rules, ignore_models=["x.custom.ticket", "crm.lead"])
    assert coverage.summary(report).first()["considered"] == 7
    coverage.gate(report)
    with pytest.raises(coverage.CoverageError, match="crm_lead.name"):
        coverage.gate(coverage.analyze(columns, rules))


def test_first_pattern_in_declaration_order_wins(columns, rules):
    named = columns.where("column = 'some_display_name'")
    hit = named.select(coverage.matching_patterns(columns["column"], columns["shape"], rules.patterns).alias("m")).first()["m"]
    assert [h["regex"] for h in hit] == ["_display_name$"]


def test_no_patterns(columns, rules):
    bare = load_and_validate(default_rules_dir())
    bare.patterns.clear()
    assert coverage.summary(coverage.analyze(columns, bare)).first()["by_pattern"] == 0


def test_snapshot_round_trip_and_diff(spark, columns, tmp_path):
    path = f"{tmp_path}/snap"
    schema.save_snapshot(columns, path)
    assert sorted(map(tuple, schema.load_snapshot(spark, path).select(columns.columns).collect())) == sorted(map(tuple, columns.collect()))
    after = columns.where("column <> 'payload'").unionByName(
        schema.with_shape(spark.createDataFrame([("new", "c", "text", None, True, 0)], schema.SCHEMA_DDL))
    )
    assert [(r["table"], r["column"], r["change"]) for r in coverage.diff(columns, after).collect()] == [
        ("new", "c", "added"), ("x_custom_ticket", "payload", "dropped"),
    ]


def test_leaf_columns_and_catalog(spark):
    frame = spark.sql("select 1 as i, named_struct('a', 'x', 'b', array(named_struct('c', 1))) as s, array('t') as l, map('k', array('v')) as m")
    paths = [(p, d.simpleString()) for p, d, _ in schema.leaf_columns(frame.schema)]
    assert paths == [("i", "int"), ("s.a", "string"), ("s.b.[].c", "int"), ("l", "array<string>"), ("m.{}", "array<string>")]
    frame.createOrReplaceTempView("nested_view")
    rows = schema.scan_catalog(spark).where("table = 'nested_view'").collect()
    assert {r["column"]: r["shape"] for r in rows} == {"i": "other", "s.a": "free_text", "s.b.[].c": "other", "l": "free_text", "m.{}": "free_text"}
    spark.catalog.dropTempView("nested_view")


def test_composite_references_pair_by_position(spark, columns):
    constraints = spark.createDataFrame(
        [("crm_lead", ["stage_id", "id"], "pair", ["s", "i"])], "table string, columns array<string>, ref_table string, ref_columns array<string>"
    )
    got = {r["column"]: r["fk_target"] for r in schema.resolve_references(columns, constraints).where("table = 'crm_lead'").collect()}
    assert got == {"id": "pair.i", "name": None, "partner_id": "res_partner.id", "stage_id": "pair.s"}


def test_nested_columns_are_covered_by_their_own_or_their_parents_rule(spark):
    frame = spark.sql("select named_struct('a_name', 'x', 'b', 'y') as s, array(named_struct('c', 'z', 'd', 'w')) as l")
    vocabulary = {"strategies": {"redact_freetext": None, "drop": None}}
    pattern = {"column_patterns": [{"match": "_name$", "strategy": "redact_freetext"}]}
    book = rulebook_from({"00_strategies": vocabulary, "05": pattern, "10": {"t": {"fields": {"s": "drop", "l[].c": "redact_freetext"}}}})
    report = coverage.analyze(schema.scan_schema(spark, {"t": frame}), book)
    assert {r["column"]: r["outcome"] for r in report.collect()} == {
        "s.a_name": "explicit", "s.b": "explicit", "l.[].c": "explicit", "l.[].d": "uncovered",
    }
    assert mask({"t": frame}, book).dataset["t"].first() == (None, [("l", "w")])
