"""The plan and the passes on small seeded tables."""

from __future__ import annotations

import datetime
import decimal
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.operators.leakscan import leak_scan
from maskloom.operators.policies import neutralize
from maskloom.plans.mask import build_plan, mask
from maskloom.plans.rulebook import default_rules_dir, load_and_validate, rulebook_from
from maskloom.plans.strategies import MaskError

pytest.importorskip("yaml")


@pytest.fixture(scope="module")
def rules():
    return load_and_validate(default_rules_dir())


def live_system(spark):
    make = spark.createDataFrame
    return {
        "res_partner": make(
            [(1, "Nora Vance", "Nora.Vance@vance-real.test", "nora.vance@vance-real.test", "+44 20 7946 0000", "9 True Lane", "Truetown",
              "90210", "GB123456789", "prefers calls at noon", bytearray(b"\xde\xad"), 51.5, -0.12, "0990000054321")],
            "id int, name string, email string, email_normalized string, phone string, street string, city string, zip string, vat string, "
            "comment string, image_1920 binary, partner_latitude double, partner_longitude double, barcode string",
        ),
        "ir_config_parameter": make(
            [(1, "database.secret", "OLD_SECRET_77"), (2, "database.uuid", "2222-3333"), (3, "maps_api_key", "KEY-778899"), (4, "mail.catchall.domain", "shop.test")],
            "id int, key string, value string",
        ),
        "payment_token": make([(1, "**** 1881", "tok_live_1", True)], "id int, payment_details string, provider_ref string, active boolean"),
        "payment_provider": make([(1, "enabled", "sk_live_1")], "id int, state string, stripe_secret_key string"),
        "mail_tracking_value": make(
            [(1, "nora.vance@vance-real.test", "nora2@vance-real.test")], "id int, old_value_char string, new_value_char string"
        ),
        "ir_attachment": make(
            [(1, "Nora_Vance_CV.tar.gz", bytearray(b"\xca"), "store/1", "c1", "text of cv", "res.partner"),
             (2, "bill.pdf", bytearray(b"\xbe"), "store/2", "c2", "text of bill", "account.move"),
             (3, None, None, None, None, None, None)],
            "id int, name string, datas binary, store_fname string, checksum string, index_content string, res_model string",
        ),
        "hr_employee": make(
            [(1, "Omar Held", "omar@vance-real.test", datetime.date(1985, 6, 15), "4711", decimal.Decimal("42.50"))],
            "id int, name string, work_email string, birthday date, pin string, km_home_work decimal(8,2)",
        ),
        "mail_message": make(
            [(1, "talked to Nora", "Re: Nora", "nora.vance@vance-real.test")], "id int, body string, subject string, email_from string"
        ),
    }


def test_every_known_value_is_gone(spark, rules):
    source = live_system(spark)
    result = mask(source, rules, salt="s")
    written = {name: spark.createDataFrame(frame.collect(), frame.schema) for name, frame in result.dataset.items()}

    partner, before = written["res_partner"].first(), source["res_partner"].first()
    changed = ("name", "email", "email_normalized", "phone", "street", "city", "zip", "vat", "comment", "barcode")
    assert all(partner[c] not in (None, before[c]) for c in changed)
    assert partner["email"].endswith("@example.invalid") and partner["email"] == partner["email_normalized"]
    assert partner["vat"].startswith("GB") and partner["barcode"] == "****4321"
    assert partner["image_1920"] is partner["partner_latitude"] is partner["partner_longitude"] is None
    assert written["mail_message"].first()["email_from"] == partner["email"]

    settings = {r["key"]: r["value"] for r in written["ir_config_parameter"].collect()}
    assert settings["maps_api_key"] is None and settings["mail.catchall.domain"] == "shop.test"
    assert len(settings["database.secret"]) == 64 and len(settings["database.uuid"]) == 36

    assert written["payment_token"].first() == (1, None, None, False)
    assert written["payment_provider"].first() == (1, "disabled", None)
    assert written["mail_tracking_value"].first() == (1, None, None)
    files = written["ir_attachment"].orderBy("id").collect()
    assert files[0] == (1, "attachment_1.gz", None, None, None, None, "res.partner")
    assert files[1] == (2, "bill.pdf", None, None, None, None, "account.move")
    assert files[2] == (3, None, None, None, None, None, None)
    person = written["hr_employee"].first()
    assert person["birthday"] == datetime.date(1985, 1, 1) and person["pin"] == "0000"
    assert 36 <= person["km_home_work"] <= 49 and person["km_home_work"] != decimal.Decimal("42.50")

    originals = [
        "Nora Vance", "Nora.Vance@vance-real.test", "nora.vance@vance-real.test", "nora2@vance-real.test", "+44 20 7946 0000",
        "9 True Lane", "Truetown", "GB123456789", "prefers calls at noon", "0990000054321", "OLD_SECRET_77", "2222-3333", "KEY-778899",
        "**** 1881", "tok_live_1", "sk_live_1", "Nora_Vance_CV", "text of cv", "text of bill", "Omar Held", "omar@vance-real.test", "4711", "sha256:" + hashlib.sha256(b"\xde\xad").hexdigest(),
    ]
    needles = spark.createDataFrame([(v,) for v in originals], "v string")
    assert leak_scan(written, needles).count() == 0
    assert {row[0] for row in leak_scan(source, needles).collect()} == set(originals)


def test_row_metrics_count_what_was_touched(spark, rules):
    result = mask({"ir_attachment": live_system(spark)["ir_attachment"]}, rules, salt="s", observe=True)
    result.dataset["ir_attachment"].collect()
    assert result.row_metrics()["ir_attachment"] == {
        "rows": 3, "rows_content_dropped": 3, "rows_index_dropped": 2, "filenames_scrubbed": 1,
    }


def test_absent_tables_and_columns_are_skipped_and_counted(spark, rules):
    frame = spark.createDataFrame([(1, "X", "x@y.test")], "id int, name string, email string")
    plan = build_plan({"res_partner": frame}, rules)
    assert plan.counters["applied"] == 2 and plan.counters["skipped"] > 100
    assert set(plan.tables["res_partner"].rewrites) == {"name", "email"}


def small(rule, **documents):
    return rulebook_from({"00_strategies": {"strategies": {rule if isinstance(rule, str) else rule["strategy"]: None}}, "10": {"my.model": {"fields": {"f": rule}}}, **documents})


def test_errors_are_loud(spark):
    data = {"my_model": spark.createDataFrame([(1, "a", 2)], "id int, f string, n int")}
    with pytest.raises(MaskError, match="no implementation"):
        mask(data, small("rotate_secret"))
    with pytest.raises(MaskError, match="no implementation"):
        mask(data, small("made_up"))
    book = small("drop")
    book.strategies.clear()
    with pytest.raises(MaskError, match="unknown strategy"):
        mask(data, book)
    number = {"my_model": data["my_model"].select("id", F.col("n").alias("f"))}
    with pytest.raises(MaskError, match="cannot mask my.model.f of type int"):
        mask(number, small("fake_email"))
    assert mask(number, small("partial_keep_last4")).dataset["my_model"].first()["f"] == "****"


def test_patterns_are_the_backstop(spark, rules):
    make = spark.createDataFrame
    data = {
        "account_move": make(
            [(1, "INV/1", "PO-1", "Real Works", "a@real.test", 7)],
            "id int, name string, ref string, invoice_partner_display_name string, invoice_source_email string, sum_display_name int",
        ),
        "x_random_doc": make([(1, "Real Works", "Real Works - child", "note")], "id int, some_display_name string, complete_name string, ref string"),
    }
    result = mask(data, rules, salt="s")
    assert result.plan.counters["pattern_applied"] == 2 and result.plan.counters["pattern_overlap"] == 1
    move = result.dataset["account_move"].first()
    assert move["name"] == "INV/1" and move["sum_display_name"] == 7
    assert move["invoice_partner_display_name"] == "lorem ipsu" and move["invoice_source_email"].endswith("@example.invalid")
    assert result.dataset["x_random_doc"].first() == (1, "lorem ipsu", "lorem ipsum dolor ", "note")


def test_scoped_replace_rewrites_listed_rows_only(spark, rules):
    rules.documents["55_module_metadata.yml"]["ir.ui.view"]["scoped_arch_replace"] = [{"view_key": "shop.slip"}]
    make = spark.createDataFrame
    data = {
        "res_company": make([(1, "Real Works"), (2, "Real Works - North")], "id int, name string"),
        "ir_module_module": make([(1, "shop", "Real Works")], "id int, name string, author string"),
        "ir_ui_view": make(
            [(1, "shop.slip", {"en": "by Real Works - North and Real Works", "Real Works": "x"}, "Real Works"), (2, "web.other", {"en": "Real Works"}, "old")],
            "id int, key string, arch_db map<string,string>, arch_prev string",
        ),
    }
    result = mask(data, rules, salt="s").dataset
    rules.documents["55_module_metadata.yml"]["ir.ui.view"]["scoped_arch_replace"] = []
    names = [row["name"] for row in result["res_company"].orderBy("id").collect()]
    views = {row["key"]: row for row in result["ir_ui_view"].collect()}
    assert views["shop.slip"]["arch_db"] == {"en": f"by {names[1]} and {names[0]}", "Real Works": "x"}
    assert views["web.other"]["arch_db"] == {"en": "Real Works"}
    assert all(view["arch_prev"] is None for view in views.values())
    assert result["ir_module_module"].first()["author"] is None


def test_nested_leaves(spark):
    schema = "id int, who struct<name:string,tags:array<string>>, items array<struct<note:string,n:int>>, extra map<string,string>"
    frame = spark.createDataFrame([(1, ("Ann", ["a", "b"]), [("secret", 1), (None, 2)], {"k": "vv"}), (2, None, None, None)], schema)
    book = rulebook_from(
        {
            "00_strategies": {"strategies": {"redact_freetext": None}},
            "10": {"t": {"fields": {c: "redact_freetext" for c in ("who.name", "who.tags", "items[].note", "extra")}}},
        }
    )
    result = mask({"t": frame}, book).dataset["t"]
    assert [f.dataType for f in result.schema.fields] == [f.dataType for f in frame.schema.fields]
    one, two = result.orderBy("id").collect()
    assert one["who"] == ("lor", ["l", "l"]) and one["items"] == [("lorem ", 1), (None, 2)] and one["extra"] == {"k": "lo"}
    assert two["who"] is two["items"] is two["extra"] is None


def test_one_projection_per_table(spark, rules):
    plan = mask({"hr_employee": live_system(spark)["hr_employee"]}, rules, salt="s").dataset["hr_employee"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 2 and "Aggregate" not in plan


def test_neutralize(spark):
    make = spark.createDataFrame
    data = {
        "ir_config_parameter": make([("mail.force.smtp.from", "1"), ("mail.force.smtp.from", None), ("mail.default.server", None), ("x", "y")], "key string, value string"),
        "ir_mail_server": make([(True, "h", "u", "p", "keep")], "active boolean, smtp_host string, smtp_user string, smtp_pass string, note string"),
        "payment_provider": make([("enabled",)], "state string"),
    }
    calm = neutralize(data)
    assert [tuple(r) for r in calm["ir_config_parameter"].collect()] == [
        ("mail.force.smtp.from", "0"), ("mail.force.smtp.from", None), ("mail.default.server", "smtp"), ("x", "y"),
    ]
    assert calm["ir_mail_server"].first() == (False, None, None, None, "keep")
    assert calm["payment_provider"].first() == ("disabled",)
    assert "fetchmail_server" not in calm


def test_shuffled_columns_do_not_stay_linked(spark):
    frame = spark.range(200).select("id", F.col("id").alias("a"), F.col("id").alias("b"))
    book = rulebook_from(
        {"00_strategies": {"strategies": {"shuffle_within_column": None}}, "10": {"t": {"fields": {c: "shuffle_within_column" for c in "ab"}}}}
    )
    rows = mask({"t": frame}, book, salt="s").dataset["t"].collect()
    assert sorted(r["a"] for r in rows) == sorted(r["b"] for r in rows) == list(range(200))
    assert sum(r["a"] == r["b"] for r in rows) < 10


def test_source_is_never_changed(spark, rules):
    source = live_system(spark)
    before = {name: frame.collect() for name, frame in source.items()}
    mask(source, rules, salt="s")
    assert before == {name: frame.collect() for name, frame in source.items()}
    assert isinstance(source["res_partner"].schema["image_1920"].dataType, T.BinaryType)


def vocabulary(*names):
    return {"strategies": dict.fromkeys(names)}


def test_nested_secrets_are_rotated(spark):
    frame = spark.sql("select 1 as id, named_struct('token', 'live', 'n', 1) as cfg, array(named_struct('k', 'old')) as l, map('a', named_struct('s', 'live2')) as m")
    fields = {"cfg.token": {"strategy": "rotate_secret", "rotate": "token"}, "l": {"strategy": "rotate_secret", "rotate": {"constant": "new"}}, "m{}.s": {"strategy": "rotate_secret", "rotate": {"constant": "x"}}}
    book = rulebook_from({"00_strategies": vocabulary("rotate_secret"), "1": {"t": {"fields": fields}}})
    result = mask({"t": frame}, book)
    row = result.dataset["t"].first()
    assert len(row.cfg.token) == 64 and row.cfg.n == 1 and row.l[0].k == "new" and row.m["a"].s == "x"
    assert result.plan.counters["rotate_applied"] == 3
    assert {r["value"] for r in result.plan.secret_values({"t": frame}).collect()} == {"live"}
    with pytest.raises(MaskError, match="only whole columns"):
        mask({"t": frame}, rulebook_from({"00_strategies": vocabulary("shuffle_within_column"), "1": {"t": {"fields": {"cfg.token": "shuffle_within_column"}}}}), salt="s")


def test_a_rule_on_a_subtree_holds_below_it_and_absent_ones_shield_nothing(spark):
    frame = spark.sql("select 1 as id, named_struct('parts', array(named_struct('name', 'Ann', 'n', 2))) as m, 'Bob' as name")
    documents = {"00_strategies": vocabulary("redact_freetext", "drop"), "1": {"t": {"fields": {"m.parts": "redact_freetext", "m.gone": "drop", "gone": "drop"}}, "column_patterns": [{"match": "(?P<x>name)$", "strategy": "drop"}]}}
    row = mask({"t": frame}, rulebook_from(documents)).dataset["t"].first()
    assert row.m.parts[0].name != "Ann" and row.m.parts[0].n == 2 and row["name"] is None
    documents["1"]["t"]["fields"] = {"m.other": "drop"}
    assert mask({"t": frame}, rulebook_from(documents)).dataset["t"].first().m.parts[0].name is None


def test_policies_without_their_columns_are_skipped(spark):
    frame = spark.createDataFrame([(1,)], "id int")
    book = rulebook_from({"00_strategies": vocabulary("drop"), "1": {"key_value_policies": [{"table": "t", "drop_regex": "x"}]}})
    result = mask({"t": frame}, book)
    assert result.plan.counters["policies_skipped"] == 1 and result.dataset["t"].collect() == [(1,)]


@pytest.mark.parametrize("strategy", ["generalize_numeric_band", "shuffle_within_column"])
def test_noise_and_orders_need_a_salt(spark, strategy):
    frame = spark.createDataFrame([(1, 2)], "id int, v int")
    book = rulebook_from({"00_strategies": vocabulary(strategy), "1": {"t": {"fields": {"v": strategy}}}})
    with pytest.raises(MaskError, match="secret salt"):
        mask({"t": frame}, book)
    mask({"t": frame}, book, salt="s").dataset["t"].collect()


def test_several_shuffles_share_their_scans_and_use_the_keys_before_masking(spark, tmp_path):
    rows = [(n % 40, f"a{n}", n * 1.5, None if n % 3 else n) for n in range(300)]
    spark.createDataFrame(rows, "id int, a string, b double, c int").write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    scans = []
    for columns in ("a", "ab", "abc"):
        fields = {"id": "drop", **dict.fromkeys(columns, "shuffle_within_column")}
        book = rulebook_from({"00_strategies": vocabulary("drop", "shuffle_within_column"), "1": {"t": {"fields": fields}}})
        out = mask({"t": frame}, book, salt="s").dataset["t"]
        got = out.collect()
        assert out.columns == frame.columns and len(got) == 300 and {r.id for r in got} == {None}
        for c in columns:
            assert sorted((r[c] for r in got), key=repr) == sorted((r["abc".index(c) + 1] for r in rows), key=repr)
        scans.append(out._jdf.queryExecution().optimizedPlan().toString().count("Relation ["))
    assert len(set(scans)) == 1
