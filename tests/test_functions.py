"""Scalar strategies against restatements in plain Python."""

from __future__ import annotations

import decimal
import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions import accounts, digest, generalize, identity, secrets, text
from maskloom.functions.words import FILLER

ibans = ["GB82WEST12345698765432", "BE68539007547034", "DE89370400440532013000", "FR1420041010050500013M02606", "NL91ABNA0417164300"]
vats = ["BE0123456789", "DE123456789", "fr12345678901", "12.345/67", "XY", "-", "n/a", "9"]
texts = ["x", "Call Jane at 555-0100.", "é" * 50, "a" * 200, "", "line\nbreak", "Ünï-cødé 漢字 🙂"]
everything = [*ibans, *vats, *texts, None]


def md5(value: str) -> str:
    return hashlib.md5(value.encode("utf-8")).hexdigest()


def digit_stream(value: str, n: int, tag: str) -> str:
    seed, out = md5(tag + value), ""
    while len(out) < n:
        seed = md5(seed + out)
        out += re.sub("[^0-9]", "", seed[:8])
    return out[:n]


def mod97(iban: str) -> int:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


def bank(value: str) -> str:
    return digit_stream(value, len(value), "bank:")


def vat(value: str) -> str:
    if re.match("[A-Za-z]{2}", value):
        out = value[:2].upper() + digit_stream(value, len(value) - 2, "vat:")
    else:
        seed, out = md5("vat:" + value), ""
        for char in value:
            if char in "0123456789":
                seed = md5(seed + out)
                out += re.sub("[^0-9]", "", seed)[:1]
            else:
                out += char
    return redacted(value) if out.upper() == value.upper() else out  # a change of case alone shows the value


def redacted(value: str) -> str:
    n = max(len(value), 1)
    return (FILLER * (n // len(FILLER) + 1))[:n]


def apply(spark, values, **columns):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = frame.select("i", "v", *[c.alias(n) for n, c in columns.items()]).collect()
    return {row["v"]: row for row in rows}


def test_account_numbers_equal_the_restatement(spark):
    rows = apply(
        spark,
        everything,
        bank=accounts.fake_bank_account(F.col("v")),
        vat=accounts.fake_vat(F.col("v")),
        iban=accounts.fake_iban(F.col("v")),
        red=generalize.redact_text(F.col("v")),
    )
    for value, row in rows.items():
        if value is None:
            assert row["bank"] is row["vat"] is row["iban"] is row["red"] is None
            continue
        assert row["bank"] == bank(value)
        assert row["vat"] == vat(value)
        assert row["red"] == redacted(value)
        if not re.fullmatch("[A-Za-z]{2}[0-9]{2}[0-9A-Za-z]+", value):
            assert row["iban"] == bank(value)


def test_fake_ibans_pass_the_checksum_and_keep_country_and_length(spark):
    rows = apply(spark, ibans, fake=accounts.fake_iban(F.col("v")))
    for value, row in rows.items():
        assert mod97(value) == 1 or value.startswith("NL")
        assert mod97(row["fake"]) == 1
        assert row["fake"][:2] == value[:2] and len(row["fake"]) == len(value) and row["fake"] != value


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=40), min_size=1, max_size=40, unique=True))
def test_random_values(spark, values):
    values = [v.encode("utf-8", "ignore").decode("utf-8") for v in values]
    values = list(dict.fromkeys(values))
    rows = apply(
        spark,
        values,
        bank=accounts.fake_bank_account(F.col("v")),
        vat=accounts.fake_vat(F.col("v")),
        iban=accounts.fake_iban(F.col("v")),
        red=generalize.redact_text(F.col("v")),
        email=identity.fake_email(F.col("v")),
        phone=identity.fake_phone(F.col("v")),
        zip=identity.fake_zip(F.col("v")),
        person=identity.fake_person_name(F.col("v")),
        last4=generalize.partial_keep_last4(F.col("v")),
        seed=digest.seed(F.col("v")),
    )
    for value in values:
        row = rows[value]
        assert row["bank"] == bank(value)
        assert row["vat"] == vat(value)
        assert row["red"] == redacted(value)
        assert len(row["iban"]) == len(value)
        assert re.fullmatch(r"[a-z0-9.]+@example\.invalid", row["email"])
        assert re.fullmatch(r"[1-9]\d\d-[1-9]\d\d-[1-9]\d{3} x[1-9]\d{2,3}", row["phone"])
        assert re.fullmatch(r"\d{5}", row["zip"])
        assert re.fullmatch(r"[A-Z][a-z]+ [A-Z][a-z]+", row["person"])
        assert row["last4"] == ("****" if len(value) <= 4 else "****" + value[-4:])
        assert row["seed"] == int(md5(value)[:15], 16)


def test_everything_passes_null_through(spark):
    v = F.lit(None).cast("string")
    functions = [
        identity.fake_person_name, identity.fake_company_name, identity.fake_email, identity.fake_phone,
        identity.fake_street_address, identity.fake_city, identity.fake_zip, accounts.fake_vat, accounts.fake_iban,
        accounts.fake_bank_account, generalize.redact_text, generalize.partial_keep_last4, text.extension,
    ]
    row = spark.range(1).select(*[f(v).alias(f"c{i}") for i, f in enumerate(functions)]).first()
    assert all(value is None for value in row)


def test_same_value_same_fake_whatever_the_partitioning(spark):
    frame = spark.range(500).select(F.concat(F.lit("user"), (F.col("id") % 50).cast("string")).alias("v"))
    fakes = {
        n: sorted(map(tuple, frame.repartition(n).select("v", identity.fake_email(F.col("v")), accounts.fake_vat(F.col("v"))).distinct().collect()))
        for n in (1, 4, 16)
    }
    assert len(fakes[1]) == 50
    assert fakes[1] == fakes[4] == fakes[16]


def test_salt_changes_the_fake_and_word_lists_can_be_replaced(spark):
    v = F.lit("Jane Roe")
    row = spark.range(1).select(
        digest.seed(v).alias("a"),
        digest.seed(v, salt="s").alias("b"),
        identity.fake_email(v, first=["Ána"], last=["O'Neil"]).alias("e"),
        identity.fake_email(v, first=["漢"], last=["字"]).alias("u"),
    ).first()
    assert row["a"] != row["b"]
    assert row["e"] == "na.oneil@example.invalid"
    assert row["u"] == "user@example.invalid"


@pytest.mark.parametrize(
    "dtype", [T.DoubleType(), T.FloatType(), T.IntegerType(), T.LongType(), T.DecimalType(12, 2), T.DecimalType(38, 10)]
)
def test_band_keeps_type_and_range(spark, dtype):
    frame = spark.range(1000).select(F.col("id"), (F.col("id") * 10 + 1000).cast(dtype).alias("v"))
    band = generalize.numeric_band(F.col("v"), F.col("id"), "v", dtype)
    out = frame.select("v", band.alias("b"))
    assert out.schema["b"].dataType == dtype
    rows = out.collect()
    assert all(0.849 <= float(b) / float(v) <= 1.151 for v, b in rows)
    assert sum(v != b for v, b in rows) > 990
    assert rows == out.collect()


def test_year_keeps_the_type(spark):
    frame = spark.sql("select date'1985-06-15' as d, timestamp'1985-06-15 10:00:00' as t, timestamp_ntz'1985-06-15 10:00:00' as n")
    out = frame.select(*[generalize.generalize_year(F.col(f.name), f.dataType).alias(f.name) for f in frame.schema.fields])
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in frame.schema.fields]
    assert all(str(value).startswith("1985-01-01") for value in out.first())


def test_fresh_values_differ_per_row_and_run(spark):
    frame = spark.range(100).select(secrets.fresh_secret().alias("s"), secrets.fresh_uuid().alias("u"))
    first = frame.collect()
    assert all(re.fullmatch("[0-9a-f]{64}", row["s"]) and len(row["u"]) == 36 for row in first)
    assert len({row["s"] for row in first}) == len({row["u"] for row in first}) == 100


def test_versions_and_extensions(spark):
    cases = {
        "16.14": (16, "16.14"), "18beta": (18, "18beta"), "9.6": (9, "9.6"), "": (0, ""), "abc": (0, "abc"),
        "19.0.1.3": (19, "19.0"), "saas~17.4.1": (0, "saas~17.4.1"), None: (0, ""),
    }
    rows = apply(spark, list(cases), major=text.major_version(F.col("v")), series=text.release_series(F.col("v")))
    assert {v: (r["major"], r["series"]) for v, r in rows.items()} == cases
    names = {"a.pdf": ".pdf", "a.tar.gz": ".gz", "none": "", ".hidden": ".hidden", "dot.": "", "a.b\n": ".b\n"}
    rows = apply(spark, list(names), ext=text.extension(F.col("v")))
    assert {v: r["ext"] for v, r in rows.items()} == names


def test_base_type_strips_modifiers(spark):
    rows = apply(spark, ["VARCHAR(20)", "numeric(15,8)", "Text", "character varying(255)"], t=text.base_type(F.col("v")))
    assert [rows[v]["t"] for v in rows] == ["varchar", "numeric", "text", "character varying"]


def test_band_stays_inside_the_type(spark):
    frame = spark.sql("select id, 120Y as b, -120Y as c, cast(99.99 as decimal(4,2)) as d, 9223372036854775807L as l, cast(null as tinyint) as n from range(60)")
    kinds = {c: frame.schema[c].dataType for c in "bcdln"}
    out = frame.select(*[generalize.numeric_band(F.col(c), F.col("id").cast("string"), c, kind, salt="s").alias(c) for c, kind in kinds.items()]).collect()
    assert {r.n for r in out} == {None} and max(r.b for r in out) == 127 and min(r.c for r in out) == -128
    assert max(r.d for r in out) == decimal.Decimal("99.99") and max(r.l for r in out) == 2**63 - 1 and len({r.b for r in out}) > 5


def test_tax_numbers_never_come_out_as_themselves_in_another_case(spark):
    assert spark.range(1).select(accounts.fake_vat(F.lit("xy"))).first()[0].lower() != "xy"
