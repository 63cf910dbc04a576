"""One query per operator, each over whole tables of the shop dataset."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions import accounts, digest, generalize, identity, secrets, text
from maskloom.operators import coverage, inventory, leakscan, policies, references, shuffle, verify
from maskloom.plans import mask as masking
from maskloom.plans import schema
from maskloom.plans.rulebook import rulebook_from
from maskloom.plans.strategies import register_strategy
from maskloom.session import scratch_dir
from maskloom.sources import bundle, tables
from maskloom.sources.snapshot import snapshot
from maskloom.streaming import gated
from maskloom.streaming.stream import mask_available
from maskloom.workload.rules import COMPOSITE_COLUMNS, STRATEGIES, TABLES, shop_rulebook

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def shop(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return tables.read_folder(spark, folder, names or TABLES)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return shop(spark, folder, name)[name]


def masked(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return masking.mask(shop(spark, folder, *names), shop_rulebook()).dataset


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- masking whole tables ---------------------------------------------------------------------


@query
def mask_customer(spark, folder):
    return masked(spark, folder, "customer")["customer"]


@query
def mask_supplier(spark, folder):
    return masked(spark, folder, "supplier")["supplier"]


@query
def mask_orders(spark, folder):
    orders = masked(spark, folder, "orders")["orders"]
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query
def mask_lineitem(spark, folder):
    items = masked(spark, folder, "lineitem")["lineitem"]
    return items.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query
def mask_dataset(spark, folder):
    """Every table through the whole plan; row counts and a fingerprint of the masked text."""
    columns = {
        "customer": ["c_name", "c_mktsegment"],
        "supplier": ["s_name"],
        "nation": ["n_name"],
        "orders": ["o_orderpriority"],
        "part": ["p_name", "p_brand"],
        "region": ["r_name"],
        "documents": ["text"],
        "conversations": ["text"],
        "events": ["props"],
        "lineitem": ["l_returnflag", "year(l_shipdate)", "cast(floor(l_extendedprice) as bigint)"],
        "pages": ["url", "html"],
        "benchmark": ["text"],
        "labels": ["doc_id", "quality", "toxic"],
        "embeddings": ["vec_id", "label"],
    }
    result = masked(spark, folder, *columns)
    return union(
        [
            result[name].agg(
                F.lit(name).alias("table"),
                F.count(F.lit(1)).alias("rows"),
                F.sum(digest.seed(F.concat_ws("|", *[F.coalesce(F.expr(c).cast("string"), F.lit("-")) for c in names])) % 1000003).alias("fingerprint"),
            )
            for name, names in columns.items()
        ]
    )


@query
def mask_counters(spark, folder):
    """What the plan applied, skipped and kept, beside the rows it will touch."""
    data = shop(spark, folder)
    counters = masking.build_plan(data, shop_rulebook()).counters
    rows = bundle.row_counts(data).agg(F.sum("rows").alias("rows"))
    return rows.select("rows", *[F.lit(value).cast("bigint").alias(name) for name, value in sorted(counters.items())])


@query
def redact_documents(spark, folder):
    return masked(spark, folder, "documents")["documents"]


@query
def redact_conversations(spark, folder):
    """No rule names this column: the pattern backstop redacts it."""
    return masked(spark, folder, "conversations")["conversations"]


@query
def mask_nested(spark, folder):
    """A rule that addresses one leaf inside an array of structs."""
    turns = table(spark, folder, "conversations")
    nested = turns.select(
        "conv_id", "turn", F.struct(F.col("role"), F.array(F.struct(F.col("text").alias("body"), F.col("turn").alias("at"))).alias("parts")).alias("message")
    )
    book = rulebook_from(
        {"00_strategies": STRATEGIES, "10": {"chat": {"fields": {"message.parts[].body": "redact_freetext"}}}}
    )
    result = masking.mask({"chat": nested}, book).dataset["chat"]
    part = F.get("message.parts", F.lit(0))
    return result.select("conv_id", "turn", F.col("message.role").alias("role"), part["body"].alias("body"), part["at"].alias("at"))


@query
def custom_strategy(spark, folder):
    """A user strategy registered beside the built-in ones."""
    register_strategy("initials", lambda t: F.concat(F.upper(F.substring(t.value, 1, 1)), F.lit(".")))
    book = rulebook_from(
        {"00_strategies": {"strategies": {"initials": None}}, "10": {"part": {"fields": {"p_name": "initials"}}}}
    )
    return masking.mask(shop(spark, folder, "part"), book).dataset["part"].select("p_partkey", "p_name")


# --- single strategies ------------------------------------------------------------------------


@query
def seed_values(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", digest.seed(F.col("c_name")).alias("seed"))


@query
def seeded_draw(spark, folder):
    words = ["red", "green", "blue", "white", "black"]
    return table(spark, folder, "part").select(
        "p_partkey", digest.draw(words, digest.digest(F.col("p_name"), "color:")).alias("color")
    )


@query
def fake_contact_fields(spark, folder):
    name = F.col("c_name")
    return table(spark, folder, "customer").select(
        "c_custkey",
        identity.fake_email(name).alias("email"),
        identity.fake_email(F.lower(F.trim(F.concat(F.lit(" "), name)))).alias("email_normalized"),
        identity.fake_phone(name).alias("phone"),
        identity.fake_street_address(name).alias("street"),
        identity.fake_city(name).alias("city"),
        identity.fake_zip(name).alias("zip"),
    )


@query
def fake_names_salted(spark, folder):
    name = F.col("s_name")
    return table(spark, folder, "supplier").select(
        "s_suppkey",
        identity.fake_person_name(name, salt="pepper").alias("person"),
        identity.fake_company_name(name, salt="pepper").alias("company"),
    )


@query
def fake_bank_accounts(spark, folder):
    number = F.concat(F.lit("12-"), F.lpad(F.col("c_custkey").cast("string"), 9, "7"))
    return table(spark, folder, "customer").select(
        "c_custkey", number.alias("account"), accounts.fake_bank_account(number).alias("fake")
    )


def iban_like() -> Column:
    """Country code, two digits and an account part; every seventh is not an IBAN at all."""
    country = F.get(F.array(*[F.lit(c) for c in ("GB", "be", "DE", "FR")]), (F.col("c_custkey") % 4).cast("int"))
    account = F.lpad(F.col("c_custkey").cast("string"), 16, "30")
    return F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("acc "), account)).otherwise(
        F.concat(country, F.lit("29"), account, F.upper(F.substring("c_mktsegment", 1, 2)))
    )


@query
def fake_ibans(spark, folder):
    data = table(spark, folder, "customer").withColumn("iban", iban_like())
    return data.select("c_custkey", "iban", accounts.fake_iban(F.col("iban")).alias("fake"))


@query
def fake_vat_numbers(spark, folder):
    """Prefixed, separated, bare and digit-free tax numbers."""
    key = F.col("c_custkey").cast("string")
    vat = (
        F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("be0"), F.lpad(key, 9, "4")))
        .when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("12."), F.lpad(key, 6, "3"), F.lit("/"), F.lit("7")))
        .when(F.col("c_custkey") % 4 == 2, F.concat(F.lit("FR "), key, F.lit("-9")))
        .otherwise(F.lit("-/-"))
    )
    data = table(spark, folder, "customer").withColumn("vat", vat)
    return data.select("c_custkey", "vat", accounts.fake_vat(F.col("vat")).alias("fake"))


@query
def partial_last4(spark, folder):
    """Text, and a number shown as text; short values show nothing."""
    return table(spark, folder, "orders").select(
        "o_orderkey",
        generalize.partial_keep_last4(F.col("o_orderpriority")).alias("priority"),
        generalize.partial_keep_last4(F.col("o_custkey")).alias("customer"),
    )


@query
def year_band_orders(spark, folder):
    orders = table(spark, folder, "orders")
    when = orders.schema["o_orderdate"].dataType
    key = F.col("o_orderkey").cast("string")
    return orders.select(
        "o_orderkey",
        generalize.generalize_year(F.col("o_orderdate"), when).cast("date").alias("order_year"),
        generalize.generalize_year(F.col("o_orderdate").cast("date"), T.DateType()).alias("order_year_date"),
        generalize.numeric_band(F.col("o_totalprice"), key, "o_totalprice", T.DoubleType()).alias("total_price"),
        generalize.numeric_band(F.col("o_custkey"), key, "o_custkey", T.LongType()).alias("rounded"),
    )


@query
def drop_columns(spark, folder):
    """Typed NULLs; the scan reads none of the dropped columns."""
    pages = tables.without_content(table(spark, folder, "pages"), ["html"])
    binary = F.lit(None).cast("binary")
    return pages.select("page_id", "html", F.hex(binary).alias("preview"))


@query
def force_constants(spark, folder):
    update = policies.Update("orders", {"o_orderstatus": "X", "o_totalprice": 0})
    result = policies.neutralize(shop(spark, folder, "orders"), [update])["orders"]
    return result.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query
def fresh_tokens(spark, folder):
    """Random by design: only the form and the change are compared."""
    book = rulebook_from(
        {
            "00_strategies": STRATEGIES,
            "10": {
                "events": {
                    "fields": {
                        "props": {"strategy": "rotate_secret", "rotate": "token"},
                        "event_type": {"strategy": "rotate_secret", "rotate": {"constant": "off"}},
                    }
                }
            },
        }
    )
    events = table(spark, folder, "events").withColumn("original", F.col("props"))
    rotated = masking.mask({"events": events}, book).dataset["events"]
    return rotated.select(
        "event_id",
        "event_type",
        F.col("props").rlike("^[0-9a-f]{64}$").alias("is_token"),
        (F.col("props") != F.col("original")).alias("changed"),
        secrets.fresh_uuid().rlike("^[0-9a-f-]{36}$").alias("is_uuid"),
    )


# --- policies ---------------------------------------------------------------------------------


@query
def key_secret_drop(spark, folder):
    """Values masked by the key of their row; a named rotation beats the regex drop."""
    return masked(spark, folder, "events")["events"].select("event_id", "event_type", "props")


@query
def key_secret_drop_required(spark, folder):
    """The same where the value column admits no NULL."""
    policy = policies.KeyValuePolicy("events", "event_type", "props", "^(click|view)$", nullable=False)
    return policy.apply(table(spark, folder, "events")).select("event_id", "props")


@query
def page_content_policy(spark, folder):
    """Content dropped everywhere, names scrubbed for one parent type, another left out."""
    policy = policies.ContentPolicy(
        "pages", ["html", "checksum"], ["https"], ["ftp", "http"], "scheme", "url", "page_id", "page_"
    )
    pages = table(spark, folder, "pages").withColumn("scheme", F.substring_index("url", ":", 1))
    pages = pages.withColumn("scheme", F.when(F.col("page_id") % 9 == 0, F.lit("http-old")).otherwise(F.col("scheme")))
    return policy.apply(pages)


@query
def content_policy_metrics(spark, folder):
    policy = policies.ContentPolicy(
        "pages", ["html", "index_content"], ["https"], [], "scheme", "url", "page_id", "page_"
    )
    pages = table(spark, folder, "pages").withColumn("scheme", F.substring_index("url", ":", 1))
    pages = pages.withColumn("index_content", F.when(F.col("page_id") % 3 == 0, F.col("html")))
    return pages.agg(*policy.metrics(pages))


@query
def parent_semi_join(spark, folder):
    """Orders of the customers in one segment: the parents come from a table."""
    data = shop(spark, folder, "customer", "orders")
    parents = data["customer"].where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    listed = policies.with_parents(data["orders"], "o_custkey", parents)
    return policies.with_parents(listed, "o_orderstatus", ["F", "O"]).select("o_orderkey", "o_custkey", "o_orderstatus")


@query
def neutralize_preset(spark, folder):
    """The preset switches on tables shaped like a live system, filled from the shop."""
    data = shop(spark, folder, "events", "supplier")
    key = (
        F.when(F.col("event_type") == "signup", F.lit("mail.force.smtp.from"))
        .when(F.col("event_type") == "view", F.lit("mail.default.server"))
        .otherwise(F.col("event_type"))
    )
    live = {
        "ir_config_parameter": data["events"].select(
            F.col("event_id").alias("id"), key.alias("key"), F.when(F.col("event_id") % 5 != 0, F.col("props")).alias("value")
        ),
        "payment_provider": data["supplier"].select(F.col("s_suppkey").alias("id"), F.lit("enabled").alias("state")),
        "ir_mail_server": data["supplier"].select(
            F.col("s_suppkey").alias("id"), F.lit(True).alias("active"), F.col("s_name").alias("smtp_host"), F.col("s_name").alias("smtp_pass")
        ),
    }
    calm = policies.neutralize(live)
    return union(
        [
            calm["ir_config_parameter"].select(F.lit("parameter").alias("kind"), "id", "key", "value"),
            calm["payment_provider"].select(F.lit("provider").alias("kind"), "id", F.lit("state").alias("key"), F.col("state").alias("value")),
            calm["ir_mail_server"].select(
                F.lit("server").alias("kind"), "id", F.col("active").cast("string").alias("key"), F.coalesce("smtp_host", "smtp_pass").alias("value")
            ),
        ]
    )


def nation_pairs(spark, folder) -> DataFrame:
    before = shop(spark, folder, "nation")
    after = masking.mask(before, shop_rulebook()).dataset
    return policies.name_pairs(before["nation"], after["nation"], ["n_nationkey"], "n_name")


def customer_notes(spark, folder) -> DataFrame:
    """A note per customer that spells out two nations, one name often a prefix of another."""
    note = F.concat(
        F.lit("from NATION_"), F.col("c_nationkey").cast("string"),
        F.lit(" via NATION_"), ((F.col("c_nationkey") * 7 + 3) % 25).cast("string"), F.lit("0, not NATION"),
    )
    return table(spark, folder, "customer").select("c_custkey", "c_mktsegment", note.alias("note"))


@query
def name_changes(spark, folder):
    return nation_pairs(spark, folder)


@query
def scoped_replace(spark, folder):
    listed = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    return policies.scoped_replace(customer_notes(spark, folder), "note", listed, nation_pairs(spark, folder))


@query
def scoped_replace_ranges(spark, folder):
    """More pairs than one plan row should hold: ordered ranges give the same text."""
    listed = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    return policies.scoped_replace(
        customer_notes(spark, folder), "note", listed, nation_pairs(spark, folder), max_pairs=9
    )


@query
def scoped_replace_nested(spark, folder):
    """Localised text in a map, in JSON of known shape and in JSON of any shape."""
    notes = customer_notes(spark, folder)
    texts = F.create_map(F.lit("en_US"), F.col("note"), F.lit("NATION_1"), F.upper("note"))
    as_json = F.to_json(F.struct(F.col("note").alias("NATION_2"), F.array("note").alias("list"), F.col("c_custkey")))
    data = notes.select("c_custkey", "c_mktsegment", texts.alias("texts"), as_json.alias("body"), as_json.alias("known"))
    pairs = nation_pairs(spark, folder)
    everywhere = F.col("c_mktsegment") != "BUILDING"
    data = policies.scoped_replace(data, "texts", everywhere, pairs)
    data = policies.scoped_replace(data, "body", everywhere, pairs, json_text=True)
    known = T.StructType.fromDDL("NATION_2 string, list array<string>, c_custkey bigint")
    data = data.select("*", policies.pair_array(pairs).scalar().alias("pairs"))
    rewritten = text.rewrite_json(F.col("known"), known, lambda leaf: text.replace_each(leaf, F.col("pairs")))
    return data.select(
        "c_custkey",
        F.col("texts")["en_US"].alias("en_us"),
        F.col("texts")["NATION_1"].alias("upper"),
        F.get_json_object("body", "$.NATION_2").alias("body_note"),
        F.get_json_object("body", "$.list[0]").alias("body_item"),
        F.get_json_object(F.when(everywhere, rewritten).otherwise(F.col("known")), "$.list[0]").alias("known_item"),
    )


# --- permutation ------------------------------------------------------------------------------


@query
def shuffle_segments(spark, folder):
    return shuffle.shuffle_column(table(spark, folder, "customer"), "c_mktsegment", ["c_custkey"]).select(
        "c_custkey", "c_mktsegment"
    )


@query
def shuffle_orders(spark, folder):
    """A composite key and NULLs that travel along."""
    orders = table(spark, folder, "orders").withColumn(
        "o_orderpriority", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    )
    return shuffle.shuffle_column(orders, "o_orderpriority", ["o_orderkey", "o_custkey"], salt="s1").select(
        "o_orderkey", "o_orderpriority"
    )


@query
def shuffle_within_group(spark, folder):
    return shuffle.shuffle_column(
        table(spark, folder, "customer"), "c_name", ["c_custkey"], within=["c_mktsegment"], bucket_digits=2
    ).select("c_custkey", "c_mktsegment", "c_name")


@query
def shuffle_deranged(spark, folder):
    """No row keeps its value; NULL is one of the values."""
    orders = table(spark, folder, "orders").withColumn("o_orderpriority", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")))
    return shuffle.derange_column(orders, "o_orderpriority", ["o_orderkey", "o_custkey"], salt="d1").select("o_orderkey", "o_orderpriority")


@query
def derangement_report(spark, folder):
    """Rows that kept their value, beside those that had to."""
    data = shop(spark, folder)
    columns = {"lineitem": ["l_returnflag", "l_linestatus"], "orders": ["o_orderpriority", "o_orderstatus", "o_custkey"], "customer": ["c_mktsegment"], "events": ["event_type"]}
    keys = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "customer": ["c_custkey"], "events": ["event_id"]}
    parts = []
    for name, listed in columns.items():
        for column in listed:
            frame = data[name].select(*keys[name], column, F.col(column).alias("before"))
            rows, largest, unavoidable = shuffle.derangement_bounds(frame, column)
            after = shuffle.derange_column(frame, column, keys[name], salt="d2")
            parts.append(
                after.agg(
                    F.lit(f"{name}.{column}").alias("column"), F.count(F.lit(1)).alias("rows"), F.lit(largest).cast("bigint").alias("largest"), F.lit(unavoidable).cast("bigint").alias("unavoidable"),
                    F.count_if(F.col("before").eqNullSafe(F.col(column))).alias("unchanged"), F.sum(digest.seed(F.col(column)) % 1000003).alias("fingerprint"),
                )
            )
    return union(parts)


@query
def keyed_position(spark, folder):
    return shuffle.keyed_position(table(spark, folder, "orders"), ["o_orderkey"]).select("o_orderkey", "position")


# --- leak scan --------------------------------------------------------------------------------


def text_tables(spark, folder) -> DataFrame:
    return leakscan.cells(shop(spark, folder, "documents", "conversations", "pages"))


@query
def cell_unpivot(spark, folder):
    """Every cell of every table as text, counted; characters of the text columns."""
    cells = leakscan.cells(shop(spark, folder))
    is_text = F.col("column").isin("text", "html", "url", "props", "c_name", "s_name", "lang", "source", "role")
    return cells.groupBy("table", "column").agg(
        F.count(F.lit(1)).alias("cells"), F.sum(F.when(is_text, F.length("value"))).alias("chars")
    )


@query
def original_values(spark, folder):
    wanted = [("customer", "c_name"), ("supplier", "s_name"), ("nation", "n_name"), ("orders", "o_orderpriority"), ("absent", "x")]
    return leakscan.original_values(shop(spark, folder, "customer", "supplier", "nation", "orders"), wanted)


@query
def leak_scan_passages(spark, folder):
    passages = table(spark, folder, "benchmark").select("text")
    return leakscan.find_values(text_tables(spark, folder), passages)


@query
def leak_scan_passages_by_join(spark, folder):
    """The same scan with the automaton budget at zero: the join form."""
    passages = table(spark, folder, "benchmark").select("text")
    return leakscan.find_values(text_tables(spark, folder), passages, max_needles=0)


def half_masked(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Masked customers and orders, with a note on each order that still carries the real name."""
    data = shop(spark, folder, "customer", "orders")
    result = masking.mask(data, shop_rulebook()).dataset
    note = F.concat(F.lit("call Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit("."))
    result["orders"] = result["orders"].withColumn("note", F.when(F.col("o_orderstatus") == "F", note))
    return leakscan.cells(result), data["customer"].select("c_name")


@query
def leak_scan_names(spark, folder):
    cells, names = half_masked(spark, folder)
    return leakscan.find_values(cells, names)


@query
def leak_scan_names_by_join(spark, folder):
    """All needles share a long prefix, the case in which a plain gram join would go quadratic."""
    cells, names = half_masked(spark, folder)
    return leakscan.find_values(cells, names, max_needles=0)


@query
def leak_scan_short_values(spark, folder):
    """Values below the minimum length count only as whole cells."""
    data = shop(spark, folder, "events", "documents", "nation")
    needles = data["events"].select(F.col("event_type").alias("v")).union(data["documents"].select("source")).union(
        data["nation"].select("n_name")
    )
    return leakscan.find_values(leakscan.cells(data), needles, min_length=6)


@query
def leak_scan_clean(spark, folder):
    """A fully masked dataset: names hit nothing, a canary row proves the scan works."""
    data = shop(spark, folder, "customer", "supplier", "documents")
    result = masking.mask(data, shop_rulebook()).dataset
    names = leakscan.original_values(data, [("customer", "c_name"), ("supplier", "s_name")]).select("value")
    needles = names.union(spark.range(1).select(F.lit(leakscan.CANARY)))
    return leakscan.find_values(leakscan.with_canary(spark, leakscan.cells(result)), needles)


# --- coverage ---------------------------------------------------------------------------------


def column_cells(data: dict[str, DataFrame]) -> DataFrame:
    """``table, column, cells``: non-null cells of every column, one pass per table."""
    parts = []
    for name, frame in data.items():
        counts = frame.agg(*[F.count(F.col(c)).alias(c) for c in frame.columns])
        parts.append(counts.unpivot([], list(counts.columns), "column", "cells").select(F.lit(name).alias("table"), "column", "cells"))
    return union(parts)


SUBJECTS = ("customer",)


def coverage_report(spark, folder) -> DataFrame:
    data = shop(spark, folder)
    book = shop_rulebook()
    columns = schema.scan_schema(spark, data, book.refs, SUBJECTS)
    return coverage.analyze(columns, book, ignore_models=["labels"]).join(column_cells(data), ["table", "column"])


@query
def schema_scan(spark, folder):
    data = shop(spark, folder)
    columns = schema.scan_schema(spark, data, shop_rulebook().refs, SUBJECTS)
    return columns.join(column_cells(data), ["table", "column"]).select("table", "column", "shape", "fk_target", "ordinal", "cells")


@query
def coverage_scan(spark, folder):
    return coverage_report(spark, folder).select("table", "column", "shape", "outcome", "strategy", "cells")


@query
def coverage_findings(spark, folder):
    return coverage.findings(coverage_report(spark, folder)).select("table", "column", "outcome", "reason", "cells")


@query
def coverage_summary(spark, folder):
    report = coverage_report(spark, folder)
    flagged = F.col("outcome").isin(coverage.UNDECLARED, coverage.UNCOVERED)
    return report.agg(*coverage.counters(), F.sum("cells").alias("cells"), F.sum(F.when(flagged, F.col("cells"))).alias("flagged_cells"))


@query
def coverage_by_pattern(spark, folder):
    return coverage.pattern_covered(coverage_report(spark, folder)).select("table", "column", "strategy", "reason", "cells")


@query
def undeclared_tables(spark, folder):
    report = coverage_report(spark, folder)
    return coverage.undeclared_models(report).join(
        report.where(F.col("outcome") == coverage.UNDECLARED).groupBy("model").agg(F.sum("cells").alias("cells")), "model"
    )


@query
def uncovered_columns(spark, folder):
    data = shop(spark, folder)
    columns = schema.scan_schema(spark, data)
    return coverage.uncovered(columns, shop_rulebook().rules_frame(spark)).join(column_cells(data), ["table", "column"]).select(
        "table", "column", "cells"
    )


@query
def pattern_first_match(spark, folder):
    """All patterns that admit a column, the one that wins, and whether a rule overrides it."""
    data = shop(spark, folder)
    book = shop_rulebook()
    columns = schema.scan_schema(spark, data)
    matches = columns.withColumn("p", F.explode(coverage.matching_patterns(F.col("column"), F.col("shape"), book.patterns)))
    winner = matches.groupBy("table", "column").agg(
        F.min_by("p.strategy", "p.ordinal").alias("strategy"), F.count(F.lit(1)).alias("matches")
    )
    rules = book.rules_frame(spark).select("table", "column", F.lit(True).alias("overridden"))
    return (
        winner.join(F.broadcast(rules), ["table", "column"], "left")
        .join(column_cells(data), ["table", "column"])
        .select("table", "column", "strategy", "matches", F.coalesce("overridden", F.lit(False)).alias("overridden"), "cells")
    )


@query
def rule_usage(spark, folder):
    """Rules per strategy, how many find a column, and the cells they handle."""
    rules = shop_rulebook().rules_frame(spark)
    found = rules.join(column_cells(shop(spark, folder)), ["table", "column"], "left")
    return found.groupBy("strategy").agg(
        F.count(F.lit(1)).alias("rules"), F.count("cells").alias("present"), F.coalesce(F.sum("cells"), F.lit(0)).alias("cells")
    )


@query
def snapshot_diff(spark, folder):
    """Columns added, dropped and retyped between two states of the dataset."""
    before = shop(spark, folder, "customer", "orders", "pages")
    after = dict(before)
    after["customer"] = before["customer"].drop("c_acctbal").withColumn("c_email", identity.fake_email(F.col("c_name")))
    after["orders"] = before["orders"].withColumn("o_custkey", F.col("o_custkey").cast("string"))
    changes = coverage.diff(schema.scan_schema(spark, before), schema.scan_schema(spark, after))
    old, new = column_cells(before), column_cells(after)
    cells = old.withColumnRenamed("cells", "old_cells").join(new.withColumnRenamed("cells", "new_cells"), ["table", "column"], "full_outer")
    return changes.join(cells, ["table", "column"]).select("table", "column", "change", "shape", "old_cells", "new_cells")


@query
def resolve_references(spark, folder):
    """Declared constraints, composite ones by position, attached to the columns they belong to."""
    data = shop(spark, folder)
    constraints = spark.createDataFrame(
        [
            ("orders", ["o_custkey"], "customer", ["c_custkey"]),
            ("lineitem", ["l_partkey", "l_suppkey"], "partsupp", ["ps_partkey", "ps_suppkey"]),
            ("customer", ["c_nationkey"], "nation", ["n_nationkey"]),
        ],
        "table string, columns array<string>, ref_table string, ref_columns array<string>",
    )
    columns = schema.resolve_references(schema.scan_schema(spark, data).drop("shape"), constraints)
    return (
        schema.with_shape(columns, SUBJECTS)
        .where(F.col("fk_target").isNotNull())
        .join(column_cells(data), ["table", "column"])
        .select("table", "column", "fk_target", "shape", "cells")
    )


@query
def infer_references(spark, folder):
    """Every whole-number and text column of every table against every other."""
    return references.infer_references(shop(spark, folder))


@query
def infer_composite_references(spark, folder):
    """Order lines refer to the lots they come from by two columns, and to the numbered lots by three."""
    lines = shop(spark, folder, "lineitem")["lineitem"]
    data = {
        "lineitem": lines,
        "lots": lines.select(F.col("l_partkey").alias("lot_part"), F.col("l_suppkey").alias("lot_supplier")).distinct(),
        "numbered_lots": lines.select(
            F.col("l_suppkey").alias("numbered_supplier"), F.col("l_partkey").alias("numbered_part"), F.col("l_linenumber").alias("number")
        ).distinct(),
    }
    # Every level reads the lots twice, so they are made once.
    run = scratch_dir(spark, "lots")
    for name in ("lots", "numbered_lots"):
        data[name].write.parquet(f"{run}/{name}")
        data[name] = spark.read.parquet(f"{run}/{name}")
    found = references.infer_composite_references(data, COMPOSITE_COLUMNS)
    return found.withColumns({c: F.array_join(c, ",") for c in ("child_columns", "parent_columns")})


# --- verification -----------------------------------------------------------------------------


@query
def expectations(spark, folder):
    """Checks on masked tables, one of which fails, and one on a table that is missing."""
    data = masked(spark, folder, "events", "orders", "customer")
    checks = [
        verify.Expectation("events", "purchase_props_dropped", (F.col("event_type") == "purchase") & F.col("props").isNotNull(), columns=("props",)),
        verify.Expectation("events", "click_props_dropped", (F.col("event_type") == "click") & F.col("props").isNotNull()),
        verify.Expectation("events", "has_rotated_error", at_least_one=(F.col("event_type") == "error") & (F.col("props") == "{}")),
        verify.Expectation("orders", "priority_masked", ~F.col("o_orderpriority").startswith("****")),
        verify.Expectation("customer", "no_customer_number", F.col("c_name").contains("#")),
        verify.Expectation("payment_token", "provider_ref_null", F.lit(True)),
        verify.Expectation("ir_config_parameter", "database_secret_nonnull", required=True),
    ]
    return verify.run_expectations(spark, data, checks)


@query
def unchanged_secrets(spark, folder):
    before = table(spark, folder, "customer").select("c_name", "c_mktsegment")
    shuffled = shuffle.shuffle_column(table(spark, folder, "customer"), "c_mktsegment", ["c_custkey"])
    return verify.unchanged_secrets(before, shuffled.select("c_name", "c_mktsegment"), "c_name", "c_mktsegment")


def name_on_orders(orders: DataFrame) -> DataFrame:
    return orders.select(F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("name"))


@query
def join_consistency(spark, folder):
    """Orders find their customer by name before and after both sides are masked."""
    data = shop(spark, folder, "customer", "orders")
    left, right = name_on_orders(data["orders"]), data["customer"].select(F.col("c_name").alias("name"))
    fake = identity.fake_email(F.col("name")).alias("name")
    return verify.join_consistency((left, right), (left.select(fake), right.select(fake)), "name", "name")


@query
def mapping_conflicts(spark, folder):
    """One original, two fakes: found where one table was masked with another salt."""
    data = shop(spark, folder, "customer", "orders")
    names = name_on_orders(data["orders"])
    same = names.select(F.col("name").alias("original"), identity.fake_person_name(F.col("name")).alias("masked"))
    other = data["customer"].select(
        F.col("c_name").alias("original"), identity.fake_person_name(F.col("c_name"), salt="x").alias("masked")
    )
    return verify.mapping_conflicts(same.unionByName(other))


@query
def fake_collisions(spark, folder):
    pairs = table(spark, folder, "customer").select(
        F.col("c_name").alias("original"), identity.fake_city(F.col("c_name")).alias("masked")
    )
    return verify.collisions(pairs)


@query
def fake_properties(spark, folder):
    name, account = F.col("c_name"), iban_like()
    pairs = table(spark, folder, "customer").select(
        name.alias("name"),
        account.alias("iban"),
        identity.fake_email(name).alias("email"),
        identity.fake_phone(name).alias("phone"),
        generalize.redact_text(name).alias("redacted"),
        accounts.fake_iban(account).alias("fake_iban"),
        accounts.fake_bank_account(name).alias("bank"),
    )
    digits = F.concat(F.substr("fake_iban", F.lit(5)), F.substring("fake_iban", 1, 4))
    numeric = F.regexp_replace(digits, "[A-Z]", "")
    return verify.property_report(
        pairs,
        {
            "email_domain": F.col("email").rlike(r"^[a-z0-9.]+@example\.invalid$"),
            "email_changed": F.col("email") != F.col("name"),
            "phone_form": F.col("phone").rlike(r"^\d{3}-\d{3}-\d{4} x\d{3,4}$"),
            "redacted_length": F.length("redacted") == F.length("name"),
            "redacted_changed": F.col("redacted") != F.col("name"),
            "iban_length": F.length("fake_iban") == F.length("iban"),
            "iban_country": F.upper(F.substring("iban", 1, 2)) == F.substring("fake_iban", 1, 2),
            "iban_has_digits": F.length(numeric) > 0,
            "bank_digits": F.col("bank").rlike(r"^\d{18}$"),
            "bank_changed": F.col("bank") != F.col("name"),
        },
    )


# --- inventory --------------------------------------------------------------------------------


def modules(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Parts as installed modules, order lines as the code found on a search path."""
    data = shop(spark, folder, "part", "lineitem")
    # a part counts as found where an order line names it
    version = F.concat_ws(".", F.col("p_size").cast("string"), F.lit("0"), (F.col("p_partkey") % 7).cast("string"))
    installed = data["part"].select(
        F.concat(F.lit("mod_"), F.col("p_partkey").cast("string")).alias("name"),
        F.when(F.col("p_partkey") % 10 == 3, F.concat(F.lit("saas~"), version)).when(F.col("p_partkey") % 10 != 4, version).alias("latest_version"),
        F.when(F.col("p_size") > 5, "installed").otherwise("uninstalled").alias("state"),
    )
    found = data["lineitem"].select(
        F.col("l_linenumber").alias("path_ordinal"),
        F.concat(F.lit("/code/"), F.col("l_suppkey").cast("string")).alias("path"),
        F.concat(F.lit("mod_"), F.col("l_partkey").cast("string")).alias("name"),
        F.col("l_quantity").cast("int").cast("string").alias("version"),
    )
    return installed, found


@query
def installed_modules(spark, folder):
    return inventory.installed_modules(modules(spark, folder)[0])


@query
def base_version(spark, folder):
    return inventory.base_version(modules(spark, folder)[0], "mod_21")


@query
def module_versions(spark, folder):
    installed, _ = modules(spark, folder)
    return installed.select(
        "name", text.major_version(F.col("latest_version")).alias("major"), text.release_series(F.col("latest_version")).alias("series")
    )


@query
def module_first_found(spark, folder):
    return inventory.first_found(modules(spark, folder)[1])


@query
def module_reconcile(spark, folder):
    installed, found = modules(spark, folder)
    return inventory.reconcile(inventory.installed_modules(installed), found)


@query
def module_missing(spark, folder):
    installed, found = modules(spark, folder)
    return inventory.missing_modules(inventory.installed_modules(installed).select("name"), found)


@query
def module_undeclared(spark, folder):
    installed, found = modules(spark, folder)
    return inventory.undeclared_modules(installed, found)


@query
def search_path(spark, folder):
    """Paths once each, at their first position."""
    items = table(spark, folder, "lineitem").select(
        F.concat(F.lit("/code/"), F.col("l_suppkey").cast("string")).alias("path"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"),
    )
    return inventory.ordered_distinct(items, "path", "ordinal")


# --- bundles and streams ----------------------------------------------------------------------


@query
def manifest_counts(spark, folder):
    return bundle.row_counts(shop(spark, folder))


@query
def manifest_schema(spark, folder):
    """Structure hash and size of every table."""
    data = shop(spark, folder)
    return union(
        [
            frame.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"), F.lit(bundle.table_schema_hash(frame)).alias("schema_hash"), "rows"
            )
            for name, frame in data.items()
        ]
    )


#: A column of each table whose values no rule changes.
TABLE_KEYS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id",
    "documents": "doc_id", "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id", "labels": "doc_id", "conversations": "conv_id",
}


@query
def bundle_publish(spark, folder):
    """Mask, stage, check, publish, and read the published tables back."""
    data = shop(spark, folder)
    promise = verify.Expectation("orders", "priority_masked", ~F.col("o_orderpriority").startswith("****"))
    target = f"{scratch_dir(spark, 'bundle')}/published"
    snapshot(spark, data, shop_rulebook(), target, [folder], [promise])
    published = bundle.read_bundle(spark, target)
    return union(
        [
            published[name].agg(
                F.lit(name).alias("table"),
                F.count(F.lit(1)).alias("rows"),
                F.countDistinct(F.col(key)).alias("keys"),
            )
            for name, key in TABLE_KEYS.items()
        ]
    )


@query
def manifest_observed(spark, folder):
    """Rows, cells touched and violations of every table, all counted by the jobs that wrote the bundle."""
    result = masking.mask(shop(spark, folder), shop_rulebook(), observe=True)
    checks = [
        verify.Expectation("events", "click_props_dropped", (F.col("event_type") == "click") & F.col("props").isNotNull(), columns=("event_type", "props")),
        verify.Expectation("orders", "priority_masked", ~F.col("o_orderpriority").startswith("****"), columns=("o_orderpriority",)),
        verify.Expectation("pages", "html_dropped", F.col("html").isNotNull(), columns=("html",)),
        verify.Expectation("labels", "no_toxic", F.col("toxic") == 1, columns=("toxic",)),
    ]
    target = f"{scratch_dir(spark, 'bundle')}/published"
    manifest = bundle.write_bundle(spark, result.dataset, target, [folder], shop_rulebook(), checks=checks, enforce=False)
    touched = {name: sum(n for metric, n in values.items() if metric.startswith("cells:")) for name, values in result.row_metrics().items()}
    failed = {name: sum(n for check, n in manifest["violations"].items() if check.split(".")[0] == name) for name in touched}
    rows = [(name, manifest["row_counts"][name], touched[name], failed[name]) for name in TABLES]
    return spark.createDataFrame(rows, "table string, rows bigint, cells bigint, violations bigint")


def contact() -> Column:
    return F.concat(F.lit("user"), F.lpad(F.col("user_id").cast("string"), 7, "0"), F.lit("@mail.test"))


def event_files(spark, folder, files: int = 4, **columns: Column) -> tuple[str, DataFrame]:
    """The events with a contact, as a folder of files, and that folder as a stream of one file a batch."""
    path = f"{scratch_dir(spark, 'events')}/in"
    events = table(spark, folder, "events").withColumns({"contact": contact(), **columns, "part": F.col("event_id") % files})
    events.repartition("part").write.partitionBy("part").parquet(path)
    return path, spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


def contact_rules(event_rules: dict | None = None):
    policy = {"table": "events", "key": "event_type", "value": "props", "drop_regex": "(?i)(sign|purchase|error)", "rotate": {"error": {"constant": "{}"}}, "distinctive": False}
    return rules({"events": {"key": ["event_id"], "fields": {"contact": "fake_email", **(event_rules or {})}}, "key_value_policies": [policy]})


@query
def stream_gated_events(spark, folder):
    """The events published batch by batch, each after its promises and a leak scan for its own contacts; a second
    run of the same stream finds every batch in the ledger."""
    _, stream = event_files(spark, folder)
    run = scratch_dir(spark, "gated")
    checks = [verify.Expectation("events", "contact_faked", ~F.col("contact").endswith("@example.invalid"), columns=("contact",))]
    for checkpoint in ("first", "again"):
        gated.publish_stream(stream, "events", contact_rules(), f"{run}/out", f"{run}/{checkpoint}", checks).awaitTermination()
    return gated.published(spark, f"{run}/out").select("event_id", "event_type", "contact", "props")


@query
def stream_held_batches(spark, folder):
    """A batch whose notes repeat a contact that is masked elsewhere is held back; the others are published."""
    leaking = F.when(F.col("event_id") % 4 == 1, F.concat(F.lit("call "), contact())).otherwise(F.lit("none"))
    _, stream = event_files(spark, folder, note=leaking)
    run = scratch_dir(spark, "gated")
    gated.publish_stream(stream, "events", contact_rules({"note": "keep"}), f"{run}/out", f"{run}/progress", hold=True).awaitTermination()
    return gated.ledger(spark, f"{run}/out").groupBy("status", "reason").agg(F.sum("rows").alias("rows"))


@query
def stream_mask_events(spark, folder):
    """The events as a stream: available files are masked once, in append mode."""
    run = scratch_dir(spark, "stream")
    query = mask_available(
        spark, folder, f"{run}/out", f"{run}/progress", "events", shop_rulebook(), glob="events.parquet"
    )
    query.awaitTermination()
    return spark.read.parquet(f"{run}/out").select("event_id", "event_type", "props")


# --- rules on nested values, several files, several shuffles ------------------------------------


def rules(*files: dict):
    return rulebook_from({"00_strategies": STRATEGIES, **{f"{10 + n}": file for n, file in enumerate(files)}})


@query
def mask_nested_rotation(spark, folder):
    """A secret inside a structure: the source's value is gone from every row."""
    pages = table(spark, folder, "pages").select("page_id", F.struct(F.col("url").alias("token"), F.length("html").alias("size")).alias("cfg"))
    book = rules({"site": {"fields": {"cfg.token": {"strategy": "rotate_secret", "rotate": {"constant": "rotated"}}}}})
    return masking.mask({"site": pages}, book).dataset["site"].select("page_id", F.col("cfg.token").alias("token"), F.col("cfg.size").alias("size"))


@query
def mask_subtree_rule(spark, folder):
    """A rule on a nested value holds for all texts below it; one on an absent column shields nothing from a pattern."""
    turns = table(spark, folder, "conversations")
    parts = F.array(F.struct(F.col("text").alias("body"), F.col("turn").alias("at"), F.col("role").alias("who")))
    nested = turns.select("conv_id", "turn", F.struct(parts.alias("parts"), F.col("text").alias("full_text")).alias("message"))
    book = rules({"chat": {"fields": {"message.parts": "redact_freetext", "message.gone": "drop"}}, "column_patterns": [{"match": "(?P<kind>text)$", "strategy": "drop"}]})
    part = F.get("message.parts", F.lit(0))
    out = masking.mask({"chat": nested}, book).dataset["chat"]
    return out.select("conv_id", "turn", part["body"].alias("body"), part["at"].alias("at"), part["who"].alias("who"), F.col("message.full_text").alias("full_text"))


@query
def stream_rotation(spark, folder):
    run = scratch_dir(spark, "stream")
    book = rules({"pages": {"fields": {"url": {"strategy": "rotate_secret", "rotate": {"constant": "rotated"}}, "html": "drop"}}})
    mask_available(spark, folder, f"{run}/out", f"{run}/progress", "pages", book, glob="pages.parquet").awaitTermination()
    return spark.read.parquet(f"{run}/out")


@query
def policies_of_two_files(spark, folder):
    """Key/value policies of two rule files, both at work."""
    data = {"events": table(spark, folder, "events"), "chat": table(spark, folder, "conversations")}
    book = rules(
        {"key_value_policies": [{"table": "events", "key": "event_type", "value": "props", "drop_regex": "purchase"}]},
        {"key_value_policies": [{"table": "chat", "key": "role", "value": "text", "drop_regex": "^user$"}]},
    )
    out = masking.mask(data, book).dataset
    counts = [
        out[name].groupBy(F.lit(name).alias("table"), F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"), F.count(value).alias("left"))
        for name, key, value in (("events", "event_type", "props"), ("chat", "role", "text"))
    ]
    return union(counts)


@query
def mask_three_shuffles(spark, folder):
    """Three shuffled columns of a table whose key is dropped."""
    fields = {"o_orderkey": "drop", "o_custkey": "keep", **dict.fromkeys(("o_orderstatus", "o_totalprice", "o_orderpriority"), "shuffle_within_column")}
    book = rules({"orders": {"key": ["o_orderkey"], "fields": fields}})
    out = masking.mask({"orders": table(spark, folder, "orders")}, book, salt="s3-").dataset["orders"]
    return out.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query
def band_edge_types(spark, folder):
    """Noise on values at the limits of small types."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.lit(120).cast("tinyint").alias("tiny"), F.lit("99.99").cast("decimal(4,2)").alias("price"), F.lit(-32000).cast("smallint").alias("small")
    )
    fields = dict.fromkeys(("tiny", "price", "small"), {"strategy": "generalize_numeric_band", "salt": "edge-"})
    out = masking.mask({"t": orders}, rules({"t": {"key": ["o_orderkey"], "fields": fields}})).dataset["t"]
    return out.select("o_orderkey", F.col("tiny").cast("int").alias("tiny"), F.abs(F.col("price") - 99).cast("double").alias("price_off") <= 15, F.col("small").cast("int").alias("small")).toDF(
        "o_orderkey", "tiny", "price_near", "small"
    )


@query
def leak_scan_nested(spark, folder):
    """Passages hidden in structures, arrays and map keys, quotes and line breaks included."""
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    quoted = F.concat(F.lit('"'), "text", F.lit('"\n'))
    nested = docs.select(F.struct(F.array(F.struct(quoted.alias("body"))).alias("parts"), F.create_map(F.col("text"), F.col("doc_id")).alias("by_text")).alias("m"))
    return leakscan.find_values(leakscan.cells({"documents": nested}), items.select(F.col("text").alias("v")))


@query
def join_consistency_unique(spark, folder):
    """Unique fakes keep the matches of a join as they were."""
    data = shop(spark, folder, "customer", "orders")
    book = rules({"l": {"fields": {"name": {"strategy": "fake_email", "unique": True}}}, "r": {"fields": {"name": {"strategy": "fake_email", "unique": True}}}})
    before = {"l": name_on_orders(data["orders"]), "r": data["customer"].select(F.col("c_name").alias("name"))}
    after = masking.mask(before, book).dataset
    return verify.join_consistency((before["l"], before["r"]), (after["l"], after["r"]), "name", "name")


def line_accounts(items: DataFrame) -> tuple[Column, Column]:
    """An account number and a valid DE number for each key of an order line."""
    bban = F.lpad((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"), 14, "0")
    check = F.lit(98) - accounts.mod97(F.concat(bban, F.lit("131400")))
    return bban, F.concat(F.lit("DE"), F.lpad(check.cast("string"), 2, "0"), bban)


@query
def fake_accounts_bijective(spark, folder):
    """Unique fakes of account numbers and IBANs of all order lines: same form, no two alike."""
    items = table(spark, folder, "lineitem")
    account, iban = line_accounts(items)
    keys = items.select("l_orderkey", "l_linenumber").distinct().select("l_orderkey", "l_linenumber", account.alias("account"), iban.alias("iban"))
    book = rules({"lines": {"fields": {"account": {"strategy": "fake_bank_account_number", "unique": True, "salt": "p-"}, "iban": {"strategy": "fake_iban", "unique": True, "salt": "p-"}}}})
    return masking.mask({"lines": keys}, book).dataset["lines"]


@query
def bijective_summary(spark, folder):
    """Different originals and different fakes of each kind, and how many fakes keep the form."""
    items = table(spark, folder, "lineitem")
    account, iban = line_accounts(items)
    phone = F.concat(F.lpad((F.col("l_orderkey") % 90 + 10).cast("string"), 2, "0"), F.lit("-"), F.substr(account, F.lit(5), F.lit(3)), F.lit("-"), F.substr(account, F.lit(8)))
    originals = [account, iban, phone, F.substr(account, F.lit(10))]
    fakes = [
        ("account", accounts.unique_bank_account(F.col("original"), salt="p-"), r"^[0-9]{14}\z"),
        ("iban", accounts.unique_iban(F.col("original"), salt="p-"), r"^DE[0-9]{16}\z"),
        ("phone", accounts.unique_text(F.col("original"), "phone:", "p-"), r"^[0-9]{2}-[0-9]{3}-[0-9]{7}\z"),
        ("zip", accounts.unique_text(F.col("original"), "zip:", "p-"), r"^[0-9]{5}\z"),
    ]
    parts = []
    for original, (kind, fake, form) in zip(originals, fakes):
        distinct = items.select(original.alias("original")).groupBy("original").agg(F.count(F.lit(1)).alias("n")).withColumn("fake", fake)
        counted = distinct.groupBy("fake").agg(F.count(F.lit(1)).alias("originals"), F.sum("n").alias("rows"))
        holds = F.col("fake").rlike(form) & (accounts.valid_iban(F.col("fake")) if kind == "iban" else F.lit(True))
        parts.append(counted.agg(F.lit(kind).alias("kind"), F.sum("rows").alias("rows"), F.sum("originals").alias("originals"), F.count(F.lit(1)).alias("fakes"), F.count_if(holds).alias("in_form")))
    return union(parts)


@query
def null_binary_column(spark, folder):
    frame = table(spark, folder, "documents").select("doc_id", F.col("text").cast("binary").alias("raw"), "lang")
    out = masking.mask({"files": frame}, rules({"files": {"fields": {"raw": "null_binary"}}})).dataset["files"]
    return out.select("doc_id", F.col("raw").isNull().alias("gone"), "lang")


@query
def base_types(spark, folder):
    """Type names with modifiers and in any case."""
    parts = table(spark, folder, "part")
    return parts.select("p_partkey", text.base_type(F.concat(F.lit(" "), F.upper("p_brand"), F.lit("("), F.col("p_size").cast("string"), F.lit(")"))).alias("base"))


@query
def schema_snapshot(spark, folder):
    """The schema scan saved, read back, and joined with the cells of each column."""
    data, path = shop(spark, folder), scratch_dir(spark, "schema")
    schema.save_snapshot(schema.scan_schema(spark, data), path)
    return schema.load_snapshot(spark, path).join(column_cells(data), ["table", "column"]).select("table", "column", "ordinal", "cells")


@query
def manifest_rows(spark, folder):
    """The row counts that a published bundle's manifest states."""
    data = shop(spark, folder)
    target = f"{scratch_dir(spark, 'bundle')}/published"
    bundle.write_bundle(spark, data, target, [folder], shop_rulebook())
    manifest = bundle.read_manifest(spark, target)
    return spark.createDataFrame(sorted(manifest["row_counts"].items()), "table string, rows bigint")


@query
def coverage_gate(spark, folder):
    """Whether the gate lets the tables pass, beside the cells that no rule handles."""
    report = coverage_report(spark, folder)
    try:
        coverage.gate(report)
        passed = True
    except coverage.CoverageError:
        passed = False
    open_cells = coverage.findings(report).agg(F.count(F.lit(1)).alias("columns"), F.sum("cells").alias("cells"))
    return open_cells.select("columns", "cells", F.lit(passed).alias("passed"))
