"""DuckDB SQL that states what each workload query must return."""

from __future__ import annotations

from itertools import combinations, permutations

from maskloom.functions import words
from maskloom.functions.words import FILLER
from maskloom.operators.leakscan import CANARY
from maskloom.workload.rules import COMPOSITE_COLUMNS, SALT, TABLES, shop_rulebook

ORACLES: dict[str, str] = {}


# --- building blocks --------------------------------------------------------------------------


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def md5(value: str, tag: str = "") -> str:
    return f"md5(concat({quoted(tag)}, {value}))" if tag else f"md5({value})"


def number(code: str, start: int, width: int = 8) -> str:
    return f"CAST(concat('0x', substr({code}, {start}, {width})) AS BIGINT)"


def draw(entries: list[str], code: str, start: int = 1) -> str:
    listed = "[" + ", ".join(quoted(w) for w in entries) + "]"
    return f"list_extract({listed}, CAST({number(code, start)} % {len(entries)} AS INTEGER) + 1)"


def person(value: str, salt: str = "") -> str:
    code = md5(value, salt + "person:")
    return f"({draw(words.FIRST_NAMES, code, 1)} || ' ' || {draw(words.LAST_NAMES, code, 9)})"


def company(value: str, salt: str = "") -> str:
    code = md5(value, salt + "company:")
    return (
        f"({draw(words.COMPANY_ADJECTIVES, code, 1)} || ' ' || {draw(words.COMPANY_NOUNS, code, 9)} || ' ' || "
        f"{draw(words.COMPANY_FORMS, code, 17)})"
    )


def email(value: str) -> str:
    code = md5(value, "email:")
    local = f"({draw(words.FIRST_NAMES, code, 1)} || '.' || {draw(words.LAST_NAMES, code, 9)})"
    return f"(regexp_replace(lower({local}), '[^a-z0-9.]', '', 'g') || '@example.invalid')"


def phone(value: str) -> str:
    code = md5(value, "phone:")
    return (
        f"(({number(code, 1)} % 900 + 100) || '-' || ({number(code, 9)} % 900 + 100) || '-' || "
        f"({number(code, 17)} % 9000 + 1000) || ' x' || ({number(code, 25)} % 9900 + 100))"
    )


def redact(value: str) -> str:
    return f"CASE WHEN {value} IS NOT NULL THEN rpad('', CAST(greatest(length({value}), 1) AS INTEGER), {quoted(FILLER)}) END"


def partial(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN length({text}) <= 4 THEN '****' ELSE concat('****', right({text}, 4)) END"


def partial_or_null(value: str) -> str:
    return f"CASE WHEN {value} IS NOT NULL THEN {partial(value)} END"


def noisy(value: str, column: str, *keys: str, salt: str = "") -> str:
    key = f"concat_ws(chr(31), {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)})"
    code = f"md5(concat('{salt}band:', {key}, ':{column}'))"
    unit = f"CAST({number(code, 1)} AS DOUBLE) / CAST(4294967296 AS DOUBLE)"
    one, two, ratio = "CAST(1 AS DOUBLE)", "CAST(2 AS DOUBLE)", "CAST(0.15 AS DOUBLE)"
    return f"CAST({value} AS DOUBLE) * ({one} + {ratio} * ({two} * ({unit}) - {one}))"


def year(value: str) -> str:
    return f"CAST(date_trunc('year', {value}) AS DATE)"


def shuffled(table: str, key: list[str], value: str, group: list[str] | None = None, salt: str = "") -> str:
    """CTEs ``ranked`` and ``moved``: every key with the value of the next key in hash order."""
    key_text = f"concat_ws(chr(31), {', '.join(f'CAST({k} AS VARCHAR)' for k in key)})"
    keys = ", ".join(key)
    part = f"PARTITION BY {', '.join(group)}" if group else ""
    also = (", " + ", ".join(group)) if group else ""
    same = "".join(f" AND a.{g} = b.{g}" for g in group or [])
    return (
        f"ranked AS (SELECT {keys}{also}, {value} AS v, "
        f"row_number() OVER ({part} ORDER BY md5(concat({quoted(salt)}, {key_text})), {keys}) AS p, "
        f"count(*) OVER ({part}) AS n FROM {table}), "
        f"moved AS (SELECT {', '.join('a.' + k for k in key)}{''.join(', a.' + g for g in group or [])}, b.v AS v "
        f"FROM ranked a JOIN ranked b ON b.p = a.p % a.n + 1{same})"
    )


DIGITS = "regexp_replace({}, '[^0-9]', '', 'g')"


def stream(name: str, source: str, tag: str, length: str, id_column: str = "id") -> str:
    """A recursive CTE ``name(id, digits)`` over ``source(id, v)``."""
    more = DIGITS.format("substr(md5(seed || out), 1, 8)")
    return (
        f"{name}_steps AS (SELECT {id_column} AS id, {length} AS n, md5(concat('{tag}', v)) AS seed, CAST('' AS VARCHAR) AS out FROM {source} "
        f"UNION ALL SELECT id, n, md5(seed || out), out || {more} FROM {name}_steps WHERE length(out) < n), "
        f"{name} AS (SELECT id, substr(out, 1, CAST(n AS INTEGER)) AS digits FROM {name}_steps WHERE length(out) >= n)"
    )


IBAN = (
    "CASE WHEN c_custkey % 7 = 0 THEN concat('acc ', lpad(CAST(c_custkey AS VARCHAR), 16, '30')) "
    "ELSE concat(list_extract(['GB','be','DE','FR'], CAST(c_custkey % 4 AS INTEGER) + 1), '29', "
    "lpad(CAST(c_custkey AS VARCHAR), 16, '30'), upper(substr(c_mktsegment, 1, 2))) END"
)

CUSTOMER_SEGMENTS = shuffled("customer", ["c_custkey"], "c_mktsegment")
RULED_SEGMENTS = shuffled("customer", ["c_custkey"], "c_mktsegment", salt=SALT + "c_mktsegment:")

# --- masking whole tables ---------------------------------------------------------------------

ORACLES["mask_customer"] = (
    f"WITH {RULED_SEGMENTS} SELECT c.c_custkey, {person('c.c_name')} AS c_name, c.c_nationkey, "
    f"{noisy('c.c_acctbal', 'c_acctbal', 'c.c_custkey', salt=SALT)} AS c_acctbal, m.v AS c_mktsegment "
    "FROM customer c JOIN moved m USING (c_custkey)"
)
ORACLES["mask_supplier"] = (
    f"SELECT s_suppkey, {company('s_name')} AS s_name, s_nationkey, "
    f"{noisy('s_acctbal', 's_acctbal', 's_suppkey', salt=SALT)} AS s_acctbal FROM supplier"
)
ORACLES["mask_orders"] = (
    f"SELECT o_orderkey, o_custkey, o_orderstatus, {noisy('o_totalprice', 'o_totalprice', 'o_orderkey', salt=SALT)} AS o_totalprice, "
    f"{year('o_orderdate')} AS o_orderdate, {partial('o_orderpriority')} AS o_orderpriority FROM orders"
)
ORACLES["mask_lineitem"] = (
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
    f"{noisy('l_extendedprice', 'l_extendedprice', 'l_orderkey', 'l_linenumber', salt=SALT)} AS l_extendedprice, "
    f"l_discount, l_tax, l_returnflag, l_linestatus, {year('l_shipdate')} AS l_shipdate FROM lineitem"
)

EVENT_PROPS = (
    "CASE WHEN event_type = 'error' THEN '{}' "
    "WHEN regexp_matches(event_type, '(?i)(sign|purchase|error)') THEN NULL ELSE props END"
)


def _fingerprint(name: str, source: str, *columns: str) -> str:
    joined = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
    seed = number(md5(joined), 1, 15)
    return (
        f"SELECT '{name}' AS \"table\", count(*) AS rows, CAST(sum({seed} % 1000003) AS BIGINT) AS fingerprint FROM {source}"
    )


ORACLES["mask_dataset"] = f"WITH {RULED_SEGMENTS} " + " UNION ALL ".join(
    [
        _fingerprint("customer", "customer c JOIN moved m USING (c_custkey)", person("c.c_name"), "m.v"),
        _fingerprint("supplier", "supplier", company("s_name")),
        _fingerprint("nation", "nation", company("n_name")),
        _fingerprint("orders", "orders", partial("o_orderpriority")),
        _fingerprint("part", "part", redact("p_name"), partial("p_brand")),
        _fingerprint("region", "region", redact("r_name")),
        _fingerprint("documents", "documents", redact("text")),
        _fingerprint("conversations", "conversations", redact("text")),
        _fingerprint("events", "events", EVENT_PROPS),
        _fingerprint(
            "lineitem", "lineitem", "l_returnflag", "year(l_shipdate)",
            f"CAST(floor({noisy('l_extendedprice', 'l_extendedprice', 'l_orderkey', 'l_linenumber', salt=SALT)}) AS BIGINT)",
        ),
        _fingerprint("pages", "pages", "url", "NULL"),
        _fingerprint("benchmark", "benchmark", redact("text")),
        _fingerprint("labels", "labels", "doc_id", "quality", "toxic"),
        _fingerprint("embeddings", "embeddings", "vec_id", "label"),
    ]
)
ALL_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in TABLES)
# eleven row rules find their column, one (s_website) does not; four keeps, six columns by pattern
# alone and four more that a rule overrides
COUNTERS = {
    "applied": 11, "kept": 4, "pattern_applied": 6, "pattern_overlap": 4, "policies_applied": 2, "policies_skipped": 0,
    "rotate_applied": 0, "rotate_skipped": 1, "shuffle_applied": 1, "shuffle_skipped": 0, "skipped": 1,
}
ORACLES["mask_counters"] = (
    "SELECT CAST(sum(rows) AS BIGINT) AS rows, "
    + ", ".join(f"CAST({n} AS BIGINT) AS {name}" for name, n in COUNTERS.items())
    + f" FROM ({ALL_COUNTS})"
)
ORACLES["redact_documents"] = f"SELECT doc_id, {redact('text')} AS text, lang, source, n_chars FROM documents"
ORACLES["redact_conversations"] = f"SELECT conv_id, turn, role, {redact('text')} AS text FROM conversations"
ORACLES["mask_nested"] = f"SELECT conv_id, turn, role, {redact('text')} AS body, turn AS at FROM conversations"
ORACLES["custom_strategy"] = "SELECT p_partkey, concat(upper(substr(p_name, 1, 1)), '.') AS p_name FROM part"

# --- single strategies ------------------------------------------------------------------------

ORACLES["seed_values"] = f"SELECT c_custkey, {number(md5('c_name'), 1, 15)} AS seed FROM customer"
ORACLES["seeded_draw"] = (
    f"SELECT p_partkey, {draw(['red', 'green', 'blue', 'white', 'black'], md5('p_name', 'color:'))} AS color FROM part"
)
STREET_CODE = md5("c_name", "street:")
ORACLES["fake_contact_fields"] = (
    f"SELECT c_custkey, {email('c_name')} AS email, {email('lower(trim(c_name))')} AS email_normalized, "
    f"{phone('c_name')} AS phone, "
    f"(({number(STREET_CODE, 1)} % 999 + 1) || ' ' || {draw(words.STREETS, STREET_CODE, 9)} || ' ' || "
    f"{draw(words.STREET_KINDS, STREET_CODE, 17)}) AS street, "
    f"{draw(words.CITIES, md5('c_name', 'city:'))} AS city, "
    f"lpad(CAST({number(md5('c_name', 'zip:'), 1)} % 100000 AS VARCHAR), 5, '0') AS zip FROM customer"
)
ORACLES["fake_names_salted"] = (
    f"SELECT s_suppkey, {person('s_name', 'pepper')} AS person, {company('s_name', 'pepper')} AS company FROM supplier"
)
ORACLES["fake_bank_accounts"] = (
    "WITH RECURSIVE src AS (SELECT c_custkey AS id, concat('12-', lpad(CAST(c_custkey AS VARCHAR), 9, '7')) AS v FROM customer), "
    f"{stream('bank', 'src', 'bank:', 'length(v)')} "
    "SELECT src.id AS c_custkey, src.v AS account, bank.digits AS fake FROM src JOIN bank ON src.id = bank.id"
)
ORACLES["fake_ibans"] = (
    f"WITH RECURSIVE raw AS (SELECT c_custkey AS id, {IBAN} AS v FROM customer), "
    "ok AS (SELECT id, v, upper(substr(v, 1, 2)) AS cc FROM raw WHERE regexp_full_match(v, '[A-Za-z]{2}[0-9]{2}[0-9A-Za-z]+')), "
    "other AS (SELECT * FROM raw WHERE NOT regexp_full_match(v, '[A-Za-z]{2}[0-9]{2}[0-9A-Za-z]+')), "
    f"{stream('iban', 'ok', 'iban:', 'length(v) - 4')}, {stream('bank', 'other', 'bank:', 'length(v)')}, "
    "checked AS (SELECT ok.id, v, cc, digits, 98 - CAST(CAST(digits || (ascii(substr(cc, 1, 1)) - 55) || "
    "(ascii(substr(cc, 2, 1)) - 55) || '00' AS HUGEINT) % 97 AS INTEGER) AS chk FROM ok JOIN iban ON ok.id = iban.id) "
    "SELECT id AS c_custkey, v AS iban, cc || lpad(CAST(chk AS VARCHAR), 2, '0') || digits AS fake FROM checked "
    "UNION ALL SELECT other.id, v, digits FROM other JOIN bank ON other.id = bank.id"
)
VAT = (
    "CASE c_custkey % 4 WHEN 0 THEN concat('be0', lpad(CAST(c_custkey AS VARCHAR), 9, '4')) "
    "WHEN 1 THEN concat('12.', lpad(CAST(c_custkey AS VARCHAR), 6, '3'), '/', '7') "
    "WHEN 2 THEN concat('FR ', CAST(c_custkey AS VARCHAR), '-9') ELSE '-/-' END"
)
ORACLES["fake_vat_numbers"] = (
    f"WITH RECURSIVE raw AS (SELECT c_custkey AS id, {VAT} AS v FROM customer), "
    "pre AS (SELECT * FROM raw WHERE regexp_matches(v, '^[A-Za-z]{2}')), "
    "bare AS (SELECT * FROM raw WHERE NOT regexp_matches(v, '^[A-Za-z]{2}')), "
    f"{stream('vat', 'pre', 'vat:', 'length(v) - 2')}, "
    "walk AS (SELECT id, v, 1 AS i, md5('vat:' || v) AS seed, CAST('' AS VARCHAR) AS out FROM bare UNION ALL "
    "SELECT id, v, i + 1, CASE WHEN substr(v, i, 1) BETWEEN '0' AND '9' THEN md5(seed || out) ELSE seed END, "
    f"out || CASE WHEN substr(v, i, 1) BETWEEN '0' AND '9' THEN substr({DIGITS.format('md5(seed || out)')}, 1, 1) ELSE substr(v, i, 1) END "
    "FROM walk WHERE i <= length(v)), "
    "fakes AS (SELECT pre.id, v, upper(substr(v, 1, 2)) || digits AS fake FROM pre JOIN vat ON pre.id = vat.id "
    "UNION ALL SELECT id, v, out FROM walk WHERE i = length(v) + 1) "
    f"SELECT id AS c_custkey, v AS vat, CASE WHEN fake = v THEN {redact('v')} ELSE fake END AS fake FROM fakes"
)
ORACLES["partial_last4"] = (
    f"SELECT o_orderkey, {partial('o_orderpriority')} AS priority, {partial('o_custkey')} AS customer FROM orders"
)
ORACLES["year_band_orders"] = (
    f"SELECT o_orderkey, {year('o_orderdate')} AS order_year, {year('o_orderdate')} AS order_year_date, "
    f"{noisy('o_totalprice', 'o_totalprice', 'o_orderkey')} AS total_price, "
    f"CAST(round({noisy('o_custkey', 'o_custkey', 'o_orderkey')}) AS BIGINT) AS rounded FROM orders"
)
ORACLES["drop_columns"] = "SELECT page_id, CAST(NULL AS VARCHAR) AS html, CAST(NULL AS VARCHAR) AS preview FROM pages"
ORACLES["force_constants"] = (
    "SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, CAST(0 AS DOUBLE) AS o_totalprice FROM orders"
)
ORACLES["fresh_tokens"] = "SELECT event_id, 'off' AS event_type, true AS is_token, true AS changed, true AS is_uuid FROM events"

# --- policies ---------------------------------------------------------------------------------

ORACLES["key_secret_drop"] = f"SELECT event_id, event_type, {EVENT_PROPS} AS props FROM events"
ORACLES["stream_mask_events"] = ORACLES["key_secret_drop"]
ORACLES["key_secret_drop_required"] = (
    "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN '' ELSE props END AS props FROM events"
)
ORACLES["page_content_policy"] = (
    "WITH p AS (SELECT *, CASE WHEN page_id % 9 = 0 THEN 'http-old' ELSE split_part(url, ':', 1) END AS scheme FROM pages) "
    "SELECT page_id, CASE WHEN scheme = 'https' THEN concat('page_', page_id, regexp_extract(url, '(\\.[^.]+)$', 1)) ELSE url END AS url, "
    "CAST(NULL AS VARCHAR) AS html, scheme FROM p WHERE scheme NOT IN ('ftp', 'http')"
)
ORACLES["content_policy_metrics"] = (
    "SELECT count(*) AS rows_content_dropped, count(*) FILTER (page_id % 3 = 0 AND html IS NOT NULL) AS rows_index_dropped, "
    "count(*) FILTER (split_part(url, ':', 1) = 'https') AS filenames_scrubbed FROM pages"
)
ORACLES["parent_semi_join"] = (
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O') "
    "AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"
)
ORACLES["neutralize_preset"] = (
    "SELECT 'parameter' AS kind, event_id AS id, CASE event_type WHEN 'signup' THEN 'mail.force.smtp.from' "
    "WHEN 'view' THEN 'mail.default.server' ELSE event_type END AS key, "
    "CASE WHEN event_type = 'view' THEN 'smtp' WHEN event_id % 5 = 0 THEN NULL WHEN event_type = 'signup' THEN '0' ELSE props END AS value FROM events "
    "UNION ALL SELECT 'provider', s_suppkey, 'state', 'disabled' FROM supplier "
    "UNION ALL SELECT 'server', s_suppkey, 'false', NULL FROM supplier"
)
ORACLES["name_changes"] = f'SELECT n_name AS old, {company("n_name")} AS new FROM nation'

NOTE = (
    "concat('from NATION_', CAST(c_nationkey AS VARCHAR), ' via NATION_', "
    "CAST((c_nationkey * 7 + 3) % 25 AS VARCHAR), '0, not NATION')"
)


def _replace_walk(*columns: str) -> str:
    """CTE ``done``: every column with all pairs applied one after the other, longest first."""
    steps = ", ".join(f"replace({c}, old, new)" for c in columns)
    listed = ", ".join(columns)
    return (
        f"pairs AS (SELECT n_name AS old, {company('n_name')} AS new, "
        "row_number() OVER (ORDER BY length(n_name) DESC, n_name) AS i FROM nation), "
        f"walk AS (SELECT c_custkey, 0 AS i, {listed} FROM notes UNION ALL "
        f"SELECT c_custkey, walk.i + 1, {steps} FROM walk JOIN pairs ON pairs.i = walk.i + 1), "
        "done AS (SELECT * FROM walk WHERE i = (SELECT count(*) FROM pairs))"
    )


ORACLES["scoped_replace"] = (
    f"WITH RECURSIVE notes AS (SELECT c_custkey, {NOTE} AS note FROM customer), {_replace_walk('note')} "
    "SELECT c.c_custkey, c.c_mktsegment, CASE WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN d.note ELSE n.note END AS note "
    "FROM customer c JOIN notes n USING (c_custkey) JOIN done d USING (c_custkey)"
)
ORACLES["scoped_replace_ranges"] = ORACLES["scoped_replace"]
ORACLES["scoped_replace_nested"] = (
    f"WITH RECURSIVE notes AS (SELECT c_custkey, {NOTE} AS note, upper({NOTE}) AS shout FROM customer), {_replace_walk('note', 'shout')} "
    "SELECT c_custkey, v AS en_us, s AS upper, v AS body_note, v AS body_item, v AS known_item FROM ("
    "SELECT c.c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN d.note ELSE n.note END AS v, "
    "CASE WHEN c_mktsegment <> 'BUILDING' THEN d.shout ELSE n.shout END AS s "
    "FROM customer c JOIN notes n USING (c_custkey) JOIN done d USING (c_custkey))"
)

# --- permutation ------------------------------------------------------------------------------

ORACLES["shuffle_segments"] = f"WITH {CUSTOMER_SEGMENTS} SELECT c_custkey, v AS c_mktsegment FROM moved"
ORACLES["shuffle_orders"] = (
    "WITH "
    + shuffled(
        "orders", ["o_orderkey", "o_custkey"], "CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END", salt="s1"
    )
    + " SELECT o_orderkey, v AS o_orderpriority FROM moved"
)


def deranged(table: str, keys: list[str], value: str, salt: str) -> str:
    """CTEs ``placed`` and ``deranged``: classes in the order of their digest, each row served by the one a class size on."""
    key_text = f"concat_ws(chr(31), {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)})"
    spelled = f"concat('{{\"v\":', coalesce('\"' || ({value}) || '\"', 'null'), '}}')"
    return (
        f"placed AS (SELECT {', '.join(keys)}, {value} AS v, row_number() OVER (ORDER BY md5(concat('{salt}v:', {spelled})), md5(concat('{salt}', {key_text}))) - 1 AS p, "
        f"count(*) OVER () AS n FROM {table}), "
        "largest AS (SELECT max(c) AS m FROM (SELECT count(*) AS c FROM placed GROUP BY v)), "
        f"deranged AS (SELECT {', '.join('a.' + k for k in keys)}, b.v FROM placed a, largest JOIN placed b ON b.p = (a.p + m) % a.n)"
    )


ORACLES["shuffle_deranged"] = (
    "WITH " + deranged("orders", ["o_orderkey", "o_custkey"], "CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END", "d1") + " SELECT o_orderkey, v AS o_orderpriority FROM deranged"
)
ORACLES["derangement_report"] = " UNION ALL ".join(
    f"SELECT '{t}.{c}' AS \"column\", CAST(sum(n) AS BIGINT) AS \"rows\", max(n) AS largest, CAST(greatest(0, 2 * max(n) - sum(n)) AS BIGINT) AS unavoidable, "
    f"CAST(greatest(0, 2 * max(n) - sum(n)) AS BIGINT) AS unchanged, CAST(sum(n * ({number(md5(f'CAST({c} AS VARCHAR)'), 1, 15)} % 1000003)) AS BIGINT) AS fingerprint "
    f"FROM (SELECT {c}, count(*) AS n FROM {t} GROUP BY 1)"
    for t, c in (("lineitem", "l_returnflag"), ("lineitem", "l_linestatus"), ("orders", "o_orderpriority"), ("orders", "o_orderstatus"), ("orders", "o_custkey"), ("customer", "c_mktsegment"), ("events", "event_type"))
)
ORACLES["shuffle_within_group"] = (
    "WITH " + shuffled("customer", ["c_custkey"], "c_name", ["c_mktsegment"]) + " SELECT c_custkey, c_mktsegment, v AS c_name FROM moved"
)
ORACLES["keyed_position"] = (
    "SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS position FROM orders"
)

# --- leak scan --------------------------------------------------------------------------------

SCHEMA_OF = {
    "region": "r_regionkey:n r_name:s",
    "nation": "n_nationkey:n n_name:s n_regionkey:n",
    "customer": "c_custkey:n c_name:s c_nationkey:n c_acctbal:n c_mktsegment:s",
    "supplier": "s_suppkey:n s_name:s s_nationkey:n s_acctbal:n",
    "part": "p_partkey:n p_name:s p_brand:s p_type:s p_size:n p_retailprice:n",
    "orders": "o_orderkey:n o_custkey:n o_orderstatus:s o_totalprice:n o_orderdate:n o_orderpriority:s",
    "lineitem": "l_orderkey:n l_partkey:n l_suppkey:n l_linenumber:n l_quantity:n l_extendedprice:n l_discount:n l_tax:n "
    "l_returnflag:s l_linestatus:s l_shipdate:n",
    "events": "event_id:n ts:n user_id:n event_type:s value:n props:s",
    "documents": "doc_id:n text:s lang:s source:s n_chars:n",
    "embeddings": "vec_id:n embedding:n label:n",
    "pages": "page_id:n url:s html:s",
    "benchmark": "item_id:n text:s",
    "labels": "doc_id:n quality:n toxic:n",
    "conversations": "conv_id:n turn:n role:s text:s",
}
COLUMNS = [(t, c.split(":")[0], c.split(":")[1] == "s", i) for t in TABLES for i, c in enumerate(SCHEMA_OF[t].split())]
COUNTED = ("text", "html", "url", "props", "c_name", "s_name", "lang", "source", "role")

ORACLES["cell_unpivot"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count({c}) AS cells, "
    + (f"CAST(sum(length({c})) AS BIGINT)" if c in COUNTED else "CAST(NULL AS BIGINT)")
    + f" AS chars FROM {t}"
    for t, c, _, _ in COLUMNS
)
ORACLES["original_values"] = " UNION ALL ".join(
    f"SELECT DISTINCT {c} AS value, '{t}' AS \"table\", '{c}' AS \"column\" FROM {t} WHERE {c} IS NOT NULL"
    for t, c in (("customer", "c_name"), ("supplier", "s_name"), ("nation", "n_name"), ("orders", "o_orderpriority"))
)


def _cells(*sources: tuple[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", {c} AS value FROM {t}" for t, c in sources)


ORACLES["leak_scan_passages"] = (
    "WITH cells AS ("
    + _cells(
        ("documents", "text"), ("documents", "lang"), ("documents", "source"), ("conversations", "role"),
        ("conversations", "text"), ("pages", "url"), ("pages", "html"),
    )
    + ") SELECT n.text AS needle, \"table\", \"column\", count(*) AS cells FROM cells JOIN (SELECT DISTINCT text FROM benchmark WHERE text <> '') n "
    "ON contains(value, n.text) GROUP BY ALL"
)
ORACLES["leak_scan_passages_by_join"] = ORACLES["leak_scan_passages"]
ORACLES["leak_scan_names"] = (
    "SELECT c_name AS needle, 'orders' AS \"table\", 'note' AS \"column\", count(*) AS cells FROM customer JOIN orders "
    "ON c_name = concat('Customer#', lpad(CAST(o_custkey AS VARCHAR), 9, '0')) AND o_orderstatus = 'F' GROUP BY c_name"
)
ORACLES["leak_scan_names_by_join"] = ORACLES["leak_scan_names"]
ORACLES["leak_scan_short_values"] = (
    "WITH cells AS ("
    + _cells(
        ("events", "event_type"), ("events", "props"), ("documents", "text"), ("documents", "lang"),
        ("documents", "source"), ("nation", "n_name"),
    )
    + "), n AS (SELECT event_type AS v FROM events UNION SELECT source FROM documents UNION SELECT n_name FROM nation) "
    'SELECT v AS needle, "table", "column", count(*) AS cells FROM cells JOIN n '
    "ON (length(v) < 6 AND value = v) OR (length(v) >= 6 AND contains(value, v)) GROUP BY ALL"
)
ORACLES["leak_scan_clean"] = (
    f"SELECT '{CANARY}' AS needle, '__canary__' AS \"table\", 'probe' AS \"column\", count(*) AS cells FROM (SELECT 1)"
)

# --- coverage ---------------------------------------------------------------------------------

BOOK = shop_rulebook()
INFO = "SELECT table_name AS \"table\", column_name AS \"column\", data_type, CAST(ordinal_position - 1 AS INTEGER) AS ordinal FROM information_schema.columns WHERE table_name IN (" + ", ".join(quoted(t) for t in TABLES) + ")"
CELLS = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count({c}) AS cells FROM {t}" for t, c, _, _ in COLUMNS)
RULES = " UNION ALL ".join(
    f"SELECT {quoted(r.table)} AS \"table\", {quoted(r.field)} AS \"column\", {quoted(r.strategy)} AS rule" for r in BOOK.rules
)
FK = "CASE \"table\" || '.' || \"column\" WHEN 'customer.c_nationkey' THEN 'nation.n_nationkey' WHEN 'orders.o_custkey' THEN 'customer.c_custkey' END"
SHAPE = (
    "CASE WHEN \"table\" = 'orders' AND \"column\" = 'o_custkey' THEN 'partner_ref' "
    "WHEN data_type = 'VARCHAR' THEN 'free_text' ELSE 'other' END"
)
FIRST_PATTERN = (
    "CASE WHEN shape = 'free_text' AND regexp_matches(\"column\", '_name$') THEN 'redact_freetext' "
    "WHEN shape = 'free_text' AND regexp_matches(\"column\", '^(p|r)_') THEN 'partial_keep_last4' "
    "WHEN shape = 'free_text' AND regexp_matches(\"column\", '(^|_)text$') THEN 'redact_freetext' "
    "WHEN shape IN ('free_text', 'binary') AND regexp_matches(\"column\", 'key$') THEN 'drop' END"
)
PATTERN_REGEX = (
    "CASE WHEN regexp_matches(\"column\", '_name$') THEN '_name$' WHEN regexp_matches(\"column\", '^(p|r)_') THEN '^(p|r)_' "
    "WHEN regexp_matches(\"column\", '(^|_)text$') THEN '(^|_)text$' ELSE 'key$' END"
)
RULED = ", ".join(quoted(m) for m in BOOK.models)
REPORT = (
    f"WITH cols AS (SELECT *, {SHAPE} AS shape FROM ({INFO})), rules AS ({RULES}), counts AS ({CELLS}), "
    "report AS (SELECT c.\"table\", c.\"column\", shape, "
    f"CASE WHEN rule IS NOT NULL THEN 'explicit' WHEN {FIRST_PATTERN.replace(chr(34) + 'column' + chr(34), 'c.' + chr(34) + 'column' + chr(34))} IS NOT NULL THEN 'pattern' "
    f"WHEN shape NOT IN ('free_text', 'partner_ref', 'binary') THEN 'not_flagged' WHEN c.\"table\" NOT IN ({RULED}) THEN 'undeclared_model' ELSE 'uncovered' END AS outcome, "
    f"coalesce(rule, {FIRST_PATTERN.replace(chr(34) + 'column' + chr(34), 'c.' + chr(34) + 'column' + chr(34))}) AS strategy, cells "
    "FROM cols c LEFT JOIN rules r ON r.\"table\" = c.\"table\" AND r.\"column\" = c.\"column\" "
    "JOIN counts n ON n.\"table\" = c.\"table\" AND n.\"column\" = c.\"column\" WHERE c.\"table\" <> 'labels') "
)
ORACLES["schema_scan"] = (
    f"WITH cols AS (SELECT *, {SHAPE} AS shape, {FK} AS fk_target FROM ({INFO})), counts AS ({CELLS}) "
    'SELECT c."table", c."column", shape, fk_target, ordinal, cells FROM cols c JOIN counts n ON n."table" = c."table" AND n."column" = c."column"'
)
ORACLES["coverage_scan"] = REPORT + 'SELECT "table", "column", shape, outcome, strategy, cells FROM report'
ORACLES["coverage_findings"] = REPORT + (
    "SELECT \"table\", \"column\", outcome, CASE outcome WHEN 'uncovered' THEN \"table\" || '.' || \"column\" || ' is ' || shape || ' without a strategy' "
    "ELSE 'model ' || \"table\" || ' has no rule at all; column is ' || shape END AS reason, cells FROM report "
    "WHERE outcome IN ('undeclared_model', 'uncovered')"
)
ORACLES["coverage_summary"] = REPORT + (
    "SELECT count(*) AS considered, count(*) FILTER (outcome = 'explicit') AS covered, count(*) FILTER (outcome = 'pattern') AS by_pattern, "
    "count(*) FILTER (outcome IN ('undeclared_model', 'uncovered')) AS flagged, CAST(sum(cells) AS BIGINT) AS cells, "
    "CAST(sum(cells) FILTER (outcome IN ('undeclared_model', 'uncovered')) AS BIGINT) AS flagged_cells FROM report"
)
ORACLES["coverage_by_pattern"] = REPORT + (
    f"SELECT \"table\", \"column\", strategy, 'covered by pattern ' || {PATTERN_REGEX} || ' -> ' || strategy AS reason, cells FROM report WHERE outcome = 'pattern'"
)
ORACLES["undeclared_tables"] = REPORT + (
    "SELECT \"table\" AS model, CAST(sum(cells) AS BIGINT) AS cells FROM report WHERE outcome = 'undeclared_model' GROUP BY 1"
)
ORACLES["uncovered_columns"] = (
    f"SELECT \"table\", \"column\", cells FROM ({CELLS}) n WHERE NOT EXISTS (SELECT 1 FROM ({RULES}) r WHERE r.\"table\" = n.\"table\" AND r.\"column\" = n.\"column\")"
)
ORACLES["pattern_first_match"] = (
    f"WITH cols AS (SELECT *, CASE WHEN data_type = 'VARCHAR' THEN 'free_text' ELSE 'other' END AS shape FROM ({INFO})), "
    "pats(ordinal, rx, strategy) AS (VALUES (0, '_name$', 'redact_freetext'), (1, '^(p|r)_', 'partial_keep_last4'), "
    "(2, '(^|_)text$', 'redact_freetext'), (3, 'key$', 'drop')), "
    "hits AS (SELECT \"table\", \"column\", strategy, row_number() OVER (PARTITION BY \"table\", \"column\" ORDER BY ordinal_) AS rn, "
    "count(*) OVER (PARTITION BY \"table\", \"column\") AS matches FROM (SELECT c.\"table\", c.\"column\", p.strategy, p.ordinal AS ordinal_ "
    "FROM cols c JOIN pats p ON regexp_matches(c.\"column\", p.rx) WHERE shape = 'free_text')) "
    f"SELECT h.\"table\", h.\"column\", strategy, matches, rule IS NOT NULL AS overridden, cells FROM hits h LEFT JOIN ({RULES}) r "
    f"ON r.\"table\" = h.\"table\" AND r.\"column\" = h.\"column\" JOIN ({CELLS}) n ON n.\"table\" = h.\"table\" AND n.\"column\" = h.\"column\" WHERE rn = 1"
)
ORACLES["rule_usage"] = (
    f"SELECT rule AS strategy, count(*) AS rules, count(cells) AS present, CAST(coalesce(sum(cells), 0) AS BIGINT) AS cells FROM ({RULES}) r "
    f"LEFT JOIN ({CELLS}) n ON r.\"table\" = n.\"table\" AND r.\"column\" = n.\"column\" GROUP BY 1"
)
ORACLES["snapshot_diff"] = (
    "SELECT 'customer' AS \"table\", 'c_acctbal' AS \"column\", 'dropped' AS change, CAST(NULL AS VARCHAR) AS shape, count(c_acctbal) AS old_cells, CAST(NULL AS BIGINT) AS new_cells FROM customer "
    "UNION ALL SELECT 'customer', 'c_email', 'added', 'free_text', NULL, count(c_name) FROM customer "
    "UNION ALL SELECT 'orders', 'o_custkey', 'retyped', 'free_text', count(o_custkey), count(o_custkey) FROM orders"
)
ORACLES["resolve_references"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{target}' AS fk_target, '{shape}' AS shape, count({c}) AS cells FROM {t}"
    for t, c, target, shape in (
        ("orders", "o_custkey", "customer.c_custkey", "partner_ref"),
        ("lineitem", "l_partkey", "partsupp.ps_partkey", "other"),
        ("lineitem", "l_suppkey", "partsupp.ps_suppkey", "other"),
        ("customer", "c_nationkey", "nation.n_nationkey", "other"),
    )
)
# columns that hold neither whole numbers nor text
FRACTIONS = (
    "c_acctbal s_acctbal p_retailprice o_totalprice o_orderdate l_quantity l_extendedprice l_discount l_tax l_shipdate ts value embedding"
).split()


def inclusions(family: list[tuple[str, str]]) -> str:
    """Pairs of columns by counting shared values."""
    values = " UNION ALL ".join(f"SELECT '{t}' AS t, '{c}' AS c, CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY 3" for t, c in family)
    return (
        f"(WITH v AS MATERIALIZED ({values}), s AS (SELECT t, c, count(*) AS d, max(n) AS most FROM v GROUP BY t, c) "
        "SELECT a.t AS child_table, a.c AS child_column, b.t AS parent_table, b.c AS parent_column, s.d AS child_values "
        "FROM v a JOIN v b ON a.v = b.v AND (a.t, a.c) <> (b.t, b.c) JOIN s ON s.t = a.t AND s.c = a.c JOIN s p ON p.t = b.t AND p.c = b.c "
        "WHERE p.most = 1 GROUP BY 1, 2, 3, 4, 5 HAVING count(*) = s.d)"
    )


ORACLES["infer_references"] = " UNION ALL ".join(
    inclusions([(t, c) for t, c, is_text, _ in COLUMNS if is_text == text and c not in FRACTIONS]) for text in (False, True)
)



def composite_inclusions() -> str:
    """Every ordered tuple of up to three columns against every other of its size, and then the conditions on parts."""
    columns: dict[str, list[str]] = {}
    for name, column in COMPOSITE_COLUMNS:
        columns.setdefault(name, []).append(column)
    values = " UNION ALL ".join(
        f"SELECT '{t}' AS t, {list(some)} AS c, {some == tuple(c for c in listed if c in some)} AS ordered, concat_ws(',', {', '.join(some)}) AS v, count(*) AS n FROM {t} "
        f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in some)} GROUP BY ALL"
        for t, listed in columns.items()
        for size in (1, 2, 3)
        for some in permutations(listed, size)
    )
    parts = {size: [list(p) for k in range(1, size) for p in combinations(range(1, size + 1), k)] for size in (2, 3)}
    wanted = " UNION ALL ".join(f"SELECT {size} AS size, unnest({p}) AS part" for size, p in parts.items())
    return (
        "WITH lots AS (SELECT DISTINCT l_partkey AS lot_part, l_suppkey AS lot_supplier FROM lineitem), "
        "numbered_lots AS (SELECT DISTINCT l_suppkey AS numbered_supplier, l_partkey AS numbered_part, l_linenumber AS number FROM lineitem), "
        f"v AS MATERIALIZED ({values}), s AS MATERIALIZED (SELECT t, c, count(*) AS d, max(n) AS most FROM v GROUP BY t, c), "
        "i AS MATERIALIZED (SELECT a.t AS ct, a.c AS cc, b.t AS pt, b.c AS pc, s.d, p.most FROM v a JOIN v b ON a.v = b.v AND len(a.c) = len(b.c) "
        "JOIN s ON s.t = a.t AND s.c = a.c JOIN s p ON p.t = b.t AND p.c = b.c WHERE a.ordered "
        "GROUP BY ALL HAVING count(*) = s.d AND (ct <> pt OR len([x for x in list_zip(cc, pc) if x[1] = x[2]]) = 0)), "
        f"w AS ({wanted}), "
        "parts AS (SELECT i.*, [cc[x] for x in w.part] AS some_c, [pc[x] for x in w.part] AS some_p, count(*) OVER (PARTITION BY ct, cc, pt, pc) AS many FROM i JOIN w ON w.size = len(cc) WHERE i.most = 1) "
        "SELECT parts.ct AS child_table, array_to_string(parts.cc, ',') AS child_columns, parts.pt AS parent_table, array_to_string(parts.pc, ',') AS parent_columns, parts.d AS child_values "
        "FROM parts JOIN i j ON j.ct = parts.ct AND j.pt = parts.pt AND j.cc = parts.some_c AND j.pc = parts.some_p AND j.most > 1 "
        "GROUP BY parts.ct, parts.cc, parts.pt, parts.pc, parts.d, parts.many HAVING count(*) = parts.many"
    )


ORACLES["infer_composite_references"] = composite_inclusions()

# --- verification -----------------------------------------------------------------------------

ORACLES["expectations"] = (
    "WITH r AS (SELECT '*' AS \"table\", 'has_tables' AS \"check\", 0 AS violations "
    "UNION ALL SELECT 'payment_token', 'provider_ref_null', 0 "
    "UNION ALL SELECT 'ir_config_parameter', 'database_secret_nonnull', 1 "
    "UNION ALL SELECT 'events', 'purchase_props_dropped', 0 "
    "UNION ALL SELECT 'events', 'click_props_dropped', count(*) FILTER (event_type = 'click' AND props IS NOT NULL) FROM events "
    "UNION ALL SELECT 'events', 'has_rotated_error', CASE WHEN count(*) FILTER (event_type = 'error') > 0 THEN 0 ELSE 1 END FROM events "
    "UNION ALL SELECT 'orders', 'priority_masked', 0 UNION ALL SELECT 'customer', 'no_customer_number', 0) "
    'SELECT "table", "check", CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM r'
)
ORACLES["unchanged_secrets"] = (
    f"WITH {CUSTOMER_SEGMENTS} SELECT c_name, c_mktsegment FROM customer c JOIN moved m USING (c_custkey) "
    "WHERE m.v = c_mktsegment"
)
ORDER_NAME = "concat('Customer#', lpad(CAST(o_custkey AS VARCHAR), 9, '0'))"
ORACLES["join_consistency"] = (
    f"SELECT 'before' AS stage, count(*) AS matches FROM orders JOIN customer ON c_name = {ORDER_NAME} "
    f"UNION ALL SELECT 'after', count(*) FROM (SELECT {email(ORDER_NAME)} AS l FROM orders) JOIN (SELECT {email('c_name')} AS r FROM customer) ON l = r"
)
ORACLES["mapping_conflicts"] = (
    f"WITH pairs AS (SELECT {ORDER_NAME} AS original, {person(ORDER_NAME)} AS masked FROM orders UNION ALL "
    f"SELECT c_name, {person('c_name', 'x')} FROM customer) "
    "SELECT original, count(DISTINCT masked) AS fakes, count(*) AS rows FROM pairs GROUP BY 1 HAVING count(DISTINCT masked) > 1"
)
ORACLES["fake_collisions"] = (
    f"SELECT masked, count(DISTINCT original) AS originals FROM (SELECT c_name AS original, {draw(words.CITIES, md5('c_name', 'city:'))} AS masked FROM customer) "
    "GROUP BY 1 HAVING count(DISTINCT original) > 1"
)
# the bare-account rows (every seventh) keep no country
ORACLES["fake_properties"] = (
    "WITH t AS (SELECT count(*) AS n, count(*) FILTER (c_custkey % 7 <> 0) AS ibans FROM customer) "
    "SELECT property, n AS rows, CASE WHEN property = 'iban_country' THEN ibans ELSE n END AS holds, "
    "CASE WHEN property = 'iban_country' THEN n - ibans ELSE 0 END AS violations FROM t, "
    "(SELECT unnest(['email_domain', 'email_changed', 'phone_form', 'redacted_length', 'redacted_changed', 'iban_length', "
    "'iban_country', 'iban_has_digits', 'bank_digits', 'bank_changed']) AS property)"
)

# --- inventory --------------------------------------------------------------------------------

VERSION = "concat_ws('.', CAST(p_size AS VARCHAR), '0', CAST(p_partkey % 7 AS VARCHAR))"
MODULES = (
    "WITH mods AS (SELECT concat('mod_', CAST(p_partkey AS VARCHAR)) AS name, CASE WHEN p_partkey % 10 = 3 THEN concat('saas~', "
    f"{VERSION}) WHEN p_partkey % 10 <> 4 THEN {VERSION} END AS latest_version, p_size > 5 AS installed FROM part), "
    "found AS (SELECT l_linenumber AS path_ordinal, concat('/code/', CAST(l_suppkey AS VARCHAR)) AS path, concat('mod_', CAST(l_partkey AS VARCHAR)) AS name, "
    "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS version FROM lineitem), "
    "firsts AS (SELECT name, path, version FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY path_ordinal, path, version) AS rn FROM found) WHERE rn = 1) "
)
SERIES = (
    "CASE WHEN regexp_full_match(split_part(coalesce(latest_version, ''), '.', 1), '[0-9]+') AND contains(latest_version, '.') "
    "THEN concat(split_part(latest_version, '.', 1), '.', split_part(latest_version, '.', 2)) ELSE coalesce(latest_version, '') END"
)
MAJOR = "coalesce(TRY_CAST(nullif(regexp_extract(latest_version, '^([0-9]+)', 1), '') AS INTEGER), 0)"
ORACLES["installed_modules"] = MODULES + "SELECT name, coalesce(latest_version, '') AS version FROM mods WHERE installed"
ORACLES["base_version"] = MODULES + f"SELECT latest_version AS version, {SERIES} AS series, {MAJOR} AS major FROM mods WHERE name = 'mod_21'"
ORACLES["module_versions"] = MODULES + f"SELECT name, {MAJOR} AS major, {SERIES} AS series FROM mods"
ORACLES["module_first_found"] = MODULES + "SELECT name, path, version FROM firsts"
ORACLES["module_reconcile"] = MODULES + (
    "SELECT m.name, coalesce(latest_version, '') AS version, path AS code_path, f.version AS code_version, path IS NULL AS missing "
    "FROM mods m LEFT JOIN firsts f ON f.name = m.name WHERE installed"
)
ORACLES["module_missing"] = MODULES + "SELECT name FROM mods WHERE installed AND name NOT IN (SELECT name FROM found)"
ORACLES["module_undeclared"] = MODULES + "SELECT name FROM mods WHERE name NOT IN (SELECT name FROM found)"
ORACLES["search_path"] = (
    "SELECT concat('/code/', CAST(l_suppkey AS VARCHAR)) AS path, min(l_orderkey * 10 + l_linenumber) AS ordinal FROM lineitem GROUP BY 1"
)

# --- bundles ----------------------------------------------------------------------------------

ORACLES["manifest_counts"] = ALL_COUNTS
ORACLES["manifest_schema"] = (
    "WITH cols AS (SELECT table_name AS t, string_agg(column_name || ':' || CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
    "ELSE lower(data_type) END, ',' ORDER BY ordinal_position) AS line FROM information_schema.columns GROUP BY 1) "
    f"SELECT \"table\", sha256(line) AS schema_hash, rows FROM cols JOIN ({ALL_COUNTS}) ON t = \"table\" "
    f"WHERE t IN ({', '.join(quoted(t) for t in TABLES)})"
)
KEYS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id",
    "documents": "doc_id", "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id", "labels": "doc_id", "conversations": "conv_id",
}
ORACLES["bundle_publish"] = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", count(*) AS \"rows\", count(DISTINCT {key}) AS keys FROM {name}" for name, key in KEYS.items()
)

# --- rules on nested values, several files, several shuffles ------------------------------------

ORACLES["mask_nested_rotation"] = "SELECT page_id, 'rotated' AS token, CAST(length(html) AS INTEGER) AS size FROM pages"
ORACLES["mask_subtree_rule"] = f"SELECT conv_id, turn, {redact('text')} AS body, turn AS at, {redact('role')} AS who, CAST(NULL AS VARCHAR) AS full_text FROM conversations"
ORACLES["stream_rotation"] = "SELECT page_id, 'rotated' AS url, CAST(NULL AS VARCHAR) AS html FROM pages"
ORACLES["policies_of_two_files"] = (
    "SELECT 'events' AS \"table\", event_type AS key, count(*) AS rows, count(props) FILTER (event_type NOT LIKE '%purchase%') AS \"left\" FROM events GROUP BY 2 "
    "UNION ALL SELECT 'chat', role, count(*), count(text) FILTER (role <> 'user') FROM conversations GROUP BY 2"
)
THREE = ("o_orderstatus", "o_totalprice", "o_orderpriority")
ORACLES["mask_three_shuffles"] = (
    "WITH "
    + ", ".join(shuffled("orders", ["o_orderkey"], c, salt=f"s3-{c}:").replace("ranked", f"ranked{i}").replace("moved", f"moved{i}") for i, c in enumerate(THREE))
    + " SELECT CAST(NULL AS BIGINT) AS o_orderkey, o.o_custkey, "
    + ", ".join(f"m{i}.v AS {c}" for i, c in enumerate(THREE))
    + " FROM orders o "
    + " ".join(f"JOIN moved{i} m{i} ON m{i}.o_orderkey = o.o_orderkey" for i in range(3))
)
ORACLES["band_edge_types"] = (
    f"SELECT o_orderkey, CAST(least(127, round({noisy('120', 'tiny', 'o_orderkey', salt='edge-')})) AS INTEGER) AS tiny, true AS price_near, "
    f"CAST(greatest(-32768, round({noisy('-32000', 'small', 'o_orderkey', salt='edge-')})) AS INTEGER) AS small FROM orders"
)
ORACLES["leak_scan_nested"] = (
    "SELECT b.text AS needle, 'documents' AS \"table\", c AS \"column\", count(*) AS cells FROM (SELECT DISTINCT text FROM benchmark) b "
    "JOIN documents d ON contains(d.text, b.text), (SELECT unnest(['m.parts.body', 'm.by_text.{key}']) AS c) GROUP BY 1, 3"
)
ORACLES["join_consistency_unique"] = (
    f"SELECT s AS stage, count(*) AS matches FROM orders JOIN customer ON c_name = {ORDER_NAME}, (SELECT unnest(['before', 'after']) AS s) GROUP BY 1"
)
LINE_BBAN = "lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 14, '0')"
CHECKED = "lpad(CAST(98 - CAST({0} || '131400' AS HUGEINT) % 97 AS VARCHAR), 2, '0')"


def feistel(source: str, name: str, tag: str) -> str:
    """CTEs that permute the 14 digits ``v`` of each ``id`` in ``source``; the last is ``name(id, digits)``."""
    steps = [f"{name}_0 AS (SELECT id, CAST(substr(v, 1, 7) AS BIGINT) AS a, CAST(substr(v, 8) AS BIGINT) AS b FROM {source})"]
    for i in range(10):
        new, old = ("a", "b") if i % 2 == 0 else ("b", "a")
        code = number(f"md5(concat('{tag}:14:{i}:', repeat('0', 14), ':0:', {old}))", 1, 15)
        steps.append(f"{name}_{i + 1} AS (SELECT id, ({new} + {code}) % 10000000 AS {new}, {old} FROM {name}_{i})")
    both = "lpad(CAST(a AS VARCHAR), 7, '0') || lpad(CAST(b AS VARCHAR), 7, '0')"
    return ", ".join(steps) + f", {name} AS (SELECT id, {both} AS digits FROM {name}_10)"


ORACLES["fake_accounts_bijective"] = (
    f"WITH src AS (SELECT DISTINCT (l_orderkey, l_linenumber) AS id, {LINE_BBAN} AS v FROM lineitem), "
    + feistel("src", "bank", "p-bank:d") + ", " + feistel("src", "iban", "p-iban:d")
    + f" SELECT id[1] AS l_orderkey, id[2] AS l_linenumber, b.digits AS account, 'DE' || {CHECKED.format('i.digits')} || i.digits AS iban FROM bank b JOIN iban i USING (id)"
)
PHONE_LIKE = f"concat(lpad(CAST(l_orderkey % 90 + 10 AS VARCHAR), 2, '0'), '-', substr({LINE_BBAN}, 5, 3), '-', substr({LINE_BBAN}, 8))"
ORACLES["bijective_summary"] = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, count(*) AS \"rows\", count(DISTINCT {value}) AS originals, count(DISTINCT {value}) AS fakes, count(DISTINCT {value}) AS in_form FROM lineitem"
    for kind, value in {"account": LINE_BBAN, "iban": LINE_BBAN, "phone": PHONE_LIKE, "zip": f"substr({LINE_BBAN}, 10)"}.items()
)
ORACLES["null_binary_column"] = "SELECT doc_id, true AS gone, lang FROM documents"
ORACLES["base_types"] = "SELECT p_partkey, lower(p_brand) AS base FROM part"
ORACLES["schema_snapshot"] = f"SELECT c.\"table\", c.\"column\", ordinal, cells FROM ({INFO}) c JOIN ({CELLS}) n ON n.\"table\" = c.\"table\" AND n.\"column\" = c.\"column\""
ORACLES["manifest_rows"] = ALL_COUNTS
# The columns that the rules and patterns of the shop touch, and what its checks find.
TOUCHED = {
    "customer": "c_name c_acctbal c_mktsegment", "supplier": "s_name s_acctbal", "nation": "n_name", "region": "r_name", "part": "p_name p_brand p_type",
    "orders": "o_orderdate o_totalprice o_orderpriority", "lineitem": "l_shipdate l_extendedprice", "documents": "text", "conversations": "text", "benchmark": "text",
}
FAILED = {"events": "event_type = 'click' AND props IS NOT NULL", "labels": "toxic = 1"}
ORACLES["manifest_observed"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS \"rows\", {' + '.join(f'count({c})' for c in TOUCHED.get(t, '').split()) or 'CAST(0 AS BIGINT)'} AS cells, "
    f"count(*) FILTER ({FAILED.get(t, 'false')}) AS violations FROM {t}"
    for t in TABLES
)
CONTACT = "concat('user', lpad(CAST(user_id AS VARCHAR), 7, '0'), '@mail.test')"
ORACLES["stream_gated_events"] = f"SELECT event_id, event_type, {email(CONTACT)} AS contact, k.props FROM events e JOIN ({ORACLES['key_secret_drop']}) k USING (event_id, event_type)"
ORACLES["stream_held_batches"] = (
    "SELECT CASE WHEN event_id % 4 = 1 THEN 'held' ELSE 'published' END AS status, CASE WHEN event_id % 4 = 1 THEN 'LeakError' END AS reason, count(*) AS \"rows\" FROM events GROUP BY ALL"
)
ORACLES["coverage_gate"] = REPORT + (
    "SELECT count(*) AS columns, CAST(sum(cells) AS BIGINT) AS cells, count(*) = 0 AS passed FROM report WHERE outcome IN ('undeclared_model', 'uncovered')"
)
