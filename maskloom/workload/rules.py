"""The rulebook of the shop dataset, as parsed documents."""

from maskloom.plans.rulebook import Rulebook, rulebook_from, validate

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

STRATEGIES = {
    "strategies": {
        name: None
        for name in (
            "drop keep fake_person_name fake_company_name fake_email fake_phone fake_street_address fake_city "
            "fake_zip fake_vat fake_iban fake_bank_account_number partial_keep_last4 generalize_year "
            "generalize_numeric_band shuffle_within_column redact_freetext null_binary rotate_secret"
        ).split()
    }
}

PATTERNS = {
    "column_patterns": [
        {"match": "_name$", "strategy": "redact_freetext", "shapes": ["free_text"]},
        {"match": "^(p|r)_", "strategy": "partial_keep_last4", "shapes": ["free_text"]},
        {"match": "(^|_)text$", "strategy": "redact_freetext", "shapes": ["free_text"]},
        {"match": "key$", "strategy": "drop", "shapes": ["free_text", "binary"]},
    ]
}

SALT = "shop-"
BAND = {"strategy": "generalize_numeric_band", "salt": SALT}

SHOP = {
    "customer": {
        "key": ["c_custkey"],
        "refs": {"c_nationkey": "nation.n_nationkey"},
        "fields": {
            "c_name": "fake_person_name",
            "c_nationkey": "keep",
            "c_acctbal": BAND,
            "c_mktsegment": {"strategy": "shuffle_within_column", "salt": SALT},
        },
    },
    "supplier": {
        "key": ["s_suppkey"],
        "fields": {"s_name": "fake_company_name", "s_acctbal": BAND, "s_website": "drop"},
    },
    "nation": {"key": ["n_nationkey"], "fields": {"n_name": "fake_company_name"}},
    "orders": {
        "key": ["o_orderkey"],
        "refs": {"o_custkey": "customer.c_custkey"},
        "fields": {
            "o_orderdate": "generalize_year",
            "o_totalprice": BAND,
            "o_orderpriority": "partial_keep_last4",
        },
    },
    "lineitem": {
        "key": ["l_orderkey", "l_linenumber"],
        "fields": {
            "l_shipdate": "generalize_year",
            "l_extendedprice": BAND,
            "l_returnflag": "keep",
        },
    },
    "documents": {"key": ["doc_id"], "fields": {"text": "redact_freetext", "lang": "keep"}},
    "conversations": {"key": ["conv_id", "turn"], "fields": {"role": "keep"}},
    "payments": {"fields": {"token": {"strategy": "rotate_secret", "rotate": "token"}}},
}

POLICIES = {
    "key_value_policies": [
        {
            "table": "events",
            "key": "event_type",
            "value": "props",
            "drop_regex": "(?i)(sign|purchase|error)",
            "rotate": {"error": {"constant": "{}"}},
            "distinctive": False,
        }
    ],
    "content_policies": [
        {
            "table": "pages",
            "drop_columns": ["html"],
            "scrub_parents": ["http", "https"],
            "parent": "scheme",
            "filename": "url",
            "row_id": "page_id",
            "prefix": "page_",
        }
    ],
}


#: Where references of several columns are looked for.
COMPOSITE_COLUMNS = [
    *[("lineitem", c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
    *[("lots", c) for c in ("lot_part", "lot_supplier")],
    *[("numbered_lots", c) for c in ("numbered_supplier", "numbered_part", "number")],
]


def shop_rulebook() -> Rulebook:
    book = rulebook_from(
        {"00_strategies": STRATEGIES, "05_patterns": PATTERNS, "10_shop": SHOP, "50_policies": POLICIES}
    )
    validate(book)
    return book
