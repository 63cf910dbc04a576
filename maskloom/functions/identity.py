"""Fake names, contacts and addresses drawn from word lists."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskloom.functions import words
from maskloom.functions.digest import digest, draw, hex_number

# Fixed value: the reserved domain of every fake address.
FAKE_DOMAIN = "example.invalid"


def fake_person_name(
    value: Column,
    salt: str = "",
    first: Sequence[str] = words.FIRST_NAMES,
    last: Sequence[str] = words.LAST_NAMES,
) -> Column:
    code = digest(value, "person:", salt)
    return F.concat(draw(first, code, 1), F.lit(" "), draw(last, code, 9))


def fake_company_name(value: Column, salt: str = "") -> Column:
    code = digest(value, "company:", salt)
    return F.concat(
        draw(words.COMPANY_ADJECTIVES, code, 1),
        F.lit(" "),
        draw(words.COMPANY_NOUNS, code, 9),
        F.lit(" "),
        draw(words.COMPANY_FORMS, code, 17),
    )


def fake_email(
    value: Column,
    salt: str = "",
    first: Sequence[str] = words.FIRST_NAMES,
    last: Sequence[str] = words.LAST_NAMES,
) -> Column:
    """``first.last@example.invalid``.

    The local part keeps ``[a-z0-9.]`` after lower-casing. Cleaning works character by character,
    so the lists are cleaned once here instead of every row.
    """
    code = digest(value, "email:", salt)
    left, right = _address_words(first), _address_words(last)
    local = F.concat(draw(left, code, 1), F.lit("."), draw(right, code, 9))
    if not all(left + right):
        local = F.when(F.replace(local, F.lit("."), F.lit("")) == "", F.lit("user")).otherwise(local)
    return F.concat(local, F.lit("@" + FAKE_DOMAIN))


def _address_words(entries: Sequence[str]) -> list[str]:
    return [re.sub("[^a-z0-9.]", "", entry.lower()) for entry in entries]


def fake_phone(value: Column, salt: str = "") -> Column:
    """``NNN-NNN-NNNN x`` and an extension of three or four digits."""
    code = digest(value, "phone:", salt)

    def between(start: int, low: int, count: int) -> Column:
        return (hex_number(code, start, 8) % F.lit(count) + F.lit(low)).cast("string")

    return F.concat(
        between(1, 100, 900),
        F.lit("-"),
        between(9, 100, 900),
        F.lit("-"),
        between(17, 1000, 9000),
        F.lit(" x"),
        between(25, 100, 9900),
    )


def fake_street_address(value: Column, salt: str = "") -> Column:
    code = digest(value, "street:", salt)
    return F.concat(
        (hex_number(code, 1, 8) % F.lit(999) + F.lit(1)).cast("string"),
        F.lit(" "),
        draw(words.STREETS, code, 9),
        F.lit(" "),
        draw(words.STREET_KINDS, code, 17),
    )


def fake_city(value: Column, salt: str = "", cities: Sequence[str] = words.CITIES) -> Column:
    return draw(cities, digest(value, "city:", salt))


def fake_zip(value: Column, salt: str = "") -> Column:
    number = hex_number(digest(value, "zip:", salt), 1, 8) % F.lit(100000)
    return F.lpad(number.cast("string"), 5, "0")


def told_apart(fake: Column, value: Column, salt: str = "") -> Column:
    """A fake with 16 digits of its original's digest, so that different originals stay different.

    An address gets them before its ``@``; anything else gets them at the end.
    """
    suffix = F.substring(digest(value, "unique:", salt), 1, 16)
    return F.when(fake.contains("@"), F.concat(F.substring_index(fake, "@", 1), F.lit("."), suffix, F.lit("@"), F.substring_index(fake, "@", -1))).otherwise(
        F.concat(fake, F.lit(" "), suffix)
    )
