"""Format-preserving fakes for tax and bank numbers."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskloom.functions.digest import bind, digest, digit_stream
from maskloom.functions.generalize import redact_text
from maskloom.functions.identity import told_apart
from maskloom.functions.permute import has_signs, on_workers, permute_in_place, permuter, walk

# Fixed value: what counts as an international bank account number.
IBAN_SHAPE = r"^[A-Za-z]{2}[0-9]{2}[0-9A-Za-z]+\z"
COUNTRY_PREFIX = r"^[A-Za-z]{2}"


def fake_bank_account(value: Column, seed_text: Column | None = None, salt: str = "") -> Column:
    """Same length, digits only."""
    text = value.cast("string")
    return digit_stream(_or(seed_text, text), F.length(text), "bank:", salt)


def fake_iban(value: Column, seed_text: Column | None = None, salt: str = "") -> Column:
    """Same country and length, new account digits, valid mod-97 check digits.

    Only the generic checksum holds; national account rules are not modelled. Values that are not
    shaped like an international number fall back to :func:`fake_bank_account`.
    """
    text = value.cast("string")
    source = _or(seed_text, text)
    country = F.upper(F.substring(text, 1, 2))
    account = digit_stream(source, F.length(text) - 4, "iban:", salt)

    def assembled(bban: Column) -> Column:
        check = F.lit(98) - mod97(F.concat(bban, _letter_number(country, 1), _letter_number(country, 2), F.lit("00")))
        return F.concat(country, F.lpad(check.cast("string"), 2, "0"), bban)

    return F.when(text.rlike(IBAN_SHAPE), bind(account, assembled)).otherwise(
        fake_bank_account(text, source, salt)
    )


def _letter_number(country: Column, position: int) -> Column:
    return (F.ascii(F.substring(country, position, 1)) - 55).cast("string")


def mod97(digits: Column) -> Column:
    """Remainder by 97 of a digit text of any length, fourteen digits at a time where a decimal cannot hold it."""
    chunk = 14

    def step(rest: Column, index: Column) -> Column:
        part = F.substr(digits, index * chunk + 1, F.lit(chunk))
        shift = F.rpad(F.lit("1"), F.length(part) + 1, F.lit("0")).cast("bigint")
        return (rest * shift + part.cast("bigint")) % F.lit(97)

    chunks = F.sequence(F.lit(0), F.floor((F.length(digits) - 1) / chunk).cast("int"))
    whole = (digits.try_cast("decimal(38,0)") % F.lit(97).cast("decimal(2,0)")).cast("bigint")
    return F.coalesce(whole, F.aggregate(chunks, F.lit(0).cast("bigint"), step))


def unique_text(value: Column, tag: str, salt: str = "", nested: bool = False) -> Column:
    """A number in its own form, each digit and letter replaced; different numbers stay different.

    A text without any of them is redacted and told apart by its digest. ``nested`` values stand inside a lambda, where
    no Python runs: they are permuted by native expressions, alike but some fifty times slower.
    """
    text = value.cast("string")
    plain = _unique_text(text, tag, salt)
    if nested:
        return plain
    permuted, sign = permuter(tag, salt), re.compile("[0-9A-Za-z]")
    return on_workers(text, lambda t: permuted(t) if sign.search(t) else None, plain)


def _unique_text(text: Column, tag: str, salt: str) -> Column:
    return F.when(has_signs(text), permute_in_place(text, tag, salt)).otherwise(told_apart(redact_text(text), text, salt))


def _as_digits(text: Column) -> Column:
    """Every capital letter as its number from 10 to 35."""
    spelled = F.array_join(F.transform(F.split(text, ""), lambda c: F.when(c.rlike("^[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c)), "")
    return F.when(text.rlike("[A-Z]"), spelled).otherwise(text)


def _checked(text: Column, bban: Column, check: Column) -> Column:
    """The number whose remainder by 97 the check digits decide."""
    return F.concat(_as_digits(bban), _letter_number(text, 1), _letter_number(text, 2), check)


def valid_iban(text: Column) -> Column:
    """Capitals and digits whose check digits are the ones that the rest asks for."""
    shaped = text.rlike(r"^[A-Z]{2}[0-9]{2}[0-9A-Z]+\z") & F.substring(text, 3, 2).between("02", "98")
    return F.when(shaped, mod97(_checked(text, F.substr(text, F.lit(5)), F.substring(text, 3, 2))) == 1).otherwise(F.lit(False))


def unique_iban(value: Column, seed_text: Column | None = None, salt: str = "", nested: bool = False) -> Column:
    """Same country and form, valid check digits, and never one fake for two different valid numbers.

    Anything else is permuted in place among the texts that are no valid number, so the two kinds do not meet.
    ``nested`` as for :func:`unique_text`.
    """

    def valid(text: Column) -> Column:
        def assembled(bban: Column) -> Column:
            check = F.lit(98) - mod97(_checked(text, bban, F.lit("00")))
            return F.concat(F.substring(text, 1, 2), F.lpad(check.cast("string"), 2, "0"), bban)

        return bind(permute_in_place(F.substr(text, F.lit(5)), "iban:", salt), assembled)

    def other(text: Column) -> Column:
        apart = told_apart(redact_text(text), text, salt)
        walked = walk(text, lambda t: permute_in_place(t, "no-iban:", salt), lambda t: ~valid_iban(t), apart)
        return F.when(has_signs(text), walked).otherwise(apart)

    source = _or(seed_text, value).cast("string")
    plain = F.when(source.isNotNull(), bind(source, lambda text: F.when(valid_iban(text), valid(text)).otherwise(other(text))))
    return plain if nested else on_workers(source, _valid_ibans(salt), plain)


def _valid_ibans(salt: str) -> Callable[[str], str | None]:
    """The fake of a valid number, for a worker; None for any other text."""
    permuted, shape = permuter("iban:", salt), re.compile(r"[A-Z]{2}[0-9]{2}[0-9A-Z]+")

    def rest(text: str) -> int:
        return int("".join([str(int(c, 36)) for c in text])) % 97

    def fake(text: str) -> str | None:
        country, check = text[:2], text[2:4]
        if not shape.fullmatch(text) or not "02" <= check <= "98" or rest(text[4:] + country + check) != 1:
            return None
        bban = permuted(text[4:])
        return f"{country}{98 - rest(bban + country + '00'):02d}{bban}"

    return fake


def unique_bank_account(value: Column, seed_text: Column | None = None, salt: str = "", nested: bool = False) -> Column:
    """Same length and form (digits stay digits), one to one."""
    return unique_text(_or(seed_text, value), "bank:", salt, nested)


def fake_vat(value: Column, seed_text: Column | None = None, salt: str = "") -> Column:
    """Keeps a two-letter prefix (upper-cased) and the length.

    With a prefix every later character becomes a digit, separators included. Without one, digits
    are replaced in place and the rest is kept. National checksums are not modelled. A value that
    would come out unchanged (no digits to replace) is redacted instead.
    """
    text = value.cast("string")
    source = _or(seed_text, text)
    prefixed = F.concat(
        F.upper(F.substring(text, 1, 2)),
        digit_stream(source, F.length(text) - 2, "vat:", salt),
    )

    def step(state: Column, char: Column) -> Column:
        def with_digit(fresh: Column) -> Column:
            digit = F.substring(F.translate(fresh, "abcdef", ""), 1, 1)
            return F.struct(fresh.alias("seed"), F.concat(state["out"], digit).alias("out"))

        kept = F.struct(state["seed"].alias("seed"), F.concat(state["out"], char).alias("out"))
        replaced = bind(F.md5(F.concat(state["seed"], state["out"])), with_digit)
        return F.when(char.rlike("^[0-9]"), replaced).otherwise(kept)

    start = F.struct(digest(source, "vat:", salt).alias("seed"), F.lit("").alias("out"))
    in_place = F.aggregate(F.split(text, ""), start, step, lambda state: state["out"])
    fake = F.when(text.rlike(COUNTRY_PREFIX), prefixed).otherwise(in_place)
    return bind(fake, lambda out: F.when(F.upper(out) == F.upper(text), redact_text(text)).otherwise(out))


def _or(column: Column | None, default: Column) -> Column:
    return default if column is None else column
