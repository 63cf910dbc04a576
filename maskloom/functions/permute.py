"""Keyed permutations of texts: fakes of the same form that never meet, by construction.

Digits and letters are permuted among the texts of the same form (where digits, small and capital letters stand); every other
character stays. The permutation is a Feistel network over the two halves of the number that the digits (or letters)
spell, so it can be undone by whoever has the salt, and different texts stay different. A single character may
come out as it was, as one text in so many of its form does in any permutation.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import md5
from string import ascii_lowercase, ascii_uppercase, digits

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from maskloom.functions.digest import bind, hex_number

ROUNDS = 10
#: Characters that one network covers: a half's number, and a sum of two, fit into 64 bits.
WIDTH = {10: 30, 26: 20}
#: The signs of numbers to the base 26, in the order of the letters they stand for.
SIGNS = "0123456789abcdefghijklmnop"


def _network(text: Column, radix: int, tag: str, tweak: Column) -> Column:
    """A text of at most ``WIDTH[radix]`` signs of a number system, permuted among those of its length."""
    half = WIDTH[radix] // 2
    powers = F.array(*[F.lit(radix**k).cast("bigint") for k in range(half + 1)])
    n = F.length(text)
    left = F.floor(n / 2).cast("int")
    right = n - left

    def number(part: Column) -> Column:
        return F.coalesce((part if radix == 10 else F.conv(part, radix, 10)).try_cast("bigint"), F.lit(0).cast("bigint"))

    def signs(value: Column, length: Column) -> Column:
        plain = value.cast("string")
        return F.lpad(plain if radix == 10 else F.lower(F.conv(plain, 10, radix)), length, F.lit("0"))

    def mixed(value: Column, other: Column, round_no: Column, length: Column) -> Column:
        code = F.md5(F.concat_ws(":", F.lit(tag), n.cast("string"), round_no.cast("string"), tweak, other.cast("string")))
        return (value + hex_number(code, 1, 15)) % F.get(powers, length)

    def step(state: Column, round_no: Column) -> Column:
        first = F.struct(mixed(state["u"], state["v"], round_no, left).alias("u"), state["v"].alias("v"))
        second = F.struct(state["u"].alias("u"), mixed(state["v"], state["u"], round_no, right).alias("v"))
        return F.when(round_no % 2 == 0, first).otherwise(second)

    start = F.struct(number(F.substr(text, F.lit(1), left)).alias("u"), number(F.substr(text, left + 1, right)).alias("v"))
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, start, step, lambda state: F.concat(signs(state["u"], left), signs(state["v"], right)))


def permute_signs(text: Column, radix: int, tag: str, tweak: Column) -> Column:
    """A text of signs of any length: the network runs over windows that overlap by half."""
    width = WIDTH[radix]
    step = width // 2
    last = F.greatest(F.ceil((F.length(text) - width) / step), F.lit(0)).cast("int")

    def window(state: Column, k: Column) -> Column:
        at = k * step
        middle = bind(F.substr(state, at + 1, F.lit(width)), lambda part: _network(part, radix, tag, F.concat_ws(":", tweak, k.cast("string"))))
        return F.concat(F.substr(state, F.lit(1), at), middle, F.substr(state, at + width + 1))

    long = F.aggregate(F.sequence(F.lit(0), last), text, window)
    short = _network(text, radix, tag, F.concat_ws(":", tweak, F.lit("0")))
    return F.when(F.length(text) == 0, text).when(F.length(text) <= width, short).otherwise(long)


def permute_in_place(value: Column, tag: str = "", salt: str = "") -> Column:
    """Digits and letters permuted where they stand; only texts of the same form can become each other."""
    key = salt + tag

    def whole(text: Column) -> Column:
        form = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A")
        digits = F.regexp_replace(text, "[^0-9]", "")
        letters = F.translate(F.lower(F.regexp_replace(text, "[^A-Za-z]", "")), ascii_lowercase, SIGNS)
        new_digits = permute_signs(digits, 10, key + "d", form)

        def placed(d: Column) -> Column:
            def put(w: Column) -> Column:
                def step(state: Column, char: Column) -> Column:
                    at_digit, at_letter = F.substr(d, state["i"], F.lit(1)), F.substr(w, state["j"], F.lit(1))

                    def grown(i: int, j: int, out: Column) -> Column:
                        return F.struct((state["i"] + i).alias("i"), (state["j"] + j).alias("j"), F.concat(state["out"], out).alias("out"))

                    letter = F.translate(at_letter, SIGNS, ascii_lowercase)
                    return (
                        F.when(char.rlike("^[0-9]"), grown(1, 0, at_digit))
                        .when(char.rlike("^[a-z]"), grown(0, 1, letter))
                        .when(char.rlike("^[A-Z]"), grown(0, 1, F.upper(letter)))
                        .otherwise(grown(0, 0, char))
                    )

                start = F.struct(F.lit(1).alias("i"), F.lit(1).alias("j"), F.lit("").alias("out"))
                return F.aggregate(F.split(text, ""), start, step, lambda state: state["out"])

            return bind(permute_signs(letters, 26, key + "l", F.concat_ws(":", form, d)), put)

        # Most numbers are digits alone: nothing to take apart, and the form is all zeros.
        plain = permute_signs(text, 10, key + "d", F.repeat(F.lit("0"), F.length(text)))
        return F.when(text.rlike(r"^[0-9]+\z"), plain).otherwise(bind(new_digits, placed))

    return F.when(value.isNotNull(), bind(value.cast("string"), whole))


def permuter(tag: str = "", salt: str = "") -> Callable[[str], str]:
    """:func:`permute_in_place` for a worker: the same permutation of one text, at a few microseconds.

    All it needs travels inside it, so workers need not have this package.
    """
    key, rounds, width_of, signs = (salt + tag).encode(), ROUNDS, dict(WIDTH), SIGNS
    form_of = str.maketrans(digits + ascii_lowercase + ascii_uppercase, "0" * 10 + "a" * 26 + "A" * 26)
    to_signs, to_letters = str.maketrans(ascii_lowercase + ascii_uppercase, signs * 2), str.maketrans(signs, ascii_lowercase)
    known: dict[tuple, list[tuple[bytes, bytes]]] = {}

    def starts(kind: bytes, n: int, tweak: str) -> list[tuple[bytes, bytes]]:
        """What is hashed with the other half, two rounds at a time; forms are few."""
        if (kind, n, tweak) not in known:
            if len(known) >= 1000:
                known.clear()
            each = [b"%s%s:%d:%d:%s:" % (key, kind, n, i, tweak.encode()) for i in range(rounds)]
            each = [start.replace(b"%", b"%%") + b"%d" for start in each]
            known[kind, n, tweak] = list(zip(each[::2], each[1::2]))
        return known[kind, n, tweak]

    def spelled(value: int, radix: int, length: int) -> str:
        if radix == 10:
            return str(value).zfill(length) if length else ""
        out = ""
        for _ in range(length):
            value, rest = divmod(value, radix)
            out = signs[rest] + out
        return out

    def network(text: str, radix: int, kind: bytes, tweak: str) -> str:
        n = len(text)
        left = n // 2
        u, v = int(text[:left] or "0", radix), int(text[left:], radix)
        low, high = radix**left, radix ** (n - left)
        for even, odd in starts(kind, n, tweak):
            u = (u + (int.from_bytes(md5(even % v).digest()[:8]) >> 4)) % low
            v = (v + (int.from_bytes(md5(odd % u).digest()[:8]) >> 4)) % high
        return spelled(u, radix, left) + spelled(v, radix, n - left)

    def windows(text: str, radix: int, kind: bytes, tweak: str) -> str:
        width = width_of[radix]
        step = width // 2
        for k in range(max(0, -(-(len(text) - width) // step)) + 1 if text else 0):
            at = k * step
            text = text[:at] + network(text[at : at + width], radix, kind, f"{tweak}:{k}") + text[at + width :]
        return text

    def permuted(text: str) -> str:
        if text.isascii() and text.isdigit():
            return windows(text, 10, b"d", "0" * len(text))
        form = text.translate(form_of)
        numbers = windows("".join([c for c, f in zip(text, form) if f == "0"]), 10, b"d", form)
        letters = windows("".join([c for c, f in zip(text, form) if f == "a" or f == "A"]).translate(to_signs), 26, b"l", f"{form}:{numbers}")
        number, letter = iter(numbers), iter(letters.translate(to_letters))
        return "".join([next(number) if f == "0" else next(letter) if f == "a" else next(letter).upper() if f == "A" else f for f in form])

    return permuted


def on_workers(value: Column, each: Callable[[str], str | None], otherwise: Column) -> Column:
    """``each`` text by a function on the workers; where that gives none, and for a text that is no UTF-8, ``otherwise``."""

    @F.arrow_udf("string")
    def mapped(texts: pa.Array) -> pa.Array:
        return pa.array([None if text is None else each(text) for text in texts.to_pylist()], pa.string())

    return F.coalesce(mapped(F.when(F.is_valid_utf8(value), value)), otherwise)


def walk(value: Column, permute: Callable[[Column], Column], inside: Callable[[Column], Column], otherwise: Column, limit: int = 12) -> Column:
    """Cycle walking: permute until ``inside`` holds again, so that the texts inside are permuted among themselves.

    ``limit`` should leave nothing in practice; what is still outside then becomes ``otherwise``.
    """
    found = F.aggregate(F.sequence(F.lit(2), F.lit(limit)), permute(value), lambda text, _: F.when(inside(text), text).otherwise(permute(text)))
    return bind(found, lambda text: F.when(inside(text), text).otherwise(otherwise))


def has_signs(value: Column) -> Column:
    return value.rlike("[0-9A-Za-z]")
