"""Deterministic digests: the source of every repeatable choice.

Only md5 and text slicing are used, so the same value gives the same result on any engine,
partitioning or retry.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED_DIGITS = 15


def digest(value: Column, tag: str = "", salt: str = "") -> Column:
    """md5 hex text of ``salt + tag + value``."""
    text = value.cast("string")
    prefix = salt + tag
    return F.md5(F.concat(F.lit(prefix), text) if prefix else text)


def hex_number(hex_text: Column, start: int, width: int) -> Column:
    """The hex digits ``start .. start+width-1`` (1-based, at most 15) as a bigint."""
    return F.conv(F.substring(hex_text, start, width), 16, 10).cast("bigint")


def seed(value: Column, tag: str = "", salt: str = "") -> Column:
    """60-bit seed: the first 15 hex digits of the digest."""
    return hex_number(digest(value, tag, salt), 1, SEED_DIGITS)


def draw(words: Sequence[str], hex_text: Column, start: int = 1, width: int = 8) -> Column:
    """One word of a list, chosen by a slice of a digest."""
    index = hex_number(hex_text, start, width) % F.lit(len(words))
    return F.get(F.array(*[F.lit(w) for w in words]), index.cast("int"))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digit_stream(seed_text: Column, length: Column, tag: str, salt: str = "") -> Column:
    """A digit text of exactly ``length`` characters that depends on ``seed_text`` only.

    Each round hashes the running seed with the digits so far and appends the decimal digits of
    the new seed's first eight characters (five on average). The rounds allowed are more than
    twice the rounds needed; the final pad only states the length guarantee.
    """

    def extended(state: Column) -> Column:
        return F.concat(state["out"], F.translate(F.substring(state["seed"], 1, 8), "abcdef", ""))

    def step(state: Column, _round: Column) -> Column:
        out = extended(state)
        grown = F.struct(F.md5(F.concat(state["seed"], out)).alias("seed"), out.alias("out"))
        return F.when(F.length(state["out"]) >= length, state).otherwise(grown)

    start = F.struct(F.md5(digest(seed_text, tag, salt)).alias("seed"), F.lit("").alias("out"))
    rounds = F.sequence(F.lit(1), F.floor(length / 2).cast("int") + 8)
    digits = F.aggregate(rounds, start, step, lambda state: state["out"])
    return F.rpad(F.substr(digits, F.lit(1), length), length, F.lit("0"))
