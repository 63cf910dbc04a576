"""Text helpers: file extensions, versions, and literal replacement in nested values."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def extension(filename: Column) -> Column:
    """The last ``.suffix`` of a file name with its dot, or an empty text."""
    return F.regexp_extract(filename, r"(\.[^.]+)\z", 1)


def major_version(version: Column) -> Column:
    """Leading digits as an int, 0 when there are none."""
    return F.coalesce(F.nullif(F.regexp_extract(version, r"^(\d+)", 1), F.lit("")).cast("int"), F.lit(0))


def release_series(version: Column) -> Column:
    """``a.b`` of ``a.b.c.d`` when ``a`` is a number, else the version as it is."""
    text = F.coalesce(version, F.lit(""))
    parts = F.split(text, r"\.")
    return F.when(
        F.get(parts, F.lit(0)).rlike(r"^\d+\z") & (F.size(parts) >= 2),
        F.concat_ws(".", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))),
    ).otherwise(text)


def base_type(type_name: Column) -> Column:
    """Type name in lower case without modifiers: ``VARCHAR(20)`` -> ``varchar``."""
    return F.trim(F.lower(F.regexp_replace(type_name, r"(?s)\(.*", "")))


def replace_each(text: Column, pairs: Column) -> Column:
    """Replace ``old`` by ``new`` for every pair of an array, in array order."""
    return F.aggregate(pairs, text, lambda out, pair: F.replace(out, pair["old"], pair["new"]))


def rewrite_strings(value: Column, dtype: T.DataType, rewrite: Callable[[Column], Column]) -> Column:
    """Apply ``rewrite`` to every string leaf of a nested value; map keys stay as they are."""
    if isinstance(dtype, T.StringType):
        return rewrite(value)
    if not _has_string_leaf(dtype):
        return value
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: rewrite_strings(item, dtype.elementType, rewrite))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _key, item: rewrite_strings(item, dtype.valueType, rewrite))
    for child in dtype.fields:
        if _has_string_leaf(child.dataType):
            value = value.withField(
                f"`{child.name}`", rewrite_strings(value.getField(child.name), child.dataType, rewrite)
            )
    return value


def _has_string_leaf(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_string_leaf(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _has_string_leaf(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(_has_string_leaf(child.dataType) for child in dtype.fields)
    return isinstance(dtype, T.StringType)


def rewrite_json(text: Column, schema: T.DataType, rewrite: Callable[[Column], Column]) -> Column:
    """:func:`rewrite_strings` for JSON kept as text, when its schema is known."""
    return F.to_json(rewrite_strings(F.from_json(text, schema), schema, rewrite))


class PairReplacer:
    """The replacements of a list of pairs, one pair after the other, without trying those that cannot apply.

    An automaton tells which pairs a text holds; the first of them in list order is applied, and the changed text
    is looked at again for the pairs after it. That is the outcome of trying every pair in turn.
    """

    def __init__(self, pairs: list[tuple[str, str]]):
        import ahocorasick

        self.pairs = pairs
        self.automaton = ahocorasick.Automaton()
        for number, (old, _) in reversed(list(enumerate(pairs))):
            self.automaton.add_word(old, number)  # of equal names the first counts
        if pairs:
            self.automaton.make_automaton()

    def text(self, text: str) -> str:
        done = -1
        while self.pairs:
            number = min((n for _, n in self.automaton.iter(text) if n > done), default=None)
            if number is None:
                break
            text, done = text.replace(*self.pairs[number]), number
        return text

    def json(self, text: str) -> str:
        """String values of JSON of any shape; keys stay as they are."""

        def rewritten(node):
            if isinstance(node, str):
                return self.text(node)
            if isinstance(node, dict):
                return {key: rewritten(item) for key, item in node.items()}
            return [rewritten(item) for item in node] if isinstance(node, list) else node

        return json.dumps(rewritten(json.loads(text)), ensure_ascii=False)


_replacers: dict[int, PairReplacer] = {}


def pair_replacer(shared, json_text: bool = False):
    """A column function that replaces the pairs of a broadcast list in texts, or in the values of JSON texts."""
    token = uuid.uuid4().int

    @F.pandas_udf(T.StringType())
    def replaced(texts: pd.Series) -> pd.Series:
        if token not in _replacers:
            while len(_replacers) >= 4:
                _replacers.pop(next(iter(_replacers)))
            _replacers[token] = PairReplacer(shared.value)
        one = _replacers[token].json if json_text else _replacers[token].text
        return pd.Series([None if text is None else one(text) for text in texts], dtype=object)

    return replaced


def rewrite_path(
    value: Column, dtype: T.DataType, path: list[str], rewrite: Callable[[Column, T.DataType], Column]
) -> Column:
    """Apply ``rewrite`` at one path inside a nested value (``[]`` enters array items)."""
    if not path:
        return rewrite(value, dtype)
    head, rest = path[0], path[1:]
    if head == "[]":
        return F.transform(value, lambda item: rewrite_path(item, dtype.elementType, rest, rewrite))
    if head == "{}":
        return F.transform_values(value, lambda _key, item: rewrite_path(item, dtype.valueType, rest, rewrite))
    child = dtype[head]
    return value.withField(f"`{head}`", rewrite_path(value.getField(head), child.dataType, rest, rewrite))
