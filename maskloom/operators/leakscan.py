"""Leak scan: which original values still occur, as substrings, anywhere in a dataset.

Exact at every size. Needles that fit a checked budget are sent to the tasks as one
multi-pattern automaton, so the text is read once whatever the number of needles. Needles beyond
the budget are matched by joins whose work grows with text plus hits, never with needles x text.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.plans.schema import node_type
from maskloom.session import ensure_checkpoint_dir, scratch_dir, ship_package

HITS_DDL = "needle string, table string, column string, cells bigint"

# Budget of the automaton: every Python worker builds its own, at some 50 bytes per character.
MAX_AUTOMATON_NEEDLES = 200_000
MAX_AUTOMATON_CHARS = 4_000_000

# Copies of a gram row on the needle side; text rows of one hot gram spread over this many tasks.
#: Characters of a long needle that are looked for first.
HEAD = 256
GRAM_SALT = 16

# Filter of needle beginnings ahead of the joins: 8 MB at most for each of so many machine words.
MAX_FILTER_BITS = 26
FILTER_WORDS = 3

# Needles below this length are cut out where one may begin; a cell with more than so many such places is cut into grams.
MAX_CUT = 64
MAX_BEGINNINGS = 64

# Largest number of candidate places sent to every task; more are joined with a shuffle.
MAX_BROADCAST_PLACES = 1_000_000

# Largest number of grams of the written cells sent to every task, to leave out needles' grams that are not among them.
MAX_BROADCAST_GRAMS = 250_000

# Cells of numbers and dates consist of these characters alone, and can only hold needles that do so too.
NO_FIGURE = "[^0-9.:+ -]"


@dataclass(frozen=True)
class GramClass:
    """Needles of ``low <= length < high`` are found by ``size``-grams taken every ``stride``.

    ``size + stride - 1 <= low``: a needle holds a whole gram at every alignment, so one of its
    first ``stride`` grams is among the sampled grams of any text it occurs in. Grams grow with the
    needles, so a match is strong evidence, and long needles sample the text sparsely.
    """

    low: int
    high: int

    @property
    def stride(self) -> int:
        return max(1, self.low // 2)

    @property
    def size(self) -> int:
        return self.low - self.stride + 1


# 1-3, 4-7, 8-15, ... characters; the last class is open.
GRAM_CLASSES = (
    GramClass(1, 4),
    *[GramClass(2**i, 2 ** (i + 1)) for i in range(2, 15)],
    GramClass(2**15, 2**31 - 1),
)


def as_text(column: Column, dtype: T.DataType) -> Column:
    """A value as text. Binary content is compared by its digest: a cell of it may be a whole file."""
    if isinstance(dtype, T.BinaryType):
        return F.concat(F.lit("sha256:"), F.sha2(column, 256))
    return F.to_json(column) if isinstance(dtype, T.VariantType) else column.cast("string")


def _nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def leaf_texts(path: str, value: Column, dtype: T.DataType) -> list[tuple[str, Column]]:
    """``(path, array of texts)`` of every leaf below a value, map keys included.

    Leaves are taken as they are: in JSON a quote or a line break would be escaped, and missed.
    """
    if isinstance(dtype, T.StructType):
        return [leaf for child in dtype.fields for leaf in leaf_texts(f"{path}.{child.name}", value.getField(child.name), child.dataType)]
    if isinstance(dtype, T.MapType):
        keys = leaf_texts(f"{path}.{{key}}", F.map_keys(value), T.ArrayType(dtype.keyType))
        return keys + leaf_texts(f"{path}.{{}}", F.map_values(value), T.ArrayType(dtype.valueType))
    if not isinstance(dtype, T.ArrayType):
        return [(path, F.array(as_text(value, dtype)))]
    if isinstance(dtype.elementType, (T.NumericType, T.BooleanType)):
        return [(path, F.array(F.to_json(value)))]  # nothing in it needs escaping, and a vector stays one cell
    if not _nested(dtype.elementType):
        return [(path, F.transform(value, lambda item: as_text(item, dtype.elementType)))]
    names = [name for name, _ in leaf_texts(path, F.col("x"), dtype.elementType)]
    return [(name, _each(value, lambda item: leaf_texts(path, item, dtype.elementType), n)) for n, name in enumerate(names)]


def _each(items: Column, leaves: Callable[[Column], list], number: int) -> Column:
    """One leaf of every item, in one array."""

    def one(item: Column) -> Column:
        found = leaves(item)[number]
        return F.coalesce(found[1] if isinstance(found, tuple) else found, F.array().cast("array<string>"))

    return F.flatten(F.transform(items, one))


def _named(name: str, texts: Column) -> Column:
    return F.transform(F.coalesce(texts, F.array().cast("array<string>")), lambda text: F.struct(F.lit(name).alias("column"), text.alias("value")))


def cells_of(table: str, frame: DataFrame) -> DataFrame:
    """``table, column, value``: every non-null cell of a table as text, and every leaf of nested ones."""
    flat = [f for f in frame.schema.fields if not _nested(f.dataType)]
    parts = []
    if flat:
        texts = frame.select(*[as_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in flat])
        parts.append(texts.unpivot([], [F.col(f"`{c}`") for c in texts.columns], "column", "value"))
    leaves = [leaf for f in frame.schema.fields if _nested(f.dataType) for leaf in leaf_texts(f.name, F.col(f"`{f.name}`"), f.dataType)]
    if leaves:
        parts.append(frame.select(F.inline(F.concat(*[_named(name, texts) for name, texts in leaves]))))
    cells_ = reduce(DataFrame.unionByName, parts)
    return cells_.where(F.col("value").isNotNull()).select(F.lit(table).alias("table"), "column", "value")


def cells(dataset: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [cells_of(name, frame) for name, frame in dataset.items()])


def original_values(dataset: Mapping[str, DataFrame], columns: Sequence[tuple[str, str]]) -> DataFrame:
    """``value, table, column``: distinct non-null values of the named source columns or nested paths.

    What is left out because the dataset has no such column is the caller's to know; none at all is an error.
    """
    parts = []
    for table, path in columns:
        if table not in dataset or (dtype := node_type(dataset[table].schema, path)) is None:
            continue
        frame = dataset[table]
        texts = F.flatten(F.array(*[F.coalesce(t, F.array().cast("array<string>")) for t in _texts_at(frame, path, dtype)]))
        parts.append(
            frame.select(F.explode(texts).alias("value"))
            .where(F.col("value").isNotNull())
            .distinct()
            .select("value", F.lit(table).alias("table"), F.lit(path).alias("column"))
        )
    if not parts:
        raise ValueError("no column of the dataset was named")
    return reduce(DataFrame.unionByName, parts)


def _texts_at(frame: DataFrame, path: str, dtype: T.DataType) -> list[Column]:
    """The texts of all leaves at or below a path."""
    if path in frame.columns:
        return [texts for _, texts in leaf_texts(path, F.col(f"`{path}`"), dtype)]

    def down(value: Column, kind: T.DataType, rest: list[str]) -> list[Column]:
        if not rest:
            return [texts for _, texts in leaf_texts("", value, kind)]
        if rest[0] not in ("[]", "{}"):
            return down(value.getField(rest[0]), kind[rest[0]].dataType, rest[1:])
        items, inner = (value, kind.elementType) if rest[0] == "[]" else (F.map_values(value), kind.valueType)
        return [_each(items, lambda item: down(item, inner, rest[1:]), n) for n in range(len(down(F.col("x"), inner, rest[1:])))]

    head, *rest = path.split(".")
    return down(F.col(f"`{head}`"), frame.schema[head].dataType, rest)


def find_values(
    text_cells: DataFrame,
    needles: DataFrame,
    min_length: int = 1,
    max_needles: int = MAX_AUTOMATON_NEEDLES,
    max_chars: int = MAX_AUTOMATON_CHARS,
    automaton: bool = True,
) -> DataFrame:
    """``needle, table, column, cells``: the needles that occur, and in how many cells of a column.

    ``needles`` holds the values in its first column; empty ones are ignored. Needles shorter than
    ``min_length`` must equal a whole cell, so generic short values do not flood the report.
    The needles are stored and counted first, which chooses the form; ``automaton=False`` keeps to
    joins, for clusters whose Python workers lack the automaton's library.
    """
    spark = text_cells.sparkSession
    wanted = needles.select(F.col(needles.columns[0]).cast("string").alias("needle")).where(F.length("needle") > 0).distinct()
    # read several times below, and often the distinct values of whole source columns
    ensure_checkpoint_dir(spark)
    wanted = wanted.checkpoint()
    parts = []
    if min_length > 1:
        parts.append(_whole_cells(text_cells, wanted.where(F.length("needle") < min_length)))
        wanted = wanted.where(F.length("needle") >= min_length)

    sizes = {row["class"]: row for row in wanted.groupBy(_class_number().alias("class")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("needle")).alias("chars"), F.max(F.length("needle")).alias("longest"),
        F.collect_set(F.when(F.length("needle") < MAX_CUT, F.length("needle"))).alias("lengths"),
        F.min(F.when(~F.col("needle").rlike(NO_FIGURE), F.length("needle"))).alias("figures")).collect()}
    text_cells = _without_figures(text_cells, [size["figures"] for size in sizes.values() if size["figures"]])
    small, large = [], []
    count = chars = 0
    for number in sorted(sizes, key=lambda k: sizes[k]["n"]):
        count, chars = count + sizes[number]["n"], chars + sizes[number]["chars"]
        fits = automaton and count <= max_needles and chars <= max_chars
        (small if fits else large).append(number)
    listed = [row["needle"] for row in wanted.where(_class_number().isin(small)).collect()] if small else []
    long = [number for number in large if GRAM_CLASSES[number].low >= HEAD]
    groups = [numbers for numbers in ([n for n in large if GRAM_CLASSES[n].low >= 8], [n for n in large if GRAM_CLASSES[n].low == 4]) if numbers]
    near: dict[int, DataFrame] = {}
    if groups:
        begun = [
            (wanted.where(_class_number().isin(numbers)), min(GRAM_CLASSES[n].low for n in numbers), sum(sizes[n]["n"] for n in numbers))
            for numbers in groups
        ]
        lengths = [length for numbers in groups for number in numbers for length in sizes[number]["lengths"]]
        hits, cells_ = _near_cells(text_cells, begun, lengths, listed)
        parts += [hits] if listed else []
        near = {number: cells_ for numbers in groups for number in numbers}
    elif listed:
        parts.append(_by_automaton(text_cells, listed))
    for number in sorted(set(large).difference(long)):
        chosen, lengths = wanted.where(_class_number() == number), sizes[number]["lengths"] if number in near else []
        parts.append(_by_grams(near.get(number, text_cells), chosen, GRAM_CLASSES[number], sizes[number]["longest"], lengths))
    if long:
        parts.append(_by_heads(near[long[0]], wanted.where(_class_number().isin(long)), {number: sizes[number]["longest"] for number in long}))
    if not parts:
        return spark.createDataFrame([], HITS_DDL)
    return reduce(DataFrame.unionByName, parts)


def _without_figures(text_cells: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """The cells but those of figures alone that are shorter than every needle of figures alone, or meet no such needle."""
    other = (F.length("value") > MAX_CUT) | F.col("value").rlike(NO_FIGURE)
    return text_cells.where(other | (F.length("value") >= min(lengths)) if lengths else other)


def _class_number() -> Column:
    length = F.length("needle")
    number = F.lit(len(GRAM_CLASSES) - 1)
    for i in reversed(range(len(GRAM_CLASSES) - 1)):
        number = F.when(length < GRAM_CLASSES[i].high, F.lit(i)).otherwise(number)
    return number


def _whole_cells(text_cells: DataFrame, needles: DataFrame) -> DataFrame:
    # longer cells cannot be equal and stay out of the shuffle; equal ones collapse before it
    limit = needles.agg(F.coalesce(F.max(F.length("needle")), F.lit(0)).alias("n")).first()["n"]
    counted = text_cells.where(F.length("value") <= limit).groupBy("table", "column", "value").agg(F.count(F.lit(1)).alias("cells"))
    return counted.join(needles, counted["value"] == needles["needle"]).select("needle", "table", "column", "cells")


_finders: dict[str, _Finder] = {}


class _Finder:
    """Finds the needles of one list in a batch of texts; built once per Python worker.

    A large automaton does not fit the processor's caches and slows down by an order of magnitude.
    Then, or where few cells are expected to hold a needle (``filtered``), rows are ruled out first: the batch's bytes
    are viewed as overlapping machine words and compared with the first bytes of the needles. Needles of up to three
    bytes are such words whole, and are counted by them.
    """

    BLOCK = 1 << 20
    MIX = np.uint64(0x9E3779B97F4A7C15)
    LARGE_CHARS = 200_000

    def __init__(self, needles: list[str], filtered: bool = False):
        import ahocorasick

        self.needles = needles
        self.automaton = ahocorasick.Automaton()
        self.filtered = filtered or sum(len(needle) for needle in needles if len(needle) >= 4) >= self.LARGE_CHARS
        starts: dict[int, set[int]] = {}
        whole: dict[int, dict[int, int]] = {}
        for number, needle in enumerate(needles):
            raw = needle.encode("utf-8")
            if self.filtered and len(raw) < 4:
                whole.setdefault(len(raw), {})[int.from_bytes(raw, "little")] = number
                continue
            self.automaton.add_word(needle, number)
            width = next(w for w in (8, 4, 2, 1) if len(raw) >= w)
            starts.setdefault(width, set()).add(int.from_bytes(raw[:width], "little"))
        if starts:
            self.automaton.make_automaton()
        self.filters = [self._filter(width, found) for width, found in starts.items()] if self.filtered else []
        self.whole = [(width, self._filter(width, set(found)), np.array([found[word] for word in sorted(found)])) for width, found in whole.items()]

    def _filter(self, width: int, found: set[int]) -> tuple:
        words = np.array(sorted(found), dtype=np.uint64)
        bits = min(24, max(10, len(words).bit_length() + 5))
        shift = np.uint64(64 - bits)
        bitmap = np.zeros(1 << bits, dtype=bool)
        bitmap[(words * self.MIX) >> shift] = True
        return np.uint64(2 ** (8 * width) - 1), shift, bitmap, words

    def rows(self, texts: pa.Array) -> np.ndarray:
        """Rows in which some needle's first bytes occur."""
        bounds, data = _utf8(texts)
        places = [np.zeros(0, np.int64), *[place for filter_ in self.filters for place, _ in self._met(data, filter_)]]
        return np.unique(np.searchsorted(bounds, np.concatenate(places), side="right") - 1)

    def _met(self, data: np.ndarray, filter_: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The bytes at which a word of a filter stands, and which one, block by block."""
        mask, shift, bitmap, words = filter_
        data = np.concatenate([data, np.zeros(8, np.uint8)])
        for start in range(0, len(data) - 8, self.BLOCK):
            count = min(self.BLOCK, len(data) - 8 - start)
            word = np.ndarray((count,), "<u8", data, start, (1,)) & mask
            near = np.flatnonzero(bitmap[(word * self.MIX) >> shift])
            index = np.minimum(np.searchsorted(words, word[near]), len(words) - 1)
            met = words[index] == word[near]
            yield start + near[met], index[met]

    def _whole_words(self, batch: pa.RecordBatch) -> Counter:
        """The cells of every table and column that hold a needle of few bytes."""
        found: Counter = Counter()
        bounds, data = _utf8(batch.column("value"))
        tables, columns = [batch.column(c).dictionary_encode() for c in ("table", "column")]
        kinds = tables.indices.to_numpy().astype(np.int64) * len(columns.dictionary) + columns.indices.to_numpy()
        for width, filter_, numbers in self.whole:
            pairs = [np.zeros(0, np.int64)]
            for place, index in self._met(data, filter_):
                row = np.searchsorted(bounds, place, side="right") - 1
                inside = place + width <= bounds[row + 1]
                pairs.append(np.unique(row[inside] * len(numbers) + index[inside]))
            rows, index = np.divmod(np.unique(np.concatenate(pairs)), len(numbers))
            for key, cells_ in zip(*[a.tolist() for a in np.unique(kinds[rows] * len(numbers) + index, return_counts=True)]):
                kind, which = divmod(key, len(numbers))
                table, column = divmod(kind, len(columns.dictionary))
                found[(int(numbers[which]), tables.dictionary[table].as_py(), columns.dictionary[column].as_py())] += cells_
        return found

    def count(self, batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = self._whole_words(batch) if self.whole else Counter()
        if self.filtered:
            batch = batch.take(pa.array(self.rows(batch.column("value"))))
        for table, column, value in zip(*[batch.column(c).to_pylist() for c in ("table", "column", "value")]):
            for number in {number for _, number in self.automaton.iter(value)}:
                found[(number, table, column)] += 1
        if not found:
            return None
        keys = list(found)
        return pa.RecordBatch.from_pydict(
            {
                "needle": pa.array([self.needles[number] for number, _, _ in keys], pa.string()),
                "table": pa.array([table for _, table, _ in keys], pa.string()),
                "column": pa.array([column for _, _, column in keys], pa.string()),
                "cells": pa.array([found[key] for key in keys], pa.int64()),
            }
        )


def _finder(run: str, needles: list[str], filtered: bool = False) -> _Finder:
    if run not in _finders:
        while len(_finders) >= 2:  # two scans of one job must not push each other out
            _finders.pop(next(iter(_finders)))
        _finders[run] = _Finder(needles, filtered)
    return _finders[run]


def _by_automaton(text_cells: DataFrame, needles: list[str]) -> DataFrame:
    """One pass over the text for all needles of a list within the budget."""
    ship_package(text_cells.sparkSession)
    shared = text_cells.sparkSession.sparkContext.broadcast(needles)
    run = uuid.uuid4().hex

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(run, shared.value)
        for batch in batches:
            if batch.num_rows and (hits := finder.count(batch)):
                yield hits

    # cells too short for any needle stay in the JVM
    shortest = min(map(len, needles))
    long_enough = text_cells.where(F.length("value") >= shortest)
    hits = long_enough.select("table", "column", "value").mapInArrow(search, HITS_DDL)
    return hits.groupBy("needle", "table", "column").agg(F.sum("cells").alias("cells"))


class _Beginnings:
    """Machine words at the beginnings of needles, each position of a word in a bitmap of its own.

    All needles have ``low`` bytes at least, so all have every word. The bitmaps have a largest size whatever the
    number of needles; what they let through by mistake is for the joins to tell.
    """

    MIX = np.uint64(0x9E3779B97F4A7C15)
    BLOCK = 1 << 20

    def __init__(self, low: int, count: int):
        self.type = "<u8" if low >= 8 else "<u4"
        self.offsets = list(range(0, low - int(self.type[2]) + 1, int(self.type[2])))[:FILTER_WORDS]
        self.bits = min(MAX_FILTER_BITS, max(10, count.bit_length() + 4))

    def _words(self, data: np.ndarray) -> np.ndarray:
        """The word at every byte."""
        return np.ndarray((max(0, len(data) - int(self.type[2]) + 1),), self.type, data, 0, (1,))

    def _hashed(self, words: np.ndarray) -> np.ndarray:
        return (words.astype(np.uint64) * self.MIX) >> np.uint64(64 - self.bits)

    def of(self, needles: pa.Array) -> pa.RecordBatch:
        """``word, place``: the bits of a batch of needles."""
        bounds, data = _utf8(needles)
        words = self._words(data)
        places = [np.unique(self._hashed(words[bounds[:-1] + offset])) for offset in self.offsets]
        numbers = np.repeat(np.arange(len(places), dtype=np.int32), [len(p) for p in places])
        return pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(np.concatenate(places).astype(np.int64))], ["word", "place"])

    def maps(self, found: pa.Table) -> list[np.ndarray]:
        """Bitmaps from ``word, at, bits``."""
        word, at, bits = [found.column(c).to_numpy() for c in ("word", "at", "bits")]
        maps = [np.zeros(1 << max(0, self.bits - 6), np.uint64) for _ in self.offsets]
        for number, bitmap in enumerate(maps):
            bitmap[at[word == number]] = bits[word == number].view(np.uint64)
        return maps

    def rows(self, texts: pa.Array, maps: list[np.ndarray]) -> np.ndarray:
        """Rows in which some needle may begin."""
        bounds, data = _utf8(texts)
        return np.unique(np.searchsorted(bounds, self._places(bounds, data, maps), side="right") - 1)

    def _places(self, bounds: np.ndarray, data: np.ndarray, maps: list[np.ndarray]) -> np.ndarray:
        """Bytes at which some needle may begin, in order."""
        words = self._words(data)
        last = len(words) - self.offsets[-1]
        # A look into large bitmaps misses the caches, and in short cells few places have room for a needle.
        room = np.maximum(0, np.diff(bounds) - (self.offsets[-1] + words.itemsize - 1))
        if 2 * room.sum() < last:
            return self._near(words, _ranges(bounds[:-1], room), maps)
        places = [np.zeros(0, np.int64)]
        for start in range(0, last, self.BLOCK):
            places.append(self._near(words, np.arange(start, min(start + self.BLOCK, last)), maps))
        return np.concatenate(places)

    def _near(self, words: np.ndarray, near: np.ndarray, maps: list[np.ndarray]) -> np.ndarray:
        for offset, bitmap in zip(self.offsets, maps):
            hashed = self._hashed(words[near + offset])
            near = near[(bitmap[hashed >> np.uint64(6)] >> (hashed & np.uint64(63)) & np.uint64(1)).astype(bool)]
        return near

    def places(self, bounds: np.ndarray, data: np.ndarray, maps: list[np.ndarray]) -> np.ndarray:
        """Bytes at which some needle may begin and has room in its cell, in order."""
        places = self._places(bounds, data, maps)
        ends = bounds[np.searchsorted(bounds, places, side="right")]
        return places[places + (self.offsets[-1] + int(self.type[2])) <= ends]


def _cells_near(batch: pa.RecordBatch, filters: Sequence[tuple[_Beginnings, list[np.ndarray]]], lengths: list[int]) -> pa.RecordBatch | None:
    """The cells of ``table, column, value`` in which some needle may begin, with the texts from there on.

    The texts are cut behind ``max(lengths)`` characters at the earliest. They are null where they would make more
    candidates than the cell has grams, and in texts that are no UTF-8, whose characters only the JVM counts.
    """
    bounds, data = _utf8(batch.column(2))
    places = np.unique(np.concatenate([beginnings.places(bounds, data, maps) for beginnings, maps in filters]))
    at = np.searchsorted(bounds, places, side="right") - 1
    rows, counts = np.unique(at, return_counts=True)
    if not len(rows):
        return None
    kept = batch.take(pa.array(rows))
    few = np.zeros(len(rows), bool)
    if lengths:
        few = counts <= np.minimum(4 + (bounds[rows + 1] - bounds[rows]) // (4 * len(lengths)), MAX_BEGINNINGS)
    ascii_only = not (data & 0x80).any()
    if not ascii_only:
        try:
            kept.column(2).validate(full=True)
        except pa.ArrowInvalid:
            few[:] = False
    chosen = np.repeat(few, counts)
    chosen &= (data[places] & 0xC0) != 0x80  # no character begins there
    places, at = places[chosen], at[chosen]
    ends = np.minimum(places + max(lengths, default=0) * (1 if ascii_only else 4), bounds[at + 1])
    for _ in range(3):  # back to the first byte of a character that would be cut
        inside = (ends < bounds[at + 1]) & ((data[np.minimum(ends, len(data) - 1)] & 0xC0) == 0x80)
        ends = ends - inside
    begins = _list_of_texts(data, places, ends, np.searchsorted(at, rows), few)
    return pa.RecordBatch.from_arrays([*kept.columns, begins, pa.nulls(len(rows), pa.int64())], ["table", "column", "value", "begins", "cells"])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, so many of them."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(sizes.sum())


def _list_of_texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, valid: np.ndarray) -> pa.ListArray:
    """Slices of a buffer as texts, in lists that begin at the slices ``first``; null where not ``valid``."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    raw = data.tobytes()
    taken = b"".join([raw[start:end] for start, end in zip(starts.tolist(), ends.tolist())])
    texts = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(taken))
    bounds = pa.array(np.append(first, len(starts)).astype(np.int32))
    return pa.ListArray.from_arrays(bounds, texts, mask=pa.array(~valid))


def _utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and bytes of an array of texts without nulls."""
    wide = pa.types.is_large_string(texts.type)
    bounds = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return bounds - bounds[0], data


def _near_cells(
    text_cells: DataFrame, groups: Sequence[tuple[DataFrame, int, int]], lengths: list[int], listed: list[str]
) -> tuple[DataFrame, DataFrame]:
    """What occurs of the ``listed`` needles, and the cells in which one of the ``groups`` may begin with ``begins``, the texts there.

    A group is its needles, their least length and their number. The texts, which may be whole masked tables, are worked
    out and read once for all needles, and only the cells that are written here meet the joins.
    """
    spark = text_cells.sparkSession
    ship_package(spark)
    filters = [(beginnings := _Beginnings(low, count), _maps(beginnings, needles)) for needles, low, count in groups]
    shared, wanted = spark.sparkContext.broadcast(filters), spark.sparkContext.broadcast(listed)
    run, schema = uuid.uuid4().hex, "table string, column string, value string, begins array<string>, cells bigint"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(run, wanted.value, filtered=True) if wanted.value else None
        for batch in batches:
            if not batch.num_rows:
                continue
            if near := _cells_near(batch, shared.value, lengths):
                yield near
            if finder and (hits := finder.count(batch)):
                none = pa.nulls(hits.num_rows, pa.list_(pa.string()))
                columns = [hits.column(c) for c in ("table", "column", "needle")]
                yield pa.RecordBatch.from_arrays([*columns, none, hits.column("cells")], ["table", "column", "value", "begins", "cells"])

    path = scratch_dir(spark, "near-cells")
    shortest = min([*map(len, listed), *[low for _, low, _ in groups]])
    text_cells.where(F.length("value") >= shortest).select("table", "column", "value").mapInArrow(search, schema).write.parquet(path)
    found = spark.read.schema(schema).parquet(path)
    hits = found.where(F.col("cells").isNotNull()).groupBy(F.col("value").alias("needle"), "table", "column").agg(F.sum("cells").alias("cells"))
    return hits, found.where(F.col("cells").isNull()).drop("cells")


def _maps(beginnings: _Beginnings, needles: DataFrame) -> list[np.ndarray]:
    """The bitmaps of a set of needles."""

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield beginnings.of(batch.column(0))

    # a character has one byte at least
    first = needles.select(F.left("needle", F.lit(8 * FILTER_WORDS)).alias("needle"))
    places = first.mapInArrow(begin, "word int, place bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").bitwiseAND(63).cast("int"))
    found = places.groupBy("word", F.shiftright("place", 6).alias("at")).agg(F.bit_or(bit).alias("bits"))
    return beginnings.maps(found.toArrow())


def _by_heads(text_cells: DataFrame, needles: DataFrame, longest: dict[int, int]) -> DataFrame:
    """:func:`_by_grams` for several classes of long needles, first with their beginnings of one length.

    A needle can only be where its beginning is. In clean data no beginning is found, and the texts are read once
    for all classes. Where some are, only their needles are looked for, class by class, in the columns that hold them.
    """
    begun = needles.select(F.left("needle", F.lit(HEAD)).alias("needle")).distinct()
    first = next(cls for cls in GRAM_CLASSES if cls.low <= HEAD < cls.high)
    met = _by_grams(text_cells, begun, first, HEAD).checkpoint()
    if not met.limit(1).count():
        return met
    heads = met.select(F.col("needle").alias("head")).distinct()
    chosen = needles.join(heads, F.left("needle", F.lit(HEAD)) == F.col("head"), "left_semi").checkpoint()
    here = text_cells.join(F.broadcast(met.select("table", "column").distinct()), ["table", "column"], "left_semi")
    present = {row[0] for row in chosen.select(_class_number().alias("class")).distinct().collect()}
    parts = [_by_grams(here, chosen.where(_class_number() == number), GRAM_CLASSES[number], size) for number, size in longest.items() if number in present]
    return reduce(DataFrame.unionByName, parts)


def _by_grams(text_cells: DataFrame, needles: DataFrame, cls: GramClass, longest: int, lengths: Sequence[int] = ()) -> DataFrame:
    """One class of needles in any number: cut out at the few places where one may begin, by sampled grams elsewhere.

    ``lengths`` holds the lengths of the needles if the cells are those of :func:`_near_cells`.
    """
    if not lengths:
        return _by_sampled_grams(text_cells, needles, cls, longest)
    found = _at_beginnings(text_cells.where(F.col("begins").isNotNull()), needles, lengths)
    crowded = text_cells.where(F.col("begins").isNull())
    if not crowded.limit(1).count():
        return found
    both = found.unionByName(_by_sampled_grams(crowded, needles, cls, longest))
    return both.groupBy("needle", "table", "column").agg(F.sum("cells").alias("cells"))


def _at_beginnings(near: DataFrame, needles: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """The texts at the places of a cell, cut to every length a needle has, meet the needles by equality."""
    sizes = F.array(*[F.lit(n) for n in sorted(lengths)])
    cut = F.flatten(F.transform("begins", lambda text: F.transform(sizes, lambda n: F.substr(text, F.lit(1), n))))
    candidates = near.select("table", "column", F.explode(F.array_distinct(cut)).alias("candidate"))
    counted = candidates.groupBy("candidate", "table", "column").agg(F.count(F.lit(1)).alias("cells"))
    return counted.join(needles, counted["candidate"] == needles["needle"]).select("needle", "table", "column", "cells")


def _by_sampled_grams(text_cells: DataFrame, needles: DataFrame, cls: GramClass, longest: int) -> DataFrame:
    """Sampled-gram join for a needle set of any size.

    1. Texts are cut into overlapping chunks, so later cuts inside them are cheap.
    2. Needle grams are grouped: one row per distinct gram with the distinct (offset, length) pairs
       it occurs at. Needles that share a prefix share that row, so common prefixes cannot multiply
       the join.
    3. Chunk grams at the stride meet these rows; a match says "a needle of this length may start
       here". Hot grams are spread by a salt. The rows carry digests, not text.
    4. The chunks with such places cut the candidates, which are joined to the needles by equality:
       a candidate meets at most one needle.
    """
    offsets = F.explode(F.sequence(F.lit(0), F.lit(cls.stride - 1))).alias("offset")
    all_grams = needles.select(F.length("needle").alias("length"), "needle", offsets).select(
        "length", "offset", F.xxhash64(F.substr("needle", F.col("offset") + 1, F.lit(cls.size))).alias("gram")
    )
    step = max(512, 4 * cls.low)
    step -= step % cls.stride
    keyed = text_cells.where(F.length("value") >= cls.low).withColumn("text_id", F.md5("value"))
    chunks = _chunks(keyed, step, cls, longest)
    sampled = chunks.select(
        "text_id", "chunk", F.posexplode(_every(F.col("text"), cls.size, cls.stride, step)).alias("piece", "gram_text")
    ).select(
        "text_id",
        "chunk",
        (F.col("piece") * cls.stride).alias("at"),
        F.xxhash64("gram_text").alias("gram"),
    )
    if "begins" in text_cells.columns:  # few cells, already written: only grams that they hold are worth a row
        chars = keyed.agg(F.sum(F.length("value"))).first()[0] or 0
        if chars // cls.stride < MAX_BROADCAST_GRAMS:
            all_grams = all_grams.join(F.broadcast(sampled.select("gram").distinct()), "gram", "left_semi")
    grams = (
        all_grams.groupBy("gram")
        .agg(F.collect_set(F.struct("offset", "length")).alias("found"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(GRAM_SALT - 1))))
    )
    # copies of a text collapse inside each task; what is left of a hot gram spreads by the salt
    sampled = sampled.distinct().withColumn(
        "salt", F.pmod(F.xxhash64("text_id", "chunk", "at"), F.lit(GRAM_SALT)).cast("int")
    )
    # the gram may lie up to one stride behind the start of the needle, hence the lead of a chunk
    places = (
        sampled.join(grams, ["gram", "salt"])
        .select("text_id", "chunk", "at", F.inline("found"))
        .where((F.col("chunk") > 0) | (F.col("at") >= F.col("offset")))
        .select("text_id", "chunk", F.struct((F.col("at") - F.col("offset")).alias("start"), "length").alias("place"))
        .groupBy("text_id", "chunk")
        .agg(F.collect_set("place").alias("places"))
    )
    # cut here: in clean data almost no place is left, and the size decides the next join
    places = places.checkpoint()
    total = places.agg(F.sum(F.size("places"))).first()[0] or 0
    near = F.broadcast(places) if total <= MAX_BROADCAST_PLACES else places
    ids = places.select("text_id").distinct()
    matched = keyed.join(F.broadcast(ids) if total <= MAX_BROADCAST_PLACES else ids, "text_id", "left_semi")
    cut = F.array_distinct(
        F.transform("places", lambda p: F.substr("around", p["start"] + (cls.stride + 1), p["length"]))
    )
    candidates = (
        _chunks(matched, step, cls, longest)
        .join(near, ["text_id", "chunk"])
        .select("text_id", F.explode(cut).alias("candidate"))
        .groupBy("text_id", "candidate")
        .agg(F.lit(1).alias("one"))
    )
    hits = candidates.join(needles, candidates["candidate"] == needles["needle"]).select("text_id", "needle")
    copies = matched.groupBy("table", "column", "text_id").agg(F.count(F.lit(1)).alias("copies"))
    return (
        hits.join(copies, "text_id").groupBy("needle", "table", "column").agg(F.sum("copies").alias("cells"))
    )


def _every(text: Column, size: int, stride: int, step: int) -> Column:
    """The ``size`` characters at 0, stride, 2 * stride, ... in one linear pass over the text."""
    return F.slice(
        F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}})).{{1,{stride}}}"), F.lit(1)), 1, step // stride
    )


def _chunks(keyed: DataFrame, step: int, cls: GramClass, longest: int) -> DataFrame:
    """``text_id, chunk, text, around``.

    ``text`` begins at ``chunk * step`` and holds what its grams need; ``around`` begins one stride
    earlier and is long enough for every needle whose sampled gram lies in the chunk.
    """
    # a lead keeps the positions of the first chunk regular; no candidate may begin inside it
    lead = F.lit("\u0001" * cls.stride)
    reach = f"{{1,{cls.stride + step + longest}}}"
    pieces = F.regexp_extract_all(F.concat(lead, "value"), F.lit(f"(?s)(?=(.{reach})).{{1,{step}}}"), F.lit(1))
    return keyed.select("text_id", F.posexplode(pieces).alias("chunk", "around")).withColumn(
        "text", F.substr("around", F.lit(cls.stride + 1), F.lit(step + cls.size))
    )


# --- the scan as a gate -----------------------------------------------------------------------

CANARY = "maskloom-canary-7f3a91c2"


class LeakError(Exception):
    """Original values survived, or the scan failed to see its own canary."""


def with_canary(spark: SparkSession, text_cells: DataFrame) -> DataFrame:
    probe = spark.createDataFrame([("__canary__", "probe", f"<{CANARY}>")], "table string, column string, value string")
    return text_cells.unionByName(probe)


def leak_scan(dataset: Mapping[str, DataFrame], needles: DataFrame, min_length: int = 1, **options) -> DataFrame:
    """Scan a masked dataset: ``needle, table, column, cells`` of every surviving value, written once.

    A canary cell is scanned along; not finding the canary in it means the scan itself is broken.
    """
    spark = needles.sparkSession
    wanted = needles.select(F.col(needles.columns[0]).alias("needle")).unionByName(
        spark.createDataFrame([(CANARY,)], "needle string")
    )
    hits = find_values(with_canary(spark, cells(dataset)), wanted, min_length, **options).checkpoint()
    probe = F.col("table") == "__canary__"
    if not hits.where(probe & (F.col("needle") == CANARY)).limit(1).count():
        raise LeakError("the leak scan did not find its canary")
    return hits.where(~probe)


def assert_no_leak(hits: DataFrame, shown: int = 10) -> None:
    """Raise when anything survived; the message names a few and counts them all."""
    rows = hits.orderBy("needle", "table", "column").limit(shown).collect()
    if rows:
        listed = "; ".join(f"{needle!r} in {table}.{column} ({n})" for needle, table, column, n in rows)
        raise LeakError(f"{hits.count()} surviving values: {listed}")
