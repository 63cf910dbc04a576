"""Infer references between columns by inclusion of their values.

Tables on Spark carry no foreign keys. One pass finds every inclusion: each distinct value gets a
bit mask of the columns it occurs in, and a column's possible parents are the bits left when the
masks of all its values are and-ed. Work is linear in the distinct values per column; pairs of
columns are written out only where the inclusion holds. References of several columns are searched
level by level: only tuples whose parts are all included, in parents that are not unique yet, are read. One
tuple in :data:`PARTS` is compared first, as most false inclusions show there; the others are then compared whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_like_columns(dataset: Mapping[str, DataFrame]) -> list[tuple[str, str]]:
    return [
        (name, f.name)
        for name, frame in dataset.items()
        for f in frame.schema.fields
        if isinstance(f.dataType, (T.IntegralType, T.StringType))
    ]


WORD = 63


def infer_references(
    dataset: Mapping[str, DataFrame], columns: Sequence[tuple[str, str]] | None = None
) -> DataFrame:
    """``child_table, child_column, parent_table, parent_column, child_values``.

    A pair is reported when all non-null child values occur in the parent and the parent column is
    unique. Numbers are compared with numbers and text with text.
    """
    chosen = list(columns if columns is not None else key_like_columns(dataset))
    families = [
        [(t, c) for t, c in chosen if isinstance(dataset[t].schema[c].dataType, kind)]
        for kind in (T.IntegralType, T.StringType)
    ]
    return reduce(DataFrame.unionByName, [_inclusions(dataset, family) for family in families if family])


def _inclusions(dataset: Mapping[str, DataFrame], chosen: Sequence[tuple[str, str]]) -> DataFrame:
    """:func:`infer_references` for columns of one type family."""
    spark = dataset[chosen[0][0]].sparkSession
    number = {attribute: i for i, attribute in enumerate(chosen)}
    by_table: dict[str, list[str]] = {}
    for table, column in chosen:
        by_table.setdefault(table, []).append(column)
    values = reduce(DataFrame.unionByName, [_values(dataset[table], names, table, number) for table, names in by_table.items()])
    rows = reduce(DataFrame.unionByName, [_rows(dataset[table], {number[(table, c)]: [c] for c in names}) for table, names in by_table.items()])
    children = _included(values, rows, len(chosen))
    names = spark.createDataFrame([(i, t, c) for (t, c), i in number.items()], "id int, table string, column string")
    pairs = children.select("child", "child_values", F.explode(_ids(len(chosen), "in")).alias("parent")).where(
        F.col("child") != F.col("parent")
    )
    unique = children.where(~F.col("repeats")).select(F.col("child").alias("parent"))
    child = names.select(F.col("id").alias("child"), F.col("table").alias("child_table"), F.col("column").alias("child_column"))
    parent = names.select(F.col("id").alias("parent"), F.col("table").alias("parent_table"), F.col("column").alias("parent_column"))
    return (
        pairs.join(unique, "parent", "left_semi")
        .join(child, "child")
        .join(parent, "parent")
        .select("child_table", "child_column", "parent_table", "parent_column", "child_values")
    )


def _included(values: DataFrame, rows: DataFrame, count: int) -> DataFrame:
    """``child, child_values, in…, repeats`` from ``id, value`` and ``id, rows``: the bits left are the columns that hold all of the child's values.

    Values of one column collapse inside each task, so a hot value costs one row per task, and cross the network once. A
    column repeats a value when it has more rows than values.
    """
    children = _holders(values, count)
    masks = [c for c in children.columns if c.startswith("in")]
    return children.join(rows.withColumnRenamed("id", "child"), "child").select("child", "child_values", *masks, (F.col("rows") > F.col("child_values")).alias("repeats"))


def _holders(values: DataFrame, count: int) -> DataFrame:
    """``child, child_values, in…`` of :func:`_included`."""
    words = range(-(-count // WORD))
    masks = [f"in{w}" for w in words]
    found = values.groupBy("value").agg(*[F.bit_or(_bits(F.col("id"), w)).alias(f"in{w}") for w in words])
    # few distinct column sets remain, whatever the number of values
    sets = found.groupBy(*masks).agg(F.count(F.lit(1)).alias("n"))
    return sets.select("*", F.explode(_ids(count, "in")).alias("child")).groupBy("child").agg(
        F.sum("n").alias("child_values"), *[F.bit_and(mask).alias(mask) for mask in masks]
    )


def _rows(frame: DataFrame, sides: Mapping[int, Sequence[str]]) -> DataFrame:
    """``id, rows``: the rows of one table in which no column of a side is null."""
    whole = lambda columns: reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in columns])
    counts = frame.agg(*[F.count_if(whole(columns)).alias(str(i)) for i, columns in sides.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(i).alias("id"), F.col(f"`{i}`").alias("rows")) for i in sides])))


#: A table and some of its columns, in order.
Columns = tuple[str, tuple[str, ...]]

#: One tuple in so many is compared first.
PARTS = 64


def infer_composite_references(
    dataset: Mapping[str, DataFrame], columns: Sequence[tuple[str, str]] | None = None, arity: int = 3
) -> DataFrame:
    """``child_table, child_columns, parent_table, parent_columns, child_values`` for references of 2 to ``arity`` columns.

    Child columns are in the order of ``columns``, parent columns as they correspond. A reference is reported when
    all tuples of the child without a null occur in the parent, the same holds for every part of it, and the parent's
    columns are unique together and no part of them is. ``child_values`` counts the child's different tuples. Numbers
    are compared with numbers and text with text; a column never refers to itself. Each level reads every table once
    for all its candidates to compare a part of the tuples, and once more for those that are left; what the driver keeps is names of columns and their least and greatest numbers.
    """
    chosen = list(columns if columns is not None else key_like_columns(dataset))
    spark = next(iter(dataset.values())).sparkSession
    place = {column: i for i, column in enumerate(chosen)}
    told = _compared(dataset, {(t, (c,)): _single(dataset, t, c) for t, c in chosen})
    found, ranges = [], {}
    open_ends = {
        (child, parent): told[parent].unique
        for child, side in told.items()
        for parent in side.parents
        if (child[0], child[1][0]) != (parent[0], parent[1][0])
    }
    for _ in range(2, arity + 1):
        candidates = _grown({pair for pair, unique in open_ends.items() if not unique}, place)
        if not candidates:
            break
        ranges = ranges or _ranges(dataset, chosen)
        read = {pair: _aligned(pair, place) for pair in candidates}
        for part in (PARTS, 1):
            told = _compared(dataset, _codes(dataset, set(read.values()), ranges), part)
            read = {pair: (c, p) for pair, (c, p) in read.items() if (p in told[c].parents if c in told else part > 1)}
        open_ends = {pair: told[p].unique for pair, (_, p) in read.items()}
        found += [(ct, list(cc), pt, list(pc), told[read[pair][0]].values) for pair, unique in open_ends.items() if unique for (ct, cc), (pt, pc) in [pair]]
    return spark.createDataFrame(
        found, "child_table string, child_columns array<string>, parent_table string, parent_columns array<string>, child_values bigint"
    )


def _grown(held: set[tuple[Columns, Columns]], place: Mapping[tuple[str, str], int]) -> set[tuple[Columns, Columns]]:
    """Inclusions of one column more, all of whose parts are ``held``."""
    by_start: dict[tuple, list[tuple[str, str]]] = {}
    for (child, cc), (parent, pc) in held:
        by_start.setdefault((child, cc[:-1], parent, pc[:-1]), []).append((cc[-1], pc[-1]))
    out = set()
    for (child, cc, parent, pc), ends in by_start.items():
        for one, other in combinations(sorted(ends, key=lambda e: place[child, e[0]]), 2):
            if one[0] == other[0] or one[1] == other[1]:
                continue
            c, p = (*cc, one[0], other[0]), (*pc, one[1], other[1])
            parts = combinations(range(len(c)), len(c) - 1)
            if all(((child, tuple(c[i] for i in part)), (parent, tuple(p[i] for i in part))) in held for part in parts):
                out.add(((child, c), (parent, p)))
    return out


def _aligned(pair: tuple[Columns, Columns], place: Mapping[tuple[str, str], int]) -> tuple[Columns, Columns]:
    """The same inclusion with the columns of the side that comes first in their order, so that few orders of a tuple are read."""
    table, columns = min(pair, key=lambda side: min(place[side[0], c] for c in side[1]))
    order = sorted(range(len(columns)), key=lambda i: place[table, columns[i]])
    (child, cc), (parent, pc) = pair
    return (child, tuple(cc[i] for i in order)), (parent, tuple(pc[i] for i in order))


@dataclass(frozen=True)
class _Side:
    """How many different tuples a side has, whether it repeats none, and the sides that hold them all."""

    values: int
    unique: bool
    parents: frozenset[Columns]


#: A column whose values stand for tuples, and whether it is a whole number.
Code = tuple[Column, bool]


def _compared(dataset: Mapping[str, DataFrame], codes: Mapping[Columns, Code], part: int = 1) -> dict[Columns, _Side]:
    """The sides that have tuples, compared by one tuple in ``part``; whether one is unique is told by the whole only."""
    out = {}
    for number in (True, False):
        sides = sorted(side for side, code in codes.items() if code[1] == number)
        by_table: dict[str, list[int]] = {}
        for i, (table, _) in enumerate(sides):
            by_table.setdefault(table, []).append(i)
        if not sides:
            continue

        def tuples(table: str, numbers: Sequence[int]) -> DataFrame:
            frame = dataset[table]
            entries = [F.struct(F.lit(i).alias("id"), _in_part(frame, sides[i][1], codes[sides[i]][0], part).alias("value")) for i in numbers]
            return frame.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull())

        values = reduce(DataFrame.unionByName, [tuples(t, numbers) for t, numbers in by_table.items()])
        if part == 1:
            rows = reduce(DataFrame.unionByName, [_rows(dataset[t], {i: sides[i][1] for i in numbers}) for t, numbers in by_table.items()])
            children = _included(values, rows, len(sides))
        else:
            children = _holders(values, len(sides)).withColumn("repeats", F.lit(True))
        for row in children.select("child", "child_values", "repeats", _ids(len(sides), "in").alias("parents")).collect():
            out[sides[row.child]] = _Side(row.child_values, not row.repeats, frozenset(sides[p] for p in row.parents))
    return out


def _in_part(frame: DataFrame, columns: Sequence[str], code: Column, part: int) -> Column:
    """A code, null but for one tuple in ``part``."""
    if part == 1:
        return code
    return F.when(F.pmod(F.xxhash64(*[_plain(frame, c) for c in columns]), F.lit(part)) == 0, code)


def _is_text(frame: DataFrame, column: str) -> bool:
    return isinstance(frame.schema[column].dataType, T.StringType)


def _plain(frame: DataFrame, column: str) -> Column:
    return F.col(f"`{column}`") if _is_text(frame, column) else F.col(f"`{column}`").cast("bigint")


def _single(dataset: Mapping[str, DataFrame], table: str, column: str) -> Code:
    value, text = _plain(dataset[table], column), _is_text(dataset[table], column)
    return (_short(value) if text else value), not text


def _ranges(dataset: Mapping[str, DataFrame], chosen: Sequence[tuple[str, str]]) -> dict[tuple[str, str], tuple[int, int]]:
    """The least and the greatest number of every column that has numbers."""
    numbers = [(t, c) for t, c in chosen if not _is_text(dataset[t], c)]
    out = {}
    for table in dict.fromkeys(t for t, _ in numbers):
        columns = [c for t, c in numbers if t == table]
        ends = [end(_plain(dataset[table], c)) for c in columns for end in (F.min, F.max)]
        row = dataset[table].agg(*[end.alias(str(i)) for i, end in enumerate(ends)]).first()
        out |= {(table, c): (row[2 * i], row[2 * i + 1]) for i, c in enumerate(columns) if row[2 * i] is not None}
    return out


def _codes(dataset: Mapping[str, DataFrame], pairs: set[tuple[Columns, Columns]], ranges: Mapping[tuple[str, str], tuple[int, int]]) -> dict[Columns, Code]:
    """A code for the tuples of every side, the same for equal tuples of sides that are compared.

    Tuples of numbers are packed into one where the numbers' ranges leave room, which takes half the bytes of a digest.
    Sides that are not compared, not even over others, may use one number for different tuples.
    """
    codes: dict[Columns, Code] = {}
    for sides in _linked(pairs):
        numbers = all(not _is_text(dataset[t], c) for t, columns in sides for c in columns)
        places = []
        for columns in zip(*[[(t, c) for c in columns] for t, columns in sides]):
            known = [ranges[column] for column in columns if column in ranges]
            low, high = min([r[0] for r in known], default=0), max([r[1] for r in known], default=0)
            places.append((low, (high - low).bit_length()))
        packs = numbers and sum(bits for _, bits in places) < 64
        codes |= {(t, columns): (_packed(dataset[t], columns, places) if packs else _digest(dataset[t], columns), packs) for t, columns in sides}
    return codes


def _linked(pairs: set[tuple[Columns, Columns]]) -> list[list[Columns]]:
    """The sides in groups, such that pairs lie within a group."""
    group: dict[Columns, list[Columns]] = {}
    for pair in sorted(pairs):
        one, other = [group.setdefault(side, [side]) for side in pair]
        if one is not other:
            one += other
            group |= dict.fromkeys(other, one)
    return list({id(sides): sides for sides in group.values()}.values())


def _packed(frame: DataFrame, columns: Sequence[str], places: Sequence[tuple[int, int]]) -> Column:
    """Numbers side by side in one, each less the least at its place and in that many bits."""
    code, shift = None, 0
    for column, (low, bits) in reversed(list(zip(columns, places))):
        part = F.call_function("shiftleft", _plain(frame, column) - F.lit(low).cast("bigint"), F.lit(shift))
        code, shift = part if code is None else code.bitwiseOR(part), shift + bits
    return code


def _digest(frame: DataFrame, columns: Sequence[str]) -> Column:
    """The digest of values as a text that no other list of values, and no number as text, can be mistaken for."""

    def told(column: str) -> Column:
        value = _plain(frame, column).cast("string")
        return F.concat(F.lit("t" if _is_text(frame, column) else "n"), F.octet_length(value).cast("string"), F.lit(":"), value)

    return _short(F.concat(*[told(c) for c in columns]))


def _short(text: Column) -> Column:
    """The digest of a text, in 16 bytes."""
    return F.unhex(F.md5(text))


def _bits(identifier: Column, word: int) -> Column:
    """The bit of a column number within one word of the mask, 0 in all other words."""
    inside = F.floor(identifier / WORD) == word
    return F.when(inside, F.call_function("shiftleft", F.lit(1).cast("bigint"), (identifier % WORD).cast("int"))).otherwise(
        F.lit(0).cast("bigint")
    )


def _has_bit(identifier: Column, kind: str, words: Sequence[int]) -> Column:
    return reduce(Column.__or__, [F.col(f"{kind}{w}").bitwiseAND(_bits(identifier, w)) != 0 for w in words])


def _ids(count: int, kind: str) -> Column:
    """The column numbers whose bits are set."""
    words = range(-(-count // WORD))
    return F.filter(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: _has_bit(i, kind, words))


def _values(frame: DataFrame, names: Sequence[str], table: str, number: Mapping[tuple[str, str], int]) -> DataFrame:
    """``id, value`` for the columns of one table, read once; a text stands as its digest."""
    text = isinstance(frame.schema[names[0]].dataType, T.StringType)
    entries = [F.struct(F.lit(number[(table, c)]).alias("id"), (_short(F.col(f"`{c}`")) if text else F.col(f"`{c}`").cast("bigint")).alias("value")) for c in names]
    return frame.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull())


def with_references(columns: DataFrame, references: DataFrame) -> DataFrame:
    """Put inferred targets into a schema frame; where several parents fit, the first by name."""
    targets = references.groupBy(F.col("child_table").alias("table"), F.col("child_column").alias("column")).agg(
        F.min(F.concat_ws(".", "parent_table", "parent_column")).alias("inferred")
    )
    return columns.join(targets, ["table", "column"], "left").select(
        *[F.coalesce("fk_target", "inferred").alias(c) if c == "fk_target" else F.col(c) for c in columns.columns]
    )
