"""Permute a column across rows: values kept as a multiset, their link to rows broken."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 16**4 buckets: a window group of about nine million rows at 600 billion rows, and small
# enough a set that the running bucket table stays tiny.
BUCKET_DIGITS = 4

# So many classes are sent to every task, which then tells by a place which of them stands there.
FEW_CLASSES = 64
# Types whose equal values are the same.
PLAIN = (T.StringType, T.IntegralType, T.BooleanType, T.DateType)


def row_key(keys: Sequence[str]) -> Column:
    """One text per row from its key columns."""
    return F.concat_ws("\x1f", *[F.col(key).cast("string") for key in keys])


def row_hash(frame: DataFrame) -> Column:
    """A number for a row's whole content."""
    return F.xxhash64(*[F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() or isinstance(f.dataType, T.VariantType) else F.col(f"`{f.name}`") for f in frame.schema.fields])


def shuffle_column(
    frame: DataFrame,
    column: str,
    keys: Sequence[str],
    within: Sequence[str] = (),
    salt: str = "",
    bucket_digits: int = BUCKET_DIGITS,
    order_by: str | None = None,
) -> DataFrame:
    """Give every row the value of the next row in one keyed random order (a cyclic shift).

    The order is by ``md5(salt + key)``. Rows are split by a prefix of that digest, so buckets are
    even whatever the data looks like, and concatenating the buckets in prefix order is the global
    order. ``lead`` serves every row but the last of a bucket; that one takes the first value of
    the next bucket that has rows, from a table of one row per bucket. One shuffle of the data, no
    global window over rows. ``within`` permutes inside groups; a hot group spreads over all its
    buckets. The outcome does not depend on partitioning nor on ``bucket_digits``. ``order_by`` names a
    column that already holds the digest.
    """
    group = [F.col(name) for name in within]
    hashed = F.col(order_by) if order_by else F.md5(F.concat(F.lit(salt), row_key(keys)))
    spread = frame.withColumn("__hash", hashed).withColumn("__bucket", F.substring("__hash", 1, bucket_digits))
    # a struct, so that a NULL value differs from "no such row"
    boxed = F.struct(F.col(column).alias("v"))
    order = [F.col("__hash"), *[F.col(key) for key in keys]]
    in_bucket = Window.partitionBy(*group, "__bucket").orderBy(*order)

    firsts = (
        spread.groupBy(*group, "__bucket")
        .agg(F.min_by(boxed, F.struct(*order)).alias("__first"))
        .transform(lambda heads: _next_first(heads, within))
    )
    shifted = spread.withColumn("__next", F.lead(boxed).over(in_bucket))
    joined = _join_buckets(shifted, firsts, within)
    value = F.coalesce(F.col("__next"), F.col("__wrapped"))["v"]
    return joined.select(*[value.alias(column) if c == column else F.col(c) for c in frame.columns])


def shuffle_columns(
    source: DataFrame, target: DataFrame, salts: Mapping[str, str], keys: Sequence[str], bucket_digits: int = BUCKET_DIGITS
) -> DataFrame:
    """:func:`shuffle_column` of several columns of ``source`` at once, put into the rows of ``target``.

    ``target`` has the rows of ``source``, perhaps with masked keys; its column ``__row`` keeps what
    :func:`row_key` was before, and is left out of the result. All columns travel together, as one narrow row per row and column, so the
    number of scans does not grow with the columns.
    """
    names = list(salts)
    # Rows of one key are told apart by all they hold, so that a lost executor numbers them as before.
    own = Window.partitionBy("__row").orderBy("__whole")
    given = source.select(row_key(keys).alias("__row"), row_hash(source).alias("__whole"), *[F.col(f"`{c}`").alias(f"__v{i}") for i, c in enumerate(names)])
    given = given.withColumn("__copy", F.row_number().over(own)).drop("__whole")
    values = [
        F.struct(
            F.lit(i).alias("__column"),
            F.md5(F.concat(F.lit(salts[c]), "__row")).alias("__hash"),
            F.struct(*[F.col(f"__v{j}") if j == i else F.lit(None).cast(source.schema[n].dataType).alias(f"__v{j}") for j, n in enumerate(names)]).alias("__value"),
        )
        for i, c in enumerate(names)
    ]
    long = given.select("__row", "__copy", F.inline(F.array(*values)))
    moved = shuffle_column(long, "__value", ["__row", "__copy"], within=["__column"], bucket_digits=bucket_digits, order_by="__hash")
    wide = moved.groupBy("__row", "__copy").agg(*[F.first(F.when(F.col("__column") == i, F.struct(f"__value.__v{i}")), ignorenulls=True).alias(f"__n{i}") for i in range(len(names))])
    numbered = target.withColumn("__whole", row_hash(target)).withColumn("__copy", F.row_number().over(own))
    joined = numbered.join(wide, ["__row", "__copy"])
    new = {c: F.col(f"__n{i}")[f"__v{i}"] for i, c in enumerate(names)}
    return joined.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in target.columns if c != "__row"])


def derangement_bounds(frame: DataFrame, column: str) -> tuple[int, int, int]:
    """(rows, rows of the commonest value, rows that must keep their value whatever the permutation)."""
    return _bounds(frame, column)[:3]


def _bounds(frame: DataFrame, column: str) -> tuple[int, int, int, int]:
    """:func:`derangement_bounds`, and the number of classes where each is known to be one value, else 0."""
    plain = isinstance(frame.schema[column].dataType, PLAIN)
    # Plain values are counted as they are, and only the different ones are digested.
    values = frame.groupBy(F.col(f"`{column}`").alias("v")).agg(F.count(F.lit(1)).alias("n")) if plain else frame.select(F.col(f"`{column}`").alias("v"), F.lit(1).alias("n"))
    classes = values.groupBy(_class_of("v", "").alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("values"))
    rows, largest, count, most = (x or 0 for x in classes.agg(F.sum("n"), F.max("n"), F.count(F.lit(1)), F.max("values")).first())
    return rows, largest, max(0, 2 * largest - rows), count if plain and most == 1 else 0


def _class_of(column: str, salt: str) -> Column:
    """Equal for equal values, NULL being one of them, and in an order that only the salt shows."""
    return F.md5(F.coalesce(F.concat(F.lit(f"{salt}v:"), F.to_json(F.struct(F.col(f"`{column}`").alias("v")), {"ignoreNullFields": "false"})), F.lit(salt)))


def derange_column(frame: DataFrame, column: str, keys: Sequence[str], salt: str = "", bucket_digits: int = BUCKET_DIGITS) -> DataFrame:
    """A permutation that leaves no row its own value, as far as that can be.

    Rows are ordered by a keyed digest of their value and then of their key, and each takes the value that stands as many
    places on as the commonest value has rows. Equal values stand together, so none meets itself unless one value has
    more than half of all rows; then exactly the rows of :func:`derangement_bounds` keep theirs. Ordering the values
    themselves would do as well, but anyone could then turn the shift back.

    Places come from counts per value and digest prefix, summed up in buckets; a value with very many rows is
    spread over its keys' prefixes. Two numbers go to the driver. The outcome depends on neither partitioning nor
    ``bucket_digits``; NULL is a value. The value at a place is found by the place, or from the few classes there are.
    """
    rows, largest, _, count = _bounds(frame, column)
    if rows < 2:
        return frame
    spread = frame.withColumns({"__class": _class_of(column, salt), "__order": F.md5(F.concat(F.lit(salt), row_key(keys))), "__whole": row_hash(frame)})
    spread = spread.withColumn("__part", F.substring("__order", 1, bucket_digits))
    value = F.col(f"`{column}`") if 0 < count <= FEW_CLASSES else F.lit(None)
    parts = spread.groupBy("__class", "__part").agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(value.alias("v"))).alias("__given"))
    classes = parts.groupBy("__class").agg(F.sum("__n").alias("__n"), F.first("__given").alias("__given")).withColumn("__bucket", F.substring("__class", 1, bucket_digits))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    # At most 16 ** bucket_digits rows, whatever the table.
    buckets = classes.groupBy("__bucket").agg(F.sum("__n").alias("__n"))
    buckets = buckets.select("__bucket", F.coalesce(F.sum("__n").over(before(F.lit(0)).orderBy("__bucket")), F.lit(0)).alias("__low"))
    starts = classes.withColumn("__in", F.coalesce(F.sum("__n").over(before("__bucket").orderBy("__class")), F.lit(0))).join(buckets, "__bucket")
    starts = starts.select("__class", (F.col("__low") + F.col("__in")).alias("__first"), "__n", "__given")
    inside = parts.withColumn("__in", F.coalesce(F.sum("__n").over(before("__class").orderBy("__part")), F.lit(0)))
    first = inside.drop("__given").join(starts.drop("__n", "__given"), "__class").select("__class", "__part", (F.col("__first") + F.col("__in")).alias("__first"))
    rank = F.row_number().over(Window.partitionBy("__class", "__part").orderBy("__order", "__whole"))
    placed = spread.join(first, ["__class", "__part"]).withColumn("__at", F.col("__first") + rank - 1)
    placed = placed.withColumn("__from", (F.col("__at") + largest) % rows)
    if 0 < count <= FEW_CLASSES:
        given = starts.select(F.col("__first").alias("__begin"), (F.col("__first") + F.col("__n")).alias("__end"), "__given")
        joined = placed.join(F.broadcast(given), (F.col("__from") >= F.col("__begin")) & (F.col("__from") < F.col("__end")))
    else:
        given = placed.select(F.col("__at").alias("__from"), F.struct(F.col(f"`{column}`").alias("v")).alias("__given"))
        joined = placed.join(given, "__from")
    return joined.select(*[F.col("__given")["v"].alias(c) if c == column else F.col(f"`{c}`") for c in frame.columns])


def _next_first(heads: DataFrame, within: Sequence[str]) -> DataFrame:
    """First value of the following bucket, the last bucket wrapping to the first one.

    At most ``16 ** bucket_digits`` rows per group whatever the size of the data, so the ordered
    window below is bounded.
    """
    group = [F.col(name) for name in within] or [F.lit(0)]
    ordered = Window.partitionBy(*group).orderBy("__bucket")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("__first").over(ordered), F.first("__first").over(whole))
    return heads.select(
        *[F.col(name).alias(f"__g{i}") for i, name in enumerate(within)],
        F.col("__bucket").alias("__b"),
        following.alias("__wrapped"),
    )


def _join_buckets(shifted: DataFrame, firsts: DataFrame, within: Sequence[str]) -> DataFrame:
    condition = F.col("__bucket") == F.col("__b")
    for i, name in enumerate(within):
        condition &= F.col(name).eqNullSafe(F.col(f"__g{i}"))
    return shifted.join(firsts, condition, "inner")


def keyed_position(frame: DataFrame, keys: Sequence[str], salt: str = "", bucket_digits: int = BUCKET_DIGITS) -> DataFrame:
    """Add ``position``: the row's 1-based rank in the keyed random order of the whole table."""
    spread = frame.withColumn("__hash", F.md5(F.concat(F.lit(salt), row_key(keys)))).withColumn(
        "__bucket", F.substring("__hash", 1, bucket_digits)
    )
    sizes = spread.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    running = Window.partitionBy(F.lit(0)).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("__bucket").alias("__b"), F.coalesce(F.sum("__n").over(running), F.lit(0)).alias("__offset"))
    in_bucket = Window.partitionBy("__bucket").orderBy("__hash", *keys)
    ranked = spread.withColumn("__rank", F.row_number().over(in_bucket))
    joined = ranked.join(offsets, F.col("__bucket") == F.col("__b"))
    return joined.select(*frame.columns, (F.col("__offset") + F.col("__rank")).alias("position"))
