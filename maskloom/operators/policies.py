"""Row-level policies: key/value secrets, rotation, content dropping, neutralising, scoped replace."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions.secrets import FRESH
from maskloom.functions.text import extension, pair_replacer, replace_each, rewrite_path, rewrite_strings
from maskloom.plans.strategies import MaskError
from maskloom.session import scratch_dir, ship_package


@dataclass(frozen=True)
class Rotation:
    """A new value unrelated to the old one: a constant, or fresh random text."""

    constant: Any = None
    fresh: str | None = None

    def value(self, dtype: T.DataType) -> Column:
        return FRESH[self.fresh]().cast(dtype) if self.fresh else F.lit(self.constant).cast(dtype)


# How the rotate_secret columns are rotated.
ROTATIONS: dict[tuple[str, str], Rotation] = {
    ("ir.config_parameter", "database.secret"): Rotation(fresh="secret"),
    ("ir.config_parameter", "database.uuid"): Rotation(fresh="uuid"),
    ("payment.token", "active"): Rotation(constant=False),
    ("payment.provider", "state"): Rotation(constant="disabled"),
    ("hr.employee", "pin"): Rotation(constant="0000"),
    ("website.visitor", "access_token"): Rotation(fresh="token"),
    ("iap.account", "account_token"): Rotation(fresh="token"),
}


def rotation_for(model: str, column: str, declared: Any = None) -> Rotation:
    """The rotation of a rule: the one it declares, or the known one. Neither is an error."""
    if isinstance(declared, Mapping):
        fresh = declared.get("fresh")
        if fresh is not None and fresh not in FRESH:
            raise MaskError(f"rotation of {model}.{column}: unknown fresh value {fresh!r}")
        return Rotation(declared.get("constant"), fresh)
    if isinstance(declared, str) and declared in FRESH:
        return Rotation(fresh=declared)
    known = ROTATIONS.get((model, column))
    if known is None:
        raise MaskError(f"rotate_secret rule for {model}.{column} has no implementation")
    return known


def rotate_columns(frame: DataFrame, rotations: Mapping[str, Rotation]) -> DataFrame:
    """New values at the given paths; below a nested path every text leaf is replaced."""

    def rotated(rotation: Rotation, value: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
            return rewrite_strings(value, dtype, lambda _text: rotation.value(T.StringType()))
        return rotation.value(dtype)

    columns = []
    for f in frame.schema.fields:
        value = F.col(f"`{f.name}`")
        for path, rotation in rotations.items():
            if path == f.name:
                value = rotated(rotation, value, f.dataType)
            elif path not in frame.columns and path.split(".")[0] == f.name:
                value = rewrite_path(value, f.dataType, path.split(".")[1:], lambda old, dtype, r=rotation: rotated(r, old, dtype))
        columns.append(value.alias(f.name))
    return frame.select(*columns)


@dataclass(frozen=True)
class KeyValuePolicy:
    """Values masked by the key of their row: named rotations first, then the regex drop.

    ``distinctive: false`` says that rows left alone may well hold the same values, so that a leak scan
    must not look for them.
    """

    table: str
    key: str = "key"
    value: str = "value"
    drop_regex: str | None = None
    rotations: Mapping[str, Rotation] = field(default_factory=dict)
    nullable: bool | None = None
    distinctive: bool = True

    def apply(self, frame: DataFrame) -> DataFrame:
        dtype = frame.schema[self.value].dataType
        nullable = frame.schema[self.value].nullable if self.nullable is None else self.nullable
        cleared = F.lit(None).cast(dtype) if nullable else F.lit("").cast(dtype)
        key, current = F.col(self.key), F.col(self.value)
        branches = [(key == name, rotation.value(dtype)) for name, rotation in self.rotations.items()]
        if self.drop_regex:
            branches.append((key.rlike(self.drop_regex), cleared))
        if not branches:
            return frame
        masked = F.when(*branches[0])
        for condition, value in branches[1:]:
            masked = masked.when(condition, value)
        masked = masked.otherwise(current)
        return frame.select(*[masked.alias(c) if c == self.value else F.col(f"`{c}`") for c in frame.columns])


    def hidden_values(self, frame: DataFrame) -> DataFrame | None:
        """``value, column``: what the policy drops or rotates to something new."""
        key = F.col(self.key)
        hits = [key == name for name, rotation in self.rotations.items() if rotation.fresh]
        hits += [key.rlike(self.drop_regex)] if self.drop_regex else []
        if not hits or not self.distinctive:
            return None
        return frame.where(reduce(Column.__or__, hits)).select(F.col(self.value).alias("value"), F.lit(self.value).alias("column"))


@dataclass(frozen=True)
class ContentPolicy:
    """Attached files: content columns nulled, names scrubbed and rows left out by parent type."""

    table: str = "ir_attachment"
    drop_columns: Sequence[str] = ("datas", "store_fname", "checksum", "index_content")
    scrub_parents: Sequence[str] = ()
    exclude_parents: Sequence[str] = ()
    parent: str = "res_model"
    filename: str = "name"
    row_id: str = "id"
    prefix: str = "attachment_"

    def scrubs(self) -> Column:
        return F.col(self.parent).isin(list(self.scrub_parents)) & F.col(self.filename).isNotNull()

    def apply(self, frame: DataFrame) -> DataFrame:
        if self.exclude_parents and self.parent in frame.columns:
            frame = frame.where(~F.coalesce(F.col(self.parent).isin(list(self.exclude_parents)), F.lit(False)))
        columns = []
        for f in frame.schema.fields:
            column = F.col(f"`{f.name}`")
            if f.name in self.drop_columns:
                column = F.lit(None).cast(f.dataType)
            elif f.name == self.filename and self._can_scrub(frame):
                renamed = F.concat(F.lit(self.prefix), F.col(self.row_id).cast("string"), extension(column))
                column = F.when(self.scrubs(), renamed).otherwise(column)
            columns.append(column.alias(f.name))
        return frame.select(*columns)

    def hidden_values(self, frame: DataFrame) -> DataFrame | None:
        """``value, column``: the file names that are scrubbed."""
        if not self._can_scrub(frame):
            return None
        return frame.where(self.scrubs()).select(F.col(self.filename).alias("value"), F.lit(self.filename).alias("column"))

    def metrics(self, frame: DataFrame) -> list[Column]:
        """Aggregates that count what :meth:`apply` changes."""
        present = [c for c in self.drop_columns if c in frame.columns]
        scrubbed = F.count_if(self.scrubs()) if self._can_scrub(frame) else F.lit(0).cast("bigint")
        return [
            (F.count(F.lit(1)) if present else F.lit(0).cast("bigint")).alias("rows_content_dropped"),
            (
                F.count_if(F.col("index_content").isNotNull()) if "index_content" in present else F.lit(0).cast("bigint")
            ).alias("rows_index_dropped"),
            scrubbed.alias("filenames_scrubbed"),
        ]

    def _can_scrub(self, frame: DataFrame) -> bool:
        return bool(self.scrub_parents) and {self.parent, self.filename, self.row_id} <= set(frame.columns)


def with_parents(frame: DataFrame, column: str, parents: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose parent type is listed; a listed table is matched by a semi join."""
    if isinstance(parents, DataFrame):
        return frame.join(parents.select(F.col(parents.columns[0]).alias(column)), column, "left_semi")
    return frame.where(F.col(column).isin(list(parents)))


@dataclass(frozen=True)
class Update:
    """Set columns of a table to constants, on all rows or where a condition holds."""

    table: str
    values: Mapping[str, Any]
    where: Column | None = None

    def apply(self, frame: DataFrame) -> DataFrame:
        columns = []
        for f in frame.schema.fields:
            column = F.col(f"`{f.name}`")
            if f.name in self.values:
                constant = F.lit(self.values[f.name]).cast(f.dataType)
                column = constant if self.where is None else F.when(self.where, constant).otherwise(column)
            columns.append(column.alias(f.name))
        return frame.select(*columns)


# The operational switches turned off in a copy.
def neutral_updates() -> list[Update]:
    return [
        Update(
            "ir_config_parameter",
            {"value": "0"},
            (F.col("key") == "mail.force.smtp.from") & F.col("value").isNotNull(),
        ),
        Update("ir_config_parameter", {"value": "smtp"}, F.col("key") == "mail.default.server"),
        Update("ir_mail_server", {"active": False, "smtp_host": None, "smtp_user": None, "smtp_pass": None}),
        Update("fetchmail_server", {"active": False, "password": None, "user": None}),
        Update("payment_provider", {"state": "disabled"}),
    ]


def neutralize(dataset: Mapping[str, DataFrame], updates: Sequence[Update] | None = None) -> dict[str, DataFrame]:
    """Apply a preset of updates in order; tables that are absent are skipped."""
    result = dict(dataset)
    for update in neutral_updates() if updates is None else updates:
        if update.table in result:
            result[update.table] = update.apply(result[update.table])
    return result


# --- scoped replacement -----------------------------------------------------------------------

# Pairs that one pass holds in each Python worker, at some 200 bytes each; longer lists take several passes.
MAX_PAIRS = 200_000


def name_pairs(before: DataFrame, after: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``old, new`` for every row whose name changed, both sides non-empty."""
    left = before.select(*keys, F.col(name).alias("old"))
    right = after.select(*keys, F.col(name).alias("new"))
    changed = left.join(right, list(keys)).where(
        (F.col("old") != "") & (F.col("new") != "") & (F.col("old") != F.col("new"))
    )
    return changed.groupBy("old").agg(F.min("new").alias("new"))


def pair_array(pairs: DataFrame) -> DataFrame:
    """All pairs in one row, longest old name first, so no name is cut by its own prefix."""
    entry = F.struct((-F.length("old")).alias("rank"), F.col("old"), F.col("new"))
    return pairs.agg(F.sort_array(F.collect_list(entry)).alias("pairs"))


def scoped_replace(
    frame: DataFrame, column: str, where: Column, pairs: DataFrame, json_text: bool = False, max_pairs: int = MAX_PAIRS
) -> DataFrame:
    """Replace names in one column of the listed rows only; all other rows stay verbatim.

    Strings, nested values and JSON text are supported. The counted pair list reaches each worker once and
    becomes one automaton, so the work on a text does not grow with the pairs it does not hold. A list
    beyond ``max_pairs`` is written once in longest-first ranges, and the ranges are applied one after
    the other, which is the same sequence of replacements.
    """
    if pairs.limit(max_pairs + 1).count() <= max_pairs:
        return _replace_once(frame, column, where, pairs, json_text)
    return _replace_in_ranges(frame, column, where, pairs, json_text, max_pairs)


def _replace_once(frame: DataFrame, column: str, where: Column, pairs: DataFrame, json_text: bool) -> DataFrame:
    dtype = frame.schema[column].dataType
    names = frame.columns
    if isinstance(dtype, T.StringType):
        ship_package(frame.sparkSession)
        ordered = pairs.orderBy(-F.length("old"), "old", "new").select("old", "new").collect()
        shared = frame.sparkSession.sparkContext.broadcast([tuple(row) for row in ordered])
        # rows that are not listed reach the function as nulls
        rewritten = pair_replacer(shared, json_text)(F.when(where, F.col(column)))
    else:
        # a subquery may not stand inside a lambda, so it becomes a column first
        frame = frame.select("*", pair_array(pairs).scalar().alias("__pairs"))
        rewritten = rewrite_strings(F.col(column), dtype, lambda text: replace_each(text, F.col("__pairs")))
    value = F.when(where, rewritten).otherwise(F.col(column))
    return frame.select(*[value.alias(c) if c == column else F.col(f"`{c}`") for c in names])


def _replace_in_ranges(
    frame: DataFrame, column: str, where: Column, pairs: DataFrame, json_text: bool, max_pairs: int
) -> DataFrame:
    spark = frame.sparkSession
    path = scratch_dir(spark, "pairs")
    ranges = -(-pairs.count() // max_pairs)
    # range boundaries are sampled, so the split is written once and read back
    (
        pairs.withColumn("rank", -F.length("old"))
        .repartitionByRange(ranges, "rank", "old")
        .withColumn("range", F.spark_partition_id())
        .write.partitionBy("range")
        .parquet(path)
    )
    stored = spark.read.parquet(path)
    for number in range(ranges):
        chunk = stored.where(F.col("range") == number).select("old", "new")
        frame = _replace_once(frame, column, where, chunk, json_text)
    return frame
