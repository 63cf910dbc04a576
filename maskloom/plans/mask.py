"""Rules x schemas -> one projection per table, followed by the ordered passes."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions.text import rewrite_path, rewrite_strings
from maskloom.operators.leakscan import original_values
from maskloom.operators.policies import (
    ContentPolicy,
    KeyValuePolicy,
    Rotation,
    name_pairs,
    rotate_columns,
    rotation_for,
    scoped_replace,
)
from maskloom.operators.shuffle import derange_column, row_key, shuffle_columns
from maskloom.plans import rulebook as rb
from maskloom.plans import schema as sc
from maskloom.plans import strategies as st
from maskloom.plans.strategies import MaskError


@dataclass(frozen=True)
class ScopedReplace:
    """Listed rows of a table whose text repeats names kept in another table."""

    table: str
    column: str
    key: str
    keys: Sequence[str]
    names_table: str
    names_column: str
    names_key: Sequence[str] = ("id",)
    json_text: bool = False


@dataclass
class TablePlan:
    table: str
    rewrites: dict[str, rb.FieldRule] = field(default_factory=dict)
    shuffles: dict[str, rb.FieldRule] = field(default_factory=dict)
    rotations: dict[str, Rotation] = field(default_factory=dict)
    key_values: list[KeyValuePolicy] = field(default_factory=list)
    contents: list[ContentPolicy] = field(default_factory=list)
    scoped: list[ScopedReplace] = field(default_factory=list)

    def touched_columns(self, frame: DataFrame) -> list[str]:
        """Columns that a rule rewrites, shuffles or rotates, nested ones by their head."""
        heads = [path if path in frame.columns else path.split(".")[0] for path in [*self.rewrites, *self.shuffles, *self.rotations]]
        return list(dict.fromkeys(heads))


SALTED_STRATEGIES = ("generalize_numeric_band", "shuffle_within_column")
SOFT_STRATEGIES = ("generalize_year", "generalize_numeric_band")


@dataclass
class MaskPlan:
    tables: dict[str, TablePlan]
    counters: dict[str, int]

    def secret_columns(self) -> list[tuple[str, str]]:
        """``(table, column)`` pairs whose original values must not survive anywhere.

        Generalised numbers and dates, and shuffled values, are meant to survive in some form.
        """
        found = []
        for name, plan in self.tables.items():
            found += [(name, path) for path, rule in plan.rewrites.items() if rule.strategy not in SOFT_STRATEGIES]
            found += [(name, path) for path, rotation in plan.rotations.items() if rotation.fresh]
            found += [(name, column) for policy in plan.contents for column in policy.drop_columns]
        return found

    def secret_values(self, dataset: Mapping[str, DataFrame]) -> DataFrame | None:
        """``value, table, column``: the originals of :meth:`secret_columns` and what the row policies hide.

        None when the plan hides nothing.
        """
        columns = [(t, c) for t, c in self.secret_columns() if sc.node_type(dataset[t].schema, c) is not None]
        parts = [original_values(dataset, columns)] if columns else []
        for name, plan in self.tables.items():
            for policy in [*plan.key_values, *plan.contents]:
                hidden = policy.hidden_values(dataset[name])
                parts += [] if hidden is None else [hidden.select(F.col("value").cast("string").alias("value"), F.lit(name).alias("table"), "column")]
        if not parts:
            return None
        return reduce(DataFrame.unionByName, parts).where("value is not null and value <> ''").distinct()


@dataclass
class Masked:
    dataset: dict[str, DataFrame]
    plan: MaskPlan
    observations: dict[str, Observation]

    def row_metrics(self) -> dict[str, dict[str, int]]:
        """Rows read and touched per observed table. Blocks until each has been written once."""
        return {name: observation.get for name, observation in self.observations.items()}


def build_plan(dataset: Mapping[str, DataFrame], book: rb.Rulebook) -> MaskPlan:
    """Intersect the rules with the tables at hand. Driver-side; runs no job.

    What the dataset lacks is counted as skipped. Unknown strategies, rotations without an
    implementation and strategies that cannot handle a column's type are errors.
    """
    plans = {name: TablePlan(name) for name in dataset}
    leaves = {name: {path: dtype for path, dtype, _ in sc.leaf_columns(frame.schema)} for name, frame in dataset.items()}
    counters = dict.fromkeys(
        "applied skipped kept pattern_applied pattern_overlap shuffle_applied shuffle_skipped "
        "rotate_applied rotate_skipped policies_applied policies_skipped".split(),
        0,
    )
    # only rules that handle a column here keep a pattern from it
    explicit = {(rule.table, rule.path) for rule in book.rules if _place_rule(rule, book, dataset, plans, counters)}
    for name, columns in leaves.items():
        for path, dtype in columns.items():
            pattern = first_pattern(path, _shape(book, name, path, dtype), book.patterns)
            if _ruled(explicit, name, path):
                counters["pattern_overlap"] += pattern is not None
            elif pattern is not None:
                rule = rb.FieldRule(name, path, pattern.strategy, file=pattern.file)
                _check_type(rule, dtype)
                plans[name].rewrites[path] = rule
                counters["pattern_applied"] += 1
    _place_policies(book, dataset, plans, counters)
    return MaskPlan(plans, counters)


def first_pattern(path: str, shape: str, patterns: Sequence[rb.ColumnPattern]) -> rb.ColumnPattern | None:
    """The first pattern, in declaration order, that admits the column."""
    name = path.rsplit(".", 1)[-1]
    for pattern in patterns:
        if (not pattern.shapes or shape in pattern.shapes) and re.search(pattern.match, name):
            return pattern
    return None


def _shape(book: rb.Rulebook, table: str, path: str, dtype: T.DataType) -> str:
    target = book.refs.get((table, path))
    if target:
        return sc.SUBJECT_REF if target.split(".")[0] in sc.SUBJECT_TABLES else sc.OTHER
    return sc.type_shape(dtype)


def _ruled(explicit: set[tuple[str, str]], table: str, path: str) -> bool:
    """Whether a rule names the column or a column it is nested in."""
    parts = path.split(".")
    return any((table, ".".join(parts[:n])) in explicit for n in range(1, len(parts) + 1))


def _place_rule(rule, book, dataset, plans, counters) -> bool:
    """Put one rule into its table's plan; False when the dataset has nothing for it.

    A path may end at a nested value; the rule then holds for everything below it.
    """
    if rule.strategy not in book.strategies:
        raise MaskError(f"{rule.file}: {rule.model}.{rule.field} uses unknown strategy {rule.strategy!r}")
    chosen = st.strategy(rule.strategy)
    table, path = rule.table, rule.path
    rotation = None
    if chosen.kind == st.ROTATE:
        rotation = rotation_for(rule.model, rule.field, rule.params.get("rotate"))
    dtype = sc.node_type(dataset[table].schema, path) if table in dataset else None
    present = dtype is not None
    if chosen.kind == st.CROSS_ROW and present:
        if path not in dataset[table].columns:
            raise MaskError(f"{rule.file}: {rule.model}.{rule.field} is nested, and only whole columns can be shuffled")
        present = bool(table_key(book, table, dataset[table]))
    if chosen.kind == st.KEEP:
        counters["kept"] += 1
        return present
    prefix = {st.ROTATE: "rotate_", st.CROSS_ROW: "shuffle_"}.get(chosen.kind, "")
    counters[prefix + ("applied" if present else "skipped")] += 1
    if not present:
        return False
    plan = plans[table]
    if chosen.kind == st.ROTATE:
        plan.rotations[path] = rotation
    elif chosen.kind == st.CROSS_ROW:
        plan.shuffles[path] = rule
    else:
        _check_type(rule, dtype)
        plan.rewrites[path] = rule
    return True


def _check_type(rule: rb.FieldRule, dtype: T.DataType) -> None:
    chosen = st.strategy(rule.strategy)
    if chosen.accepts(dtype) or _leafwise(chosen, dtype) or _shown_as_text(rule, dtype):
        return
    raise MaskError(f"{rule.file}: {rule.strategy} cannot mask {rule.model}.{rule.field} of type {dtype.simpleString()}")


def _leafwise(chosen: st.Strategy, dtype: T.DataType) -> bool:
    """A text strategy on a nested value handles its string leaves."""
    nested = isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))
    return nested and chosen.accepts(T.StringType()) and not chosen.accepts(T.IntegerType())


def _shown_as_text(rule: rb.FieldRule, dtype: T.DataType) -> bool:
    return rule.strategy == "partial_keep_last4" and isinstance(dtype, T.AtomicType)


def table_key(book: rb.Rulebook, table: str, frame: DataFrame) -> list[str]:
    """The declared key of a table, or its ``id`` column."""
    declared = [c for c in book.keys.get(table, ["id"]) if c in frame.columns]
    return declared if len(declared) == len(book.keys.get(table, ["id"])) else []


def _place_policies(book, dataset, plans, counters) -> None:
    for policy in policies_of(book):
        if not _has_columns(policy, dataset):
            counters["policies_skipped"] += 1
            continue
        counters["policies_applied"] += 1
        plan = plans[policy.table]
        if isinstance(policy, KeyValuePolicy):
            plan.key_values.append(policy)
        elif isinstance(policy, ContentPolicy):
            plan.contents.append(policy)
        else:
            plan.scoped.append(policy)


def _has_columns(policy, dataset: Mapping[str, DataFrame]) -> bool:
    """Whether the dataset has what a policy works on."""
    columns = set(dataset[policy.table].columns) if policy.table in dataset else set()
    if isinstance(policy, KeyValuePolicy):
        return {policy.key, policy.value} <= columns
    if isinstance(policy, ContentPolicy):
        return bool(columns & {*policy.drop_columns, policy.parent})
    names = set(dataset[policy.names_table].columns) if policy.names_table in dataset else set()
    return {policy.column, policy.key} <= columns and {policy.names_column, *policy.names_key} <= names


def policies_of(book: rb.Rulebook) -> list[KeyValuePolicy | ContentPolicy | ScopedReplace]:
    """The policies a rulebook declares beside its field rules, whichever form it uses."""
    found: list = []
    config = book.setting(rb.CONFIG_MODEL) or {}
    regex = config.get("match_by_key_regex")
    named = config.get("always_rotate_regardless_of_match") or {}
    if regex or named:
        rotations = {str(key): rotation_for(rb.CONFIG_MODEL, str(key), how) for key, how in dict(named).items()}
        found.append(KeyValuePolicy(rb.table_of(rb.CONFIG_MODEL), "key", "value", regex, rotations))
    for entry in book.entries("key_value_policies"):
        rotations = {k: rotation_for(entry["table"], k, how) for k, how in (entry.get("rotate") or {}).items()}
        found.append(
            KeyValuePolicy(
                entry["table"], entry.get("key", "key"), entry.get("value", "value"), entry.get("drop_regex"), rotations,
                entry.get("nullable"), bool(entry.get("distinctive", True)),
            )
        )
    default = book.setting("default_policy")
    if default is not None:
        found.append(attachment_policy(book))
    for entry in book.entries("content_policies"):
        found.append(ContentPolicy(**entry))
    views = (book.setting(rb.VIEW_MODEL) or {}).get("scoped_arch_replace") or []
    keys = [str(entry["view_key"]) for entry in views if entry.get("view_key")]
    if keys:
        found.append(ScopedReplace("ir_ui_view", "arch_db", "key", keys, "res_company", "name"))
    for entry in book.entries("scoped_replace"):
        found.append(ScopedReplace(**entry))
    return found


# The columns each part of an attachment lives in.
ATTACHMENT_COLUMNS = {
    "content": ("datas", "store_fname"),
    "checksum": ("checksum",),
    "index_content": ("index_content",),
    "mimetype": ("mimetype",),
    "file_size": ("file_size",),
}


def attachment_policy(book: rb.Rulebook) -> ContentPolicy:
    default = book.setting("default_policy") or {}
    dropped = [c for part, columns in ATTACHMENT_COLUMNS.items() if default.get(part) == "drop" for c in columns]
    if default.get("filename") == "drop":
        dropped.append("name")
    return ContentPolicy(
        drop_columns=tuple(dropped),
        scrub_parents=tuple(book.entries("full_scrub_filename_for_models")),
        exclude_parents=tuple(book.entries("exclude_rows_entirely_for_models")),
    )


def mask(dataset: Mapping[str, DataFrame], book: rb.Rulebook, salt: str = "", observe: bool = False) -> Masked:
    """Mask a dataset: explicit rules and patterns, shuffles, rotations, content, scoped replace.

    Lazy: nothing is computed until the result is written, except the size check of a scoped
    replacement and the counts of a derangement. Rotated secrets are random, so write the result once and read that.
    ``observe`` counts rows read and cells touched during that write; it keeps the scan out of the projection's
    generated code, so it is off by default.
    """
    plan = build_plan(dataset, book)
    require_salt(plan.tables.values(), salt)
    observations: dict[str, Observation] = {}
    result: dict[str, DataFrame] = {}
    for name, frame in dataset.items():
        table = plan.tables[name]
        keys = table_key(book, name, frame)
        if observe:
            observations[name] = Observation(f"mask-{name}")
            touched = [metric for policy in table.contents for metric in policy.metrics(frame)]
            touched += [F.count(F.col(f"`{column}`")).alias(f"cells:{column}") for column in table.touched_columns(frame)]
            frame = frame.observe(observations[name], F.count(F.lit(1)).alias("rows"), *touched)
        named = frame.withColumn("__row", row_key(keys)) if table.shuffles else frame
        masked = rewrite_table(named, table, keys, salt)
        if table.shuffles:
            # each column has an order of its own, or shuffled columns would stay linked
            salts = {column: f"{rule.params.get('salt', salt)}{column}:" for column, rule in table.shuffles.items()}
            deranged = [column for column, rule in table.shuffles.items() if rule.params.get("derange")]
            for column in deranged:
                masked = derange_column(masked, column, ["__row"], salts.pop(column))
            masked = shuffle_columns(frame, masked, salts, keys) if salts else masked.drop("__row")
        masked = rotate_columns(masked, table.rotations) if table.rotations else masked
        for policy in [*table.key_values, *table.contents]:
            masked = policy.apply(masked)
        result[name] = masked
    for name, table in plan.tables.items():
        for scope in table.scoped:
            keys = list(scope.names_key)
            pairs = name_pairs(dataset[scope.names_table], result[scope.names_table], keys, scope.names_column)
            listed = F.col(scope.key).isin(list(scope.keys))
            result[name] = scoped_replace(result[name], scope.column, listed, pairs, scope.json_text)
    return Masked(result, plan, observations)


def require_salt(plans: Iterable[TablePlan], salt: str) -> None:
    """Noise and orders drawn from public keys alone can be drawn again by anyone, and undone."""
    for plan in plans:
        for rule in [*plan.rewrites.values(), *plan.shuffles.values()]:
            if rule.strategy in SALTED_STRATEGIES and not rule.params.get("salt", salt):
                raise MaskError(f"{rule.file}: {rule.strategy} of {rule.model}.{rule.field} needs a secret salt")


def rewrite_table(frame: DataFrame, plan: TablePlan, keys: Sequence[str] = (), salt: str = "") -> DataFrame:
    """All per-column rewrites of one table in a single projection."""
    if not plan.rewrites:
        return frame
    by_column: dict[str, list[tuple[list[str], rb.FieldRule]]] = {}
    for path, rule in plan.rewrites.items():
        head, *rest = [path] if path in frame.columns else path.split(".")
        by_column.setdefault(head, []).append((rest, rule))
    columns = []
    for f in frame.schema.fields:
        value: Column = F.col(f"`{f.name}`")
        for rest, rule in by_column.get(f.name, []):
            value = rewrite_path(value, f.dataType, rest, _rewriter(rule, f.name, keys, salt, bool(rest)))
        columns.append(value.alias(f.name))
    return frame.select(*columns)


def _rewriter(rule: rb.FieldRule, column: str, keys: Sequence[str], salt: str, below: bool):
    chosen = st.strategy(rule.strategy)
    params = dict(rule.params)
    salt = str(params.pop("salt", salt))

    def rewrite(value: Column, dtype: T.DataType, nested: bool = below) -> Column:
        key = row_key(keys) if keys else value.cast("string")
        if not chosen.accepts(dtype) and _leafwise(chosen, dtype):
            return rewrite_strings(value, dtype, lambda text: rewrite(text, T.StringType(), True))
        return chosen.apply(st.Target(value, dtype, column, key, salt, params, nested))

    return rewrite
