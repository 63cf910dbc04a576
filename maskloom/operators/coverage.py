"""Coverage: which PII-shaped columns no rule handles.

Works on the schema frame of :mod:`maskloom.plans.schema`, as joins, so that a catalog of many
thousand columns is no different from a small one.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.plans import rulebook as rb
from maskloom.plans.schema import FLAGGED_SHAPES

EXPLICIT, PATTERN, UNDECLARED, UNCOVERED, IGNORED_SHAPE = (
    "explicit", "pattern", "undeclared_model", "uncovered", "not_flagged",
)


class CoverageError(Exception):
    """Columns without a rule."""


def matching_patterns(column: Column, shape: Column, patterns: Sequence[rb.ColumnPattern]) -> Column:
    """All patterns that admit a column, in declaration order.

    The list of patterns is part of the rulebook, so each is an expression of its own; a join on
    ``rlike`` would be a nested loop.
    """
    name = F.substring_index(column, ".", -1)
    tests = []
    for pattern in patterns:
        admits = name.rlike(rb.java_regex(pattern.match))
        if pattern.shapes:
            admits = shape.isin(list(pattern.shapes)) & admits
        entry = F.struct(
            F.lit(pattern.ordinal).alias("ordinal"), F.lit(pattern.match).alias("regex"), F.lit(pattern.strategy).alias("strategy")
        )
        tests.append(F.when(admits, entry))
    if not tests:
        return F.expr("cast(array() as array<struct<ordinal:int,regex:string,strategy:string>>)")
    return F.array_compact(F.array(*tests))


def first_match(column: Column, shape: Column, patterns: Sequence[rb.ColumnPattern]) -> Column:
    return F.get(matching_patterns(column, shape, patterns), F.lit(0))


def analyze(columns: DataFrame, book: rb.Rulebook, ignore_models: Iterable[str] = ()) -> DataFrame:
    """Every considered column with its outcome: explicit rule, pattern, or a finding."""
    spark = columns.sparkSession
    ignored = [(rb.table_of(model),) for model in ignore_models]
    if ignored:
        columns = columns.join(F.broadcast(spark.createDataFrame(ignored, "table string")), "table", "left_anti")
    # the rulebook comes from the driver, so it is small enough to broadcast by construction
    rules: dict[str, dict[str, str]] = {}
    for rule in book.rules:
        rules.setdefault(rule.table, {})[rule.path] = rule.strategy
    ruled = spark.createDataFrame(list(rules.items()), "table string, rules map<string, string>")
    # the column itself, then what it is nested in, as the masking plan places rules
    parts = F.split("column", r"\.")
    above = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))
    named = F.filter(above, lambda path: F.col("rules")[path].isNotNull())
    declared = [(rb.table_of(model), model) for model in book.models]
    models = spark.createDataFrame(declared, "table string, declared string")
    joined = (
        columns.join(F.broadcast(ruled), "table", "left")
        .withColumn("rule", F.col("rules")[F.get(named, F.lit(0))])
        .join(F.broadcast(models), "table", "left")
        .withColumn("pattern", first_match(F.col("column"), F.col("shape"), book.patterns))
    )
    flagged = F.col("shape").isin(list(FLAGGED_SHAPES))
    outcome = (
        F.when(F.col("rule").isNotNull(), EXPLICIT)
        .when(F.col("pattern").isNotNull(), PATTERN)
        .when(~flagged, IGNORED_SHAPE)
        .when(F.col("declared").isNull(), UNDECLARED)
        .otherwise(UNCOVERED)
    )
    model = F.coalesce("declared", F.replace(F.col("table"), F.lit("_"), F.lit(".")))
    reason = (
        F.when(F.col("outcome") == PATTERN, F.concat(F.lit("covered by pattern "), F.col("pattern.regex"), F.lit(" -> "), F.col("pattern.strategy")))
        .when(F.col("outcome") == UNDECLARED, F.concat(F.lit("model "), F.col("model"), F.lit(" has no rule at all; column is "), F.col("shape")))
        .when(F.col("outcome") == UNCOVERED, F.concat(F.col("model"), F.lit("."), F.col("column"), F.lit(" is "), F.col("shape"), F.lit(" without a strategy")))
    )
    return (
        joined.withColumn("outcome", outcome)
        .withColumn("model", model)
        .select(
            "table", "column", "model", "data_type", "shape", "fk_target", "nullable", "outcome",
            F.coalesce("rule", "pattern.strategy").alias("strategy"), reason.alias("reason"),
        )
    )


def findings(report: DataFrame) -> DataFrame:
    return report.where(F.col("outcome").isin(UNDECLARED, UNCOVERED)).orderBy("table", "column")


def pattern_covered(report: DataFrame) -> DataFrame:
    """Columns only a pattern handles: listed, so that someone can audit them."""
    return report.where(F.col("outcome") == PATTERN).orderBy("table", "column")


def uncovered(columns: DataFrame, rules: DataFrame) -> DataFrame:
    """Columns minus ruled columns."""
    return columns.join(F.broadcast(rules.select("table", "column")), ["table", "column"], "left_anti")


def summary(report: DataFrame) -> DataFrame:
    return report.agg(*counters())


def counters() -> list[Column]:
    def number(*outcomes: str) -> Column:
        return F.count_if(F.col("outcome").isin(*outcomes))

    return [
        F.count(F.lit(1)).alias("considered"),
        number(EXPLICIT).alias("covered"),
        number(PATTERN).alias("by_pattern"),
        number(UNDECLARED, UNCOVERED).alias("flagged"),
    ]


def undeclared_models(report: DataFrame) -> DataFrame:
    return report.where(F.col("outcome") == UNDECLARED).select("model").distinct().orderBy("model")


def gate(report: DataFrame, shown: int = 20) -> None:
    """Raise when any column lacks a rule."""
    found = findings(report)
    rows = found.limit(shown).collect()
    if rows:
        listed = "; ".join(f"{row['table']}.{row['column']}: {row['reason']}" for row in rows)
        raise CoverageError(f"{found.count()} columns without a rule: {listed}")


def diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Added, dropped and retyped columns of two schema or coverage frames."""
    extra = [c for c in ("shape", "outcome", "strategy") if c in after.columns]
    left = before.select("table", "column", F.col("data_type").alias("old_type"))
    right = after.select("table", "column", F.col("data_type").alias("new_type"), *extra)
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "dropped")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
    )
    joined = left.join(right, ["table", "column"], "full_outer").withColumn("change", change)
    return joined.where(F.col("change").isNotNull()).orderBy("table", "column")
