"""Reconcile what is installed with what is available."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions.text import major_version, release_series


def installed_modules(modules: DataFrame) -> DataFrame:
    """Installed modules by name, with their versions."""
    return (
        modules.where(F.col("state") == "installed")
        .select("name", F.coalesce("latest_version", F.lit("")).alias("version"))
        .orderBy("name")
    )


def base_version(modules: DataFrame, base: str = "base") -> DataFrame:
    """Version, series and major number of the base module."""
    return modules.where(F.col("name") == base).select(
        F.col("latest_version").alias("version"),
        release_series(F.col("latest_version")).alias("series"),
        major_version(F.col("latest_version")).alias("major"),
    )


def first_found(found: DataFrame, name: str = "name", ordinal: str = "path_ordinal") -> DataFrame:
    """One row per module: the left-most path wins."""
    others = [c for c in found.columns if c not in (name, ordinal)]
    winner = F.min_by(F.struct(*others), F.struct(ordinal, *others)).alias("w")
    return found.groupBy(name).agg(winner).select(name, *[F.col(f"w.{c}").alias(c) for c in others])


def reconcile(installed: DataFrame, found: DataFrame) -> DataFrame:
    """Installed modules with the code path and version found for them, NULL when missing."""
    code = first_found(found).select("name", F.col("path").alias("code_path"), F.col("version").alias("code_version"))
    return installed.join(code, "name", "left").select(
        *installed.columns, "code_path", "code_version", F.col("code_path").isNull().alias("missing")
    )


def missing_modules(installed: DataFrame, found: DataFrame) -> DataFrame:
    return installed.join(found.select("name"), "name", "left_anti").orderBy("name")


def undeclared_modules(installed: DataFrame, declared: DataFrame | Sequence[str]) -> DataFrame:
    """Installed modules no rule file names."""
    if not isinstance(declared, DataFrame):
        declared = installed.sparkSession.createDataFrame([(name,) for name in declared], "name string")
    return installed.select("name").join(declared.select("name"), "name", "left_anti").orderBy("name")


def ordered_distinct(values: DataFrame, value: str, ordinal: str) -> DataFrame:
    """Distinct values at their first position."""
    return values.groupBy(value).agg(F.min(ordinal).alias(ordinal)).orderBy(ordinal)
