"""Dataset sources: folders of files, catalogs and databases, one lazy DataFrame per table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_folder(
    spark: SparkSession, folder: str, names: Iterable[str], file_format: str = "parquet", suffix: str = ".parquet"
) -> dict[str, DataFrame]:
    """``<folder>/<name><suffix>`` for every name."""
    root = folder.rstrip("/")
    return {name: spark.read.format(file_format).load(f"{root}/{name}{suffix}") for name in names}


def read_catalog(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """Tables of one database; temporary views belong to the session and are left out."""
    listed = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    return {name: spark.table(f"{database}.{name}") for name in listed}


@dataclass(frozen=True)
class Split:
    """How a database table is read in parallel: ranges of one column."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int


def read_jdbc(
    spark: SparkSession, url: str, tables: Mapping[str, Split | None], options: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """Tables of a database. Give big tables a :class:`Split`, or one task reads them whole."""
    frames = {}
    for name, split in tables.items():
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**(options or {}))
        if split is not None:
            reader = reader.options(
                partitionColumn=split.column,
                lowerBound=str(split.lower),
                upperBound=str(split.upper),
                numPartitions=str(split.partitions),
            )
        frames[name] = reader.load()
    return frames


def without_content(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Content columns as typed NULLs; the scan below never reads them."""
    return frame.select(
        *[
            F.lit(None).cast(f.dataType).alias(f.name) if f.name in columns else F.col(f"`{f.name}`")
            for f in frame.schema.fields
        ]
    )
