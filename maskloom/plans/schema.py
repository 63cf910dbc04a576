"""Schema scan, PII shapes and snapshots.

A schema is a DataFrame with one row per leaf column:
``table, column, data_type, shape, fk_target, nullable, ordinal``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions.text import base_type

SCHEMA_DDL = "table string, column string, data_type string, fk_target string, nullable boolean, ordinal int"

# Type names per shape and the shapes worth a finding.
TEXT_TYPES = ("text", "character varying", "varchar", "char", "character", "string")
BINARY_TYPES = ("bytea", "binary")
FREE_TEXT, SUBJECT_REF, BINARY, OTHER = "free_text", "partner_ref", "binary", "other"
FLAGGED_SHAPES = (FREE_TEXT, SUBJECT_REF, BINARY)
SUBJECT_TABLES = ("res_partner",)


def leaf_columns(schema: T.StructType) -> list[tuple[str, T.DataType, bool]]:
    """``(path, leaf type, nullable)`` for every leaf; ``[]`` enters arrays and ``{}`` maps.

    Arrays of plain values count as one column under the array's own name.
    """
    found: list[tuple[str, T.DataType, bool]] = []

    def walk(path: str, dtype: T.DataType, nullable: bool) -> None:
        if isinstance(dtype, T.StructType):
            for child in dtype.fields:
                walk(f"{path}.{child.name}" if path else child.name, child.dataType, nullable or child.nullable)
        elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.StructType, T.ArrayType, T.MapType)):
            walk(f"{path}.[]", dtype.elementType, True)
        elif isinstance(dtype, T.MapType) and isinstance(dtype.valueType, (T.StructType, T.ArrayType, T.MapType)):
            walk(f"{path}." + "{}", dtype.valueType, True)
        else:
            found.append((path, dtype, nullable))

    walk("", schema, False)
    return found


def node_type(schema: T.StructType, path: str) -> T.DataType | None:
    """The type at a path, whether a leaf or a nested value on the way to one; None where there is nothing."""
    if path in schema.fieldNames():
        return schema[path].dataType
    node: T.DataType | None = schema
    for part in path.split("."):
        if part == "[]":
            node = node.elementType if isinstance(node, T.ArrayType) else None
        elif part == "{}":
            node = node.valueType if isinstance(node, T.MapType) else None
        else:
            node = node[part].dataType if isinstance(node, T.StructType) and part in node.fieldNames() else None
        if node is None:
            return None
    return node


def type_shape(dtype: T.DataType) -> str:
    """Shape of a leaf column by what it can hold."""
    if isinstance(dtype, T.ArrayType):
        return type_shape(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return FREE_TEXT if FREE_TEXT in (type_shape(dtype.keyType), type_shape(dtype.valueType)) else type_shape(dtype.valueType)
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType, T.VariantType)):
        return FREE_TEXT
    return BINARY if isinstance(dtype, T.BinaryType) else OTHER


def schema_rows(
    dataset: Mapping[str, DataFrame], refs: Mapping[tuple[str, str], str] | None = None
) -> list[tuple[str, str, str, str | None, bool, int]]:
    refs = refs or {}
    return [
        (table, path, dtype.simpleString(), refs.get((table, path)), nullable, ordinal)
        for table, frame in dataset.items()
        for ordinal, (path, dtype, nullable) in enumerate(leaf_columns(frame.schema))
    ]


def scan_schema(
    spark: SparkSession,
    dataset: Mapping[str, DataFrame],
    refs: Mapping[tuple[str, str], str] | None = None,
    subjects: Iterable[str] = SUBJECT_TABLES,
) -> DataFrame:
    """One row per leaf column of every table, with its shape. Runs no job."""
    return with_shape(spark.createDataFrame(schema_rows(dataset, refs), SCHEMA_DDL), subjects)


def scan_catalog(spark: SparkSession, database: str | None = None) -> DataFrame:
    """:func:`scan_schema` over the tables registered in the session catalog."""
    tables = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    prefix = f"{database}." if database else ""
    return scan_schema(
        spark, {t.name: spark.table(t.name if t.isTemporary else prefix + t.name) for t in tables}
    )


def with_shape(columns: DataFrame, subjects: Iterable[str] = SUBJECT_TABLES) -> DataFrame:
    return columns.withColumn("shape", shape_of(F.col("data_type"), F.col("fk_target"), subjects))


def shape_of(data_type: Column, fk_target: Column, subjects: Iterable[str] = SUBJECT_TABLES) -> Column:
    """A reference wins over the type; it counts only when it points at a person table.

    Type names of a database and of Spark are both understood. In a nested Spark type any string
    leaf makes the column free text.
    """
    base = base_type(data_type)
    nested = F.regexp_replace(F.lower(data_type), r"\w+:", "")
    return (
        F.when(
            fk_target.isNotNull(),
            F.when(F.substring_index(fk_target, ".", 1).isin(list(subjects)), F.lit(SUBJECT_REF)).otherwise(F.lit(OTHER)),
        )
        .when(base.isin(*TEXT_TYPES), F.lit(FREE_TEXT))
        .when(nested.rlike("^(array|map|struct)<") & nested.rlike(r"\b(string|varchar|char)\b"), F.lit(FREE_TEXT))
        .when(base.isin("variant", "json", "jsonb"), F.lit(FREE_TEXT))
        .when(base.isin(*BINARY_TYPES), F.lit(BINARY))
        .when(nested.rlike("^(array|map|struct)<") & nested.rlike(r"\bbinary\b"), F.lit(BINARY))
        .otherwise(F.lit(OTHER))
    )


def resolve_references(columns: DataFrame, constraints: DataFrame) -> DataFrame:
    """Attach declared references to columns with one join.

    ``constraints`` has ``table, columns array, ref_table, ref_columns array``; composite keys pair
    their columns by position.
    """
    pairs = constraints.select(
        "table", "ref_table", F.explode(F.arrays_zip(F.col("columns").alias("l"), F.col("ref_columns").alias("r"))).alias("p")
    ).where(F.col("p.l").isNotNull() & F.col("p.r").isNotNull())
    targets = pairs.groupBy("table", F.col("p.l").alias("column")).agg(
        F.min(F.concat_ws(".", "ref_table", "p.r")).alias("declared_target")
    )
    joined = columns.join(targets, ["table", "column"], "left")
    return joined.select(
        *[F.col(c) for c in columns.columns if c != "fk_target"],
        F.coalesce("declared_target", "fk_target").alias("fk_target"),
    ).select(*columns.columns)


def save_snapshot(columns: DataFrame, path: str, file_format: str = "json") -> None:
    columns.coalesce(1).write.mode("error").format(file_format).save(path)


def load_snapshot(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    return spark.read.schema(SCHEMA_DDL + ", shape string").format(file_format).load(path)
