"""The per-column rewrites on a stream: the same projection as in batch, append mode.

Cross-row operators (shuffle, leak scan) are batch-only; run them per batch where needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from maskloom.operators.policies import rotate_columns
from maskloom.plans import rulebook as rb
from maskloom.plans.mask import build_plan, require_salt, rewrite_table, table_key
from maskloom.plans.strategies import MaskError
from maskloom.sources import bundle


def mask_stream(stream: DataFrame, table: str, book: rb.Rulebook, salt: str = "") -> DataFrame:
    """Mask a streaming table by its row rules, patterns, rotations, key/value and content policies."""
    plan = build_plan({table: stream}, book).tables[table]
    if plan.shuffles or plan.scoped:
        raise MaskError(f"{table}: shuffled and scoped-replace columns need all rows; mask them in batch")
    require_salt([plan], salt)
    masked = rewrite_table(stream, plan, table_key(book, table, stream), salt)
    masked = rotate_columns(masked, plan.rotations) if plan.rotations else masked
    for policy in [*plan.key_values, *plan.contents]:
        masked = policy.apply(masked)
    return masked


def mask_available(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    table: str,
    book: rb.Rulebook,
    glob: str | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Mask the files present in a folder into ``target`` and stop; rerun to pick up new files.

    ``glob`` narrows the files by name; where a folder of that name is in ``source``, its files are meant.

    Progress lives in ``checkpoint``, so a restarted run writes nothing twice.
    """
    if glob and bundle._is_folder(spark, f"{source.rstrip('/')}/{glob}"):
        source, glob = f"{source.rstrip('/')}/{glob}", None
    options = {"pathGlobFilter": glob} if glob else {}
    schema = spark.read.options(**options).parquet(source).schema
    stream = spark.readStream.schema(schema).options(**options).parquet(source)
    writer = mask_stream(stream, table, book).writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (
        writer.option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
