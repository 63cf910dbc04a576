"""Reading tables, and the pieces that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom.session import ensure_checkpoint_dir, scratch_dir, ship_package

#: The letters that "lower-case A-Z" means.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fresh_name(frame: DataFrame, stem: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in frame.columns}
    return next(n for n in (f"{stem}{i or ''}" for i in range(len(taken) + 1)) if n not in taken)


def schema_text(frame: DataFrame) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in frame.schema)


_kept: dict[tuple[str, str], tuple] = {}


def kept_for_tasks(owner: str, key: str, make: Callable[[], object], close: Callable[[object], None]):
    """Something large that an operator's tasks share in their Python worker, made once."""
    if (owner, key) not in _kept:
        _kept[owner, key] = (make(), close)
    return _kept[owner, key][0]


def _only_for(owner: str) -> None:
    """What other operators keep in this worker goes: it may be used for theirs no more."""
    for name in [k for k in _kept if k[0] != owner]:
        held, close = _kept.pop(name)
        close(held)


def map_batches(frame: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, owner: str = "") -> DataFrame:
    """``mapInArrow`` with this package at hand in the Python workers.

    ``owner`` names the operator whose :func:`kept_for_tasks` the function uses.
    """
    ship_package(frame.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _only_for(owner)
        yield from function(batches)

    return frame.mapInArrow(run, schema)


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared scratch folder and read back, so that its lineage ends there."""
    spark = frame.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def blocks(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about ``limit``; a row that is larger comes alone."""
    start, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and total + size > limit:
            yield start, row
            start, total = row, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def text_blocks(column: pa.Array, limit: int = 2_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8) for blocks of rows of about ``limit`` bytes; null is empty."""
    binary = column.cast(pa.large_binary()).fill_null(b"")
    sizes = np.diff(np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]) if len(binary) else np.zeros(0, np.int64)
    for start, end in blocks(sizes, limit):
        yield start, binary.slice(start, end - start).to_pylist()
