"""A masked stream that publishes batch by batch, each only after its checks.

Layout: ``<target>/data/batch=<id>/*.parquet`` and ``<target>/_ledger/<id>.json``. A batch is masked, written once, checked
on what was written, and published by its ledger entry, the one small file that comes last. A batch that is run
again after a lost driver finds its entry and does nothing, or finds none and is written anew; so a restart
neither repeats nor skips one. Readers take the batches of the ledger and nothing else.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from maskloom.operators.leakscan import assert_no_leak, leak_scan
from maskloom.operators.verify import Expectation, VerificationError, assert_report, observed_checks, observed_report
from maskloom.plans import rulebook as rb
from maskloom.plans.mask import mask
from maskloom.sources import bundle

PUBLISHED, HELD = "published", "held"
LEDGER = "batch bigint, status string, rows bigint, reason string"


class GateError(Exception):
    """A batch that must not be published."""


def _entry(target: str, batch: int) -> str:
    return f"{target}/_ledger/{batch}.json"


def publish_batch(
    batch: DataFrame, number: int, table: str, book: rb.Rulebook, target: str, checks: Sequence[Expectation] = (), salt: str = "", min_length: int = 1, hold: bool = False
) -> str:
    """Mask, write, check and publish one batch; the status in the ledger afterwards.

    The whole plan is at hand, shuffles and scoped replacement included, within the batch. Violations are counted by
    the job that writes; the leak scan looks for the batch's own originals in what was written. A batch
    that fails leaves no data. Without ``hold`` it raises, the stream stops, and a restart tries it again; with it
    the ledger says why it was held back and the stream goes on.
    """
    spark, target = batch.sparkSession, target.rstrip("/")
    if bundle._exists(spark, _entry(target, number)):
        return json.loads(bundle._read_text(spark, _entry(target, number)))["status"]
    place = f"{target}/data/batch={number}"
    bundle._fs(spark, place).delete(bundle._path(spark, place), True)  # of an attempt that was lost
    masked = mask({table: batch}, book, salt)
    metrics, known = observed_checks(masked.dataset, checks)
    counted = bundle.write_observed(spark, masked.dataset[table], place, metrics.get(table, ()))
    entry = {"batch": number, "status": PUBLISHED, "rows": counted["rows"], "reason": None}
    try:
        assert_report(observed_report({table: counted}, known))
        needles = masked.plan.secret_values({table: batch})
        if needles is not None:
            assert_no_leak(leak_scan({table: spark.read.parquet(place)}, needles.select("value"), min_length))
    except Exception as failure:
        bundle._fs(spark, place).delete(bundle._path(spark, place), True)
        if not hold:
            raise GateError(f"{table}, batch {number}: {failure}") from failure
        # The message of a leak names values; the ledger is published.
        entry |= {"status": HELD, "reason": str(failure) if isinstance(failure, VerificationError) else type(failure).__name__}
    bundle._write_text(spark, _entry(target, number), json.dumps(entry))
    return entry["status"]


def publish_stream(
    stream: DataFrame, table: str, book: rb.Rulebook, target: str, checkpoint: str, checks: Sequence[Expectation] = (), salt: str = "", min_length: int = 1, hold: bool = False
) -> StreamingQuery:
    """Publish what is there, a batch at a time, and stop; rerun with the same ``checkpoint`` for what is new.

    A batch is read more than once (for writing and for its originals), so the source must give it again alike, as
    files and logs do.
    """

    def each(batch: DataFrame, number: int) -> None:
        publish_batch(batch, number, table, book, target, checks, salt, min_length, hold)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """``batch, status, rows, reason`` of every batch that was decided."""
    folder = f"{target.rstrip('/')}/_ledger"
    if not bundle._exists(spark, folder):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).json(f"{folder}/*.json")


def published(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all published batches, with their number as ``batch``; an attempt under way is not seen."""
    numbers = [r.batch for r in ledger(spark, target).where(F.col("status") == PUBLISHED).select("batch").collect()]
    if not numbers:
        raise GateError(f"{target} has no published batch")
    data = f"{target.rstrip('/')}/data"
    return spark.read.option("basePath", data).parquet(*[f"{data}/batch={n}" for n in sorted(numbers)])
