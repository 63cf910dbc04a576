"""Session helpers shared by tests, bench and the driver entry points."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "maskloom") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    base = Path(tempfile.mkdtemp(prefix="maskloom-ship-")) / "maskloom"
    spark.sparkContext.addPyFile(shutil.make_archive(str(base), "zip", root, "maskloom"))
    _shipped.add(application)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path in the shared scratch area for one run.

    The area is the one the cluster names in ``spark.checkpoint.dir``. Only where that is
    unset (a local test) is a folder made on this machine.
    """
    return f"{_shared_root(spark)}/maskloom-{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable, keeping a directory that is already set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_shared_root(spark))


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.sparkContext.getCheckpointDir()
    if root is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    if root is None:
        root = tempfile.mkdtemp(prefix="maskloom-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")
