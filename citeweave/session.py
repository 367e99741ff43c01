"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the plans in this package rely on.  Sizes are per task, so they hold
# at any data volume; AQE joins the partitions a shuffle begins with until they reach them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
    # Also limits of more than a thousand rows per group act before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    # Encoder batches: rows per Arrow batch, so long texts do not pile up.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}
# Partitions a shuffle begins with on a cluster: at the advised 128 MB each, enough for 1 TB.
# A shuffle of more has larger partitions; pass a larger number for it.
INITIAL_PARTITIONS = 8192
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(app: str = "citeweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``conf`` adds to or overrides them (``__`` for ``.``).

    On a cluster shuffles begin with :data:`INITIAL_PARTITIONS`, unless the session says otherwise.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    overrides = {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    if not session.sparkContext.master.startswith("local") and session.conf.get(_INITIAL, None) is None:
        session.conf.set(_INITIAL, INITIAL_PARTITIONS)
    return session


_local_roots: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """Shared folder for written tables and stream checkpoints.

    It is the one the cluster names in ``spark.checkpoint.dir``.  Only a local
    session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        folder = tempfile.mkdtemp(prefix="citeweave-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_roots[context.applicationId] = folder
    return _local_roots[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the work folder that nothing has been written to."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, as ``--py-files`` does at submit."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="citeweave-zip-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
    _shipped.add(context.applicationId)
