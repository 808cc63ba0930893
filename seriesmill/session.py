"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings for a session of our own. A cluster session brings its own values.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Call sites of column expressions are not recorded, which shortens the
    # building of plans with many expressions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def shuffle_settings(
    input_bytes: int, shuffled_share: float = 0.1, partition_bytes: int = 128 * 1024**2
) -> dict[str, str]:
    """Settings for a cluster session that reads `input_bytes` of raw tables.

    Adaptive execution merges small partitions and splits skewed ones, but it does
    not cut partitions that are evenly large. The first number of partitions must
    therefore suit the widest shuffle, which keeps `shuffled_share` of the input.
    """
    partitions = max(200, int(input_bytes * shuffled_share) // partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


def local_session(name: str, cores: int | str = "*", **settings: str) -> SparkSession:
    """Session for tests and for the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Tasks that run functions of the package import it on the executors, where it
    is not installed. Spark hands the file out from the driver.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = f"{tempfile.mkdtemp(prefix='seriesmill-code-')}/seriesmill.zip"
    with zipfile.ZipFile(target, "w") as code:
        for source in sorted(package.rglob("*.py")):
            code.write(source, source.relative_to(package.parent))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


#: Bytes of rows that Spark hands to Python at once. Executor and worker each hold a batch,
#: and its texts again as strings, numbers and lists.
BATCH_BYTES = 2 << 20


def bound_batches(spark: SparkSession) -> None:
    """Batches of BATCH_BYTES for Python functions, unless the session names a size of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors reach, named by `spark.checkpoint.dir`.

    Only where the session does not name one (local tests) a temporary folder is
    made and remembered in the session.
    """
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.seriesmill.scratch", None)
    )
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="seriesmill-")
        spark.conf.set("spark.seriesmill.scratch", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
