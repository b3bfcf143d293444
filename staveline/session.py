"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Bad numbers fail the job instead of becoming NULL.
    "spark.sql.ansi.enabled": "true",
    # Date and timestamp text is defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split at run time, even where that costs one more
    # exchange in front of the aggregation that follows the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once a session.

    For operators with Python in their tasks, so that they run from any working
    directory. The package lies in the shared scratch folder, where workers fetch it.
    """
    context = spark.sparkContext
    if getattr(context, "_staveline_shipped", None) is None:
        packed, root = io.BytesIO(), Path(__file__).resolve().parent
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            for file in sorted(root.rglob("*.py")):
                archive.write(file, str(file.relative_to(root.parent)))
        target = scratch_folder(spark, "staveline") + ".zip"
        path = context._jvm.org.apache.hadoop.fs.Path(target)
        out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(packed.getvalue()))
        out.close()
        context.addPyFile(target)
        context._staveline_shipped = target
    return spark


def local_session(cores: str = "*", app: str = "staveline", memory: str = "8g") -> SparkSession:
    """A session for tests and small runs on one machine.

    Unless Spark's own settings name a shared folder, it gets a new one.
    """
    given = SparkConf().get("spark.checkpoint.dir")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if not given:
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="staveline-"))
    return tune(builder.getOrCreate())


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``.

    The folder is set when the session is built; ``local_session`` does so.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError(
            "build the session with spark.checkpoint.dir, a folder that the driver and all executors share"
        )
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession, drop: bool = True) -> Iterator[None]:
    """Queries that end within leave no shuffle files behind, if ``drop`` is set."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true" if drop else before)
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def settled(df: DataFrame, label: str, drop_shuffles: bool = False) -> DataFrame:
    """The frame written to the shared folder and read back; runs its jobs at once.

    For results that are read more than once: the work is done once and a lost
    executor does not bring it back. ``release`` removes the folder again.
    ``drop_shuffles`` has Spark remove the shuffle files of the write once it has
    ended, for jobs of many rounds whose shuffles are large against what is stored.
    """
    spark, folder = df.sparkSession, scratch_folder(df.sparkSession, label)
    with shuffles_dropped(spark, drop_shuffles):
        df.write.parquet(folder)
    stored = df.sparkSession.read.schema(df.schema).parquet(folder)
    stored.stored_in = folder
    return stored


def release(df: DataFrame) -> None:
    """Remove what ``settled`` stored for this frame, which cannot be read after that."""
    folder = df.__dict__.get("stored_in")
    if folder is None:
        raise ValueError("this frame was not stored by settled()")
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
