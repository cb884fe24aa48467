"""Session settings the jobs rely on, and where their checkpoints go."""

from __future__ import annotations

import contextlib
import contextvars
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # call sites of every column expression cost more than the planning itself
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(
    cores: str | int = "*",
    memory: str = "8g",
    partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("docintake")
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Directory for reliable checkpoints.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    master may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    target = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if not target:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        target = tempfile.mkdtemp(prefix="docintake-ckpt-")
    context.setCheckpointDir(target)
    return context.getCheckpointDir()


# what a Python task holds at once; long texts make the default of 64 MB several times that
BATCH_BYTES = 4 << 20


def prepare_python(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, and bound Arrow batches."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(setting) == "67108864b":  # the default; a chosen value stays
        spark.conf.set(setting, str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_docintake_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="docintake-"), "docintake")
    archive = shutil.make_archive(base, "zip", os.path.dirname(root), os.path.basename(root))
    context.addPyFile(archive)
    context._docintake_shipped = True


_RUN = contextvars.ContextVar("docintake_run", default="shared")


@contextlib.contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Put the tables :func:`cut` writes inside the block into a folder of their own."""
    name = uuid.uuid4().hex
    token = _RUN.set(name)
    try:
        yield f"{ensure_checkpoint_dir(spark)}/{name}"
    finally:
        _RUN.reset(token)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a run folder once nothing reads from it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and go on from there.

    Like a checkpoint it ends the lineage and outlives executors. As a table it is read
    column by column, and its size is known to the planner.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{_RUN.get()}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
