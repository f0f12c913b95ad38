"""Session settings and the shared folder that materialised tables go to."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Shuffle width is left to the cluster: size spark.sql.shuffle.partitions so that
# one shuffled partition holds 100-200 MB, and AQE merges whatever turns out small.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "skyledger", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `extra` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local-mode session may fall back to a temporary folder; on a cluster a
    missing setting is an error, because executors do not share a local disk. A `file:` folder
    is taken at its word: it has to be a mount that all hosts share.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    current = context.getCheckpointDir()
    if current is not None:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="skyledger-"))
    return context.getCheckpointDir().rstrip("/")


def application_folder(spark: SparkSession, name: str) -> str:
    """A path that stays the same for one name while the application runs."""
    return f"{shared_folder(spark)}/skyledger-{spark.sparkContext.applicationId}/{name}"


# Folders handed out inside the innermost `scratch` block.
_HANDED_OUT: ContextVar[list[str] | None] = ContextVar("handed out", default=None)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path no earlier call has used."""
    path = application_folder(spark, f"{name}-{uuid.uuid4().hex}")
    handed_out = _HANDED_OUT.get()
    if handed_out is not None:
        handed_out.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is written to fresh folders inside the block when it ends, failed or not.

    Results that still read those tables have to be written or collected inside the block.
    """
    token = _HANDED_OUT.set([])
    try:
        yield
    finally:
        for path in _HANDED_OUT.get():
            delete(spark, path)
        _HANDED_OUT.reset(token)


def delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    The written table survives lost executors, cuts the lineage, and gives Catalyst
    the true size of the data for its choice of join.
    """
    path = fresh_folder(df.sparkSession, name)
    if partition_by:
        # rows of one value meet in few tasks, which then write few files
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that `materialize` wrote, once what was made of it is written too."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        delete(df.sparkSession, folder)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of what has been written since.

    It deletes them once the driver has collected the plans as garbage, which a driver with memory to
    spare does too late for the disks of the executors.
    """
    gc.collect()
    for _ in range(2):  # events of a job that has just ended still name its plan
        spark._jvm.System.gc()
        time.sleep(0.5)


def discard_application_folder(spark: SparkSession) -> None:
    """Delete the tables this application wrote to the shared folder.

    Call it once no result is needed that still reads them, such as at the end of a job.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.getCheckpointDir() is None:
        return
    delete(spark, application_folder(spark, ""))
