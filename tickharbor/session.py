"""Session settings the library relies on, and the durable cut of a lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings that results depend on; all of them can be changed on a running session.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# Settings that only speed depends on. Generated methods above 8000 bytes of code are never
# compiled by the JIT, and the frame rules would exceed that in one piece. The lower minimum
# keeps all cores busy on small tables; large ones are cut by the advisory size anyway.
SPEED_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Sessions of a hot key are merged where they are read, before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's settings to a session made elsewhere."""
    for key, value in {**RESULT_SETTINGS, **SPEED_SETTINGS}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "tickharbor", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution; cluster size and memory come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    for key, value in {**defaults, **RESULT_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, wherever they and the driver were started.

    Spark serves the archive from the driver; executors need no access to the folder it lies in.
    """
    context, package = spark.sparkContext, Path(__file__).resolve().parent
    if context.applicationId in _shipped or not package.is_dir():
        return
    folder = os.path.realpath(tempfile.mkdtemp(prefix="tickharbor-"))
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
    _shipped.add(context.applicationId)


def spread(df: DataFrame) -> DataFrame:
    """Spread a table that has fewer splits than the session has cores.

    Only a table too small to be split needs it; a large one is read as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a ``local`` master, as in tests, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tickharbor-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for tables that a job writes and reads again."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a table that a job has written itself and no longer needs; nothing happens if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder, which outlives any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: a durable cut whose columns can be pruned."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
