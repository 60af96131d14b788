"""The Parquet archive: writing, reading, manifest, rotation and compaction."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickharbor.functions.scalars import utc_date
from tickharbor.operators.rotation import MAX_FILE_AGE_US
from tickharbor.schemas import MARKET_EVENT, WRITER_KEY
from tickharbor.session import configure

PARTITIONS = [*WRITER_KEY, "server", "date"]
_VALUES = ["exchange_sequence_id", "timestamp_collector", "timestamp_exchange", "data"]
# Rows per file. With rows of about 5 KB, compressed, a file stays below 500 MB.
MAX_RECORDS_PER_FILE = 500_000


def archive_rows(events: DataFrame, server: str | None = None) -> DataFrame:
    """Events with the partition columns of the archive. The date is that of the receipt.

    The server is tied to a column on purpose: a literal would be dropped from the sort
    order, and the writer would then sort again by folder only and lose the arrival order.
    """
    name = F.concat(F.substring("exchange", 1, 0), F.lit(server or "none"))
    return events.select(
        *WRITER_KEY, name.alias("server"), utc_date("timestamp_collector").alias("date"), *_VALUES)


def _hour(column: str = "timestamp_collector") -> Column:
    return F.floor(F.col(column) / MAX_FILE_AGE_US).cast("bigint")


def write_archive(
    events: DataFrame, root: str, server: str | None = None, write_mode: str = "append",
    max_records: int = MAX_RECORDS_PER_FILE, tasks: int | None = None,
) -> None:
    """Write events under ``key=value`` folders, in arrival order within a file.

    Rows are rebalanced by folder: adaptive execution splits the shuffle partition of a hot
    symbol among several tasks and joins small ones, from the sizes it finds and without
    reading the input twice. Sorting by folder first lets a task keep one file open at a
    time. ``tasks`` asks for a fixed number of range partitions instead, which are cut after
    sampling the input; it suits small tables with many folders.
    """
    rows = archive_rows(events, server)
    order = [*PARTITIONS, "timestamp_collector", "exchange_sequence_id"]
    if tasks:
        # A hash, not a random number: a repeated task must place its rows as before.
        spread_out = rows.repartitionByRange(tasks, *order, F.xxhash64("data"))
    else:
        spread_out = rows.hint("rebalance", *PARTITIONS)
    spread_out.sortWithinPartitions(*order).write.mode(write_mode).option("compression", "zstd") \
        .option("maxRecordsPerFile", max_records).partitionBy(*PARTITIONS).parquet(root)


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """The archive written by :func:`write_archive`; filters on key and date prune folders."""
    partitions = "exchange string, symbol string, data_type string, server string, date string"
    values = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MARKET_EVENT if f.name in _VALUES)
    return configure(spark).read.schema(f"{values}, {partitions}").parquet(root).select(*PARTITIONS, *_VALUES)


def file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per archive file: path, key, rows and bytes. Files without rows are left out."""
    rows = read_archive(spark, root).select(
        "exchange", "symbol", "data_type", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    counted = rows.groupBy("exchange", "symbol", "data_type", "path", "size").agg(F.count("*").alias("rows"))
    return nonempty_files(counted.withColumn("relative_path", F.regexp_extract("path", r"(exchange=.*)$", 1)))


def nonempty_files(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("rows") > 0)


def hourly_groups(events: DataFrame) -> DataFrame:
    """Clock-aligned file groups: rows per key and hour, which need no order and no state."""
    return events.groupBy(*WRITER_KEY, _hour().alias("hour")).agg(
        F.min("timestamp_collector").alias("first_us"), F.max("timestamp_collector").alias("last_us"), F.count("*").alias("rows"))


def write_by_mode(events: DataFrame, mode: str, remote_root: str, local_root: str, server: str | None = None, **options) -> list[str]:
    """Write to the remote root, the local root or both, as ``mode`` says.

    For both, the events are held on the executors' disks, so that they are parsed once; what
    a lost executor held is parsed again.
    """
    roots = {"s3": [remote_root], "local": [local_root], "both": [remote_root, local_root]}[mode]
    held = events.persist(StorageLevel.DISK_ONLY) if len(roots) > 1 else events
    try:
        for root in roots:
            write_archive(held, root, server, **options)
    finally:
        if len(roots) > 1:
            held.unpersist()
    return roots


def compact(spark: SparkSession, root: str, target: str, dates: list[str], max_records: int = MAX_RECORDS_PER_FILE) -> None:
    """Rewrite the given dates with one file per key, or as many as the row bound asks for.

    Every folder gets one shuffle bucket per ``max_records`` rows, so a small one is
    written by one task and a hot one by many. The result goes to another root; reading
    and overwriting the same folder in one job would lose data if the job failed half
    way. Only the given dates are read, and dynamic overwrite replaces only them.
    """
    chosen = read_archive(spark, root).where(F.col("date").isin(dates))
    sizes = chosen.groupBy(*PARTITIONS).agg(F.ceil(F.count("*") / max_records).cast("bigint").alias("__buckets"))
    # A hash of the row, so that a repeated stage places every row where it was.
    bucket = F.pmod(F.xxhash64("exchange_sequence_id", "timestamp_collector", "data"), F.col("__buckets"))
    spread = chosen.join(sizes, PARTITIONS).withColumn("__bucket", bucket).repartition(*PARTITIONS, "__bucket")
    ordered = spread.sortWithinPartitions(*PARTITIONS, "timestamp_collector", "exchange_sequence_id")
    ordered.drop("__buckets", "__bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .option("compression", "zstd").option("maxRecordsPerFile", 2 * max_records).partitionBy(*PARTITIONS).parquet(target)
