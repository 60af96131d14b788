"""An archive that streams write to and readers see by version.

``root/data/part=P/date=D/...`` holds the files of one batch or one compaction; ``root/versions/version=N`` is a table
of the (part, date) folders that make up version N, with the last batch in it. A version counts once Spark has marked
its table as complete, so readers see all of a batch or nothing of it, and the files from before a compaction or those
after it, never both. One writer at a time advances a root; readers need no lock.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickharbor.operators.parsing import market_events, parse_frames
from tickharbor.schemas import MARKET_EVENT, WRITER_KEY
from tickharbor.session import configure, remove_folder
from tickharbor.sources.archive import MAX_RECORDS_PER_FILE, archive_rows

FOLDER = [*WRITER_KEY, "server"]
_ENTRY = "part string, date string, rows bigint, batch bigint"
_VALUES = ["exchange_sequence_id", "timestamp_collector", "timestamp_exchange", "data"]
# Folders that a date may have before a compaction joins them, and versions that are kept for readers.
MOST_PARTS = 8
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class Version:
    """The folders of one version: (part, date, rows); ``batch`` is the last one in it, -1 before any."""

    number: int
    batch: int
    folders: tuple[tuple[str, str, int], ...]


def _path(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(folder)] if fs.exists(folder) else []


def _complete(spark: SparkSession, path: str) -> bool:
    fs, marker = _path(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, newest first."""
    found = sorted((int(name.split("=")[1]) for name in _names(spark, f"{root}/versions") if name.startswith("version=")), reverse=True)
    return [number for number in found if _complete(spark, f"{root}/versions/version={number}")]


def current_version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest complete version, or the given one; version 0 of an empty root holds nothing.

    The driver holds one row for each folder of (part, date): at most ``MOST_PARTS`` a date where compaction keeps up.
    """
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    if number is None:
        number = numbers[0] if numbers else 0
    if number == 0:
        return Version(0, -1, ())
    if number not in numbers:
        raise ValueError(f"version {number} is not there; complete ones: {numbers}")
    entries = spark.read.schema(_ENTRY).parquet(f"{root}/versions/version={number}").collect()
    folders = tuple(sorted((row.part, row.date, row.rows) for row in entries if row.part is not None))
    return Version(number, max(row.batch for row in entries), folders)


def _publish(spark: SparkSession, root: str, before: Version, batch: int, folders: list[tuple[str, str, int]]) -> Version:
    """Write the next version. A row without a part carries the batch of a version without folders."""
    rows = [(part, day, n, batch) for part, day, n in folders] or [(None, None, None, batch)]
    number = before.number + 1
    spark.createDataFrame(rows, _ENTRY).coalesce(1).write.mode("overwrite").parquet(f"{root}/versions/version={number}")
    return Version(number, batch, tuple(sorted(folders)))


def _write_part(rows: DataFrame, root: str, part: str, max_records: int) -> list[tuple[str, str, int]]:
    """Write rows as one part, a bounded number of files in each folder, and count them by date.

    Rows are rebalanced by folder, so quiet symbols share tasks and a hot one gets several. A repeated write replaces
    the folder of its part, which no version names yet.
    """
    target = f"{root}/data/part={part}"
    ordered = ["date", *FOLDER]
    rows.hint("rebalance", *ordered).sortWithinPartitions(*ordered, "timestamp_collector", "exchange_sequence_id") \
        .write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", max_records) \
        .partitionBy(*ordered).parquet(target)
    if not any(name.startswith("date=") for name in _names(rows.sparkSession, target)):
        return []
    counted = _folders(rows.sparkSession, root, [target]).groupBy("date").agg(F.count("*").alias("rows")).collect()
    return [(part, row.date, row.rows) for row in counted]


def _folders(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    partitions = "part string, date string, exchange string, symbol string, data_type string, server string"
    values = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MARKET_EVENT if f.name in _VALUES)
    reader = configure(spark).read.schema(f"{values}, {partitions}").option("basePath", f"{root}/data")
    return reader.parquet(*paths).select(*FOLDER, "date", *_VALUES)


def commit_batch(events: DataFrame, root: str, batch: int, server: str | None = None, max_records: int = MAX_RECORDS_PER_FILE) -> Version:
    """Add one batch of events as the next version. Repeating the last batch changes nothing; an earlier number is an error.

    A batch that was interrupted leaves files that no version names; the repeated one replaces them. A batch without
    rows is a version as well, so that its number is remembered.
    """
    spark, root = events.sparkSession, root.rstrip("/")
    before = current_version(spark, root)
    if batch == before.batch:
        return before
    if batch < before.batch:
        raise ValueError(f"batch {batch} after {before.batch}: the root belongs to another checkpoint")
    rows = archive_rows(events, server)
    return _publish(spark, root, before, batch, [*before.folders, *_write_part(rows, root, f"batch-{batch}", max_records)])


def read_committed(spark: SparkSession, root: str, dates: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
    """The rows of the newest complete version, or of a given one that is still kept.

    ``dates`` leaves out folders before any is listed; filters on the other keys prune partitions as well.
    """
    root = root.rstrip("/")
    wanted = None if dates is None else set(dates)
    held = current_version(spark, root, version)
    paths = [f"{root}/data/part={part}/date={day}" for part, day, _ in held.folders if wanted is None or day in wanted]
    if paths:
        return _folders(spark, root, paths)
    empty = ", ".join([*[f"{name} string" for name in [*FOLDER, "date"]],
                       *[f"{f.name} {f.dataType.simpleString()}" for f in MARKET_EVENT if f.name in _VALUES]])
    return spark.createDataFrame([], empty)


def compact_committed(spark: SparkSession, root: str, most_parts: int = MOST_PARTS, max_records: int = MAX_RECORDS_PER_FILE) -> Version:
    """Join the folders of every date that has more than ``most_parts``, and let readers switch to the result at once.

    Only those dates are read and written. Reads of the version before go on with its files until :func:`vacuum`.
    """
    root = root.rstrip("/")
    before = current_version(spark, root)
    by_date: dict[str, int] = {}
    for _, day, _ in before.folders:
        by_date[day] = by_date.get(day, 0) + 1
    crowded = {day for day, parts in by_date.items() if parts > most_parts}
    if not crowded:
        return before
    joined = _write_part(read_committed(spark, root, crowded, before.number or None), root, f"joined-{before.number + 1}", max_records)
    rows = {day: sum(n for _, d, n in before.folders if d == day) for day in crowded}
    if rows != {day: n for _, day, n in joined}:
        raise RuntimeError("a compaction does not hold the rows that it read")
    kept = [entry for entry in before.folders if entry[1] not in crowded]
    return _publish(spark, root, before, before.batch, [*kept, *joined])


def vacuum(spark: SparkSession, root: str, keep: int = KEPT_VERSIONS) -> list[str]:
    """Remove versions but the newest ``keep``, then the folders that none of them names; returns those folders.

    A reader of an older version loses its files, so ``keep`` must cover the time a read takes. Folders of a batch
    that is being written are newer than any version and stay.
    """
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    if not numbers:
        return []
    kept = [current_version(spark, root, number) for number in numbers[:max(1, keep)]]
    named = {(part, day) for version in kept for part, day, _ in version.folders}
    for number in numbers[max(1, keep):]:
        remove_folder(spark, f"{root}/versions/version={number}")
    gone = []
    for name in _names(spark, f"{root}/data"):
        part = name.removeprefix("part=")
        kind, _, order = part.partition("-")
        if order.isdigit() and (int(order) > kept[0].batch if kind == "batch" else int(order) > kept[0].number):
            continue
        days = [day.removeprefix("date=") for day in _names(spark, f"{root}/data/{name}") if day.startswith("date=")]
        for day in days:
            if (part, day) not in named:
                remove_folder(spark, f"{root}/data/{name}/date={day}")
                gone.append(f"{name}/date={day}")
        if not any(owner == part for owner, _ in named):
            remove_folder(spark, f"{root}/data/{name}")
    return sorted(gone)


def committed_stream(
    frames: DataFrame, root: str, checkpoint: str, server: str | None = None, trigger: dict | None = None,
    most_parts: int = MOST_PARTS, max_records: int = MAX_RECORDS_PER_FILE, keep: int = KEPT_VERSIONS,
) -> StreamingQuery:
    """Parse frames into a committed archive, each micro-batch one version, with compaction between batches.

    The batch is held on the executors' disks, so that its frames are parsed once; what a lost executor held is parsed
    again. Nothing is dropped, however late it is. The root belongs to this stream and its checkpoint alone.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.DISK_ONLY)
        try:
            commit_batch(held, root, batch_id, server, max_records)
        finally:
            held.unpersist()
        compact_committed(batch.sparkSession, root, most_parts, max_records)
        vacuum(batch.sparkSession, root, keep)

    return market_events(parse_frames(frames)).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or {"availableNow": True})).start()
