"""The archive whose folders are bare values: venue/symbol/type/[server/]date/stamp.parquet.

A file holds what one writer took in between opening and closing it; the date and the stamp (milliseconds) in its
path are those of its opening. Spark's own writer names folders ``key=value``, so here Spark places and orders the
rows, and the tasks write the files. Such paths have no partition columns; filters become paths that are listed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickharbor.functions.scalars import archive_path, whole
from tickharbor.operators.rotation import MAX_FILE_AGE_US, rotation_files
from tickharbor.schemas import ARCHIVE_FILE, WRITER_KEY
from tickharbor.session import configure, ship, stored

MANIFEST = "relative_path string, exchange string, symbol string, data_type string, rows bigint, size bigint"
# Rows that a task holds before it writes them as one row group.
GROUP_ROWS = 50_000
_GLOB_CHARACTERS = set("*?[]{},\\/")


def with_file(events: DataFrame, server: str | None = None, age_us: int = MAX_FILE_AGE_US, **rules) -> DataFrame:
    """Events with ``relative_path``, the file that each belongs to.

    ``rules`` go to :func:`~tickharbor.operators.rotation.rotation_files`. Rows of the very time at which the next file
    opens are placed in that one. Events and openings meet by key and time cell, so a hot key is many cells.
    Events are stored first, so they are computed once however dear they are.
    """
    events = stored(events, "plain-events")
    opened = rotation_files(events, age_us=age_us, **rules).groupBy(*WRITER_KEY, "opened_us").agg(F.max("last_us").alias("last_us"))
    following = F.lead("opened_us").over(Window.partitionBy(*WRITER_KEY).orderBy("opened_us"))
    # Before the cells: a window beside a generator would run over its rows.
    bounded = opened.withColumn("__until", following)
    cells = F.explode(F.sequence(whole("opened_us", age_us), whole("last_us", age_us)))
    files = bounded.select(*[F.col(key).alias(f"__{key}") for key in WRITER_KEY], "opened_us", "__until", cells.alias("__cell"))
    same = [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in WRITER_KEY]
    inside = (F.col("timestamp_collector") >= F.col("opened_us")) & (
        F.col("__until").isNull() | (F.col("timestamp_collector") < F.col("__until")))
    condition = (whole("timestamp_collector", age_us) == F.col("__cell")) & inside
    for test in same:
        condition &= test
    names = [F.coalesce(F.nullif(F.col(key), F.lit("")), F.lit("unknown")) for key in WRITER_KEY]
    path = archive_path(*names, "opened_us", None if server is None else F.lit(server))
    return events.join(files, condition).select(*events.columns, path.alias("relative_path"))


def _write_files(root: str):
    """A function of Arrow batches in order of path that writes their files and yields the manifest."""
    columns = [field.name for field in ARCHIVE_FILE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(root) if "://" in root else (pyarrow.fs.LocalFileSystem(), root.removeprefix("file:"))
        writer, path, hidden, key, rows, held = None, None, None, None, 0, []

        def flush() -> None:
            if held:
                writer.write_table(pa.Table.from_batches(held))
                held.clear()

        def close() -> pa.RecordBatch:
            # The file appears under its name at once and whole; a repeated task replaces it by the same rows.
            flush()
            writer.close()
            fs.move(hidden, f"{base}/{path}")
            size = fs.get_file_info(f"{base}/{path}").size
            return pa.RecordBatch.from_pydict(
                {"relative_path": [path], **{name: [value] for name, value in zip(WRITER_KEY, key)}, "rows": [rows], "size": [size]},
                pa.schema([("relative_path", pa.string()), *[(name, pa.string()) for name in WRITER_KEY], ("rows", pa.int64()), ("size", pa.int64())]))

        for batch in batches:
            # Runs of equal paths; the rows come sorted by path.
            ends = pa.compute.run_end_encode(batch.column("relative_path"))
            start = 0
            for end, found in zip(ends.run_ends.to_pylist(), ends.values.to_pylist()):
                piece = batch.slice(start, end - start)
                if found != path:
                    if writer is not None:
                        yield close()
                    path, rows, key = found, 0, [piece.column(name)[0].as_py() for name in WRITER_KEY]
                    folder, name = f"{base}/{path}".rsplit("/", 1)
                    fs.create_dir(folder, recursive=True)
                    hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
                    writer = pq.ParquetWriter(hidden, piece.select(columns).schema, filesystem=fs, compression="zstd")
                held.append(piece.select(columns))
                rows += piece.num_rows
                if sum(len(part) for part in held) >= GROUP_ROWS:
                    flush()
                start = end
        if writer is not None:
            yield close()

    return run


def write_plain_archive(events: DataFrame, root: str, server: str | None = None, age_us: int = MAX_FILE_AGE_US, **rules) -> DataFrame:
    """Write events as bare-value folders, one file per opening, in arrival order; returns the manifest of the files.

    A file is written by one task, and its rows are those of at most one age of one key (or of one maximum size with
    ``size``, see :func:`with_file`); a task holds ``GROUP_ROWS`` of them. A null or empty key is the folder
    ``unknown``. Receipt times must not be null. Files of the same key and millisecond are one file. No events, no
    files and an empty manifest. ``root`` must be a folder that all executors share and Arrow reaches.
    """
    ship(events.sparkSession)
    texts = [F.col(field.name) for field in ARCHIVE_FILE]
    placed = with_file(events, server, age_us, **rules).select("relative_path", *texts, "data_type").repartition("relative_path")
    ordered = placed.sortWithinPartitions("relative_path", "timestamp_collector", "exchange_sequence_id", "timestamp_exchange", "data")
    return stored(ordered.mapInArrow(_write_files(root.rstrip("/")), MANIFEST), "plain-manifest")


def _choice(values: Iterable[str] | None) -> str:
    """A path part that matches the given values, or any."""
    if values is None:
        return "*"
    chosen = sorted(set(values))
    for value in chosen:
        if not value or _GLOB_CHARACTERS & set(value):
            raise ValueError(f"not the name of a folder: {value!r}")
    return "{" + ",".join(chosen) + "}"


def plain_paths(
    root: str, venues: Iterable[str] | None = None, symbols: Iterable[str] | None = None,
    data_types: Iterable[str] | None = None, dates: Iterable[str] | None = None,
) -> str:
    """The folders to list for the given values, with or without a server level before the date."""
    parts = [_choice(values) for values in (venues, symbols, data_types)]
    if dates is not None:
        days = _choice(dates)[1:-1].split(",")
        parts.append("{" + ",".join([*days, *[f"*/{day}" for day in days]]) + "}")
    while parts and parts[-1] == "*":
        parts.pop()
    return "/".join([root.rstrip("/"), *parts])


def read_plain_archive(
    spark: SparkSession, root: str, globs: Iterable[str] = (), *, venues: Iterable[str] | None = None,
    symbols: Iterable[str] | None = None, data_types: Iterable[str] | None = None, dates: Iterable[str] | None = None,
) -> DataFrame:
    """An archive of bare-value folders, with type, server, date and stamp from the path.

    Only the folders of the given venues, symbols, types and dates are listed and read; ``None`` is all of them, an
    empty list none. The date is that of the file's opening: rows received shortly after midnight may lie in a
    file of the day before. ``globs`` (relative to the root, as in ``binance/btcusdt/*``) names folders directly.
    Nothing found is an empty table.
    """
    wanted = [None if values is None else list(values) for values in (venues, symbols, data_types, dates)]
    paths = [f"{root.rstrip('/')}/{glob}" for glob in globs] or [plain_paths(root, *wanted)]
    reader = configure(spark).read.schema(ARCHIVE_FILE).option("recursiveFileLookup", "true")
    path = F.col("_metadata.file_path")
    try:
        if any(values == [] for values in wanted):
            raise FileNotFoundError
        rows = reader.parquet(*paths).withColumn("__path", path)
    except (AnalysisException, FileNotFoundError) as missing:
        if isinstance(missing, AnalysisException) and missing.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], ARCHIVE_FILE).withColumn("__path", F.lit(""))
    tail = r"/(orderbook|trade)/(?:([^/]+)/)?(\d{4}-\d{2}-\d{2})/(\d+)\.parquet$"
    return rows.select(
        *[field.name for field in ARCHIVE_FILE],
        F.regexp_extract("__path", tail, 1).alias("data_type"),
        F.nullif(F.regexp_extract("__path", tail, 2), F.lit("")).alias("server"),
        F.regexp_extract("__path", tail, 3).alias("file_date"),
        F.regexp_extract("__path", tail, 4).try_cast("bigint").alias("file_ts"),
        F.col("__path").alias("file_path"))
