"""Token ids of documents as raw binary shards with a constant-time index.

A shard is a pair of files. ``.ids`` holds the ids of its documents one after another, little-endian, in
ascending order of ``doc_id``: two bytes each if the vocabulary has at most 65,536 ids, else four. ``.idx``
holds, in this order and little-endian: a header of four 8-byte integers (version, bytes per id, rows,
keys), the 8-byte key of each row, a byte per row that is 1 if its key is null, the 8-byte ends of the rows
in ids, the minimal perfect hash of the keys, and for each place of the hash a 4-byte fingerprint, the
4-byte first row and the 4-byte number of rows of the key.

Files are written to a name of their own for each attempt of a task; the manifest names those that count.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickharbor.llm.encoding import encoder
from tickharbor.llm.perfect_hash import PerfectHash, fingerprint
from tickharbor.llm.tables import tasks_of
from tickharbor.session import stored, work_folder

VERSION = 1
MANIFEST = "shard int, path string, n_rows long, n_tokens long, low_key long, high_key long"
# Ids that a reader holds at once while it goes through a shard.
READ_IDS = 1 << 20


def _files(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        pyarrow.fs.LocalFileSystem(), path)


def _write_index(file, width: int, keys: np.ndarray, nulls: np.ndarray, ends: np.ndarray) -> None:
    rows = np.flatnonzero(nulls == 0)
    unique, first, count = np.unique(keys[rows], return_index=True, return_counts=True)
    hashed = PerfectHash.build(unique)
    order = np.argsort(hashed.places(unique))
    file.write(np.array([VERSION, width, len(keys), len(unique)], dtype="<i8").tobytes())
    file.write(keys.astype("<i8").tobytes() + nulls.astype("u1").tobytes() + ends.astype("<i8").tobytes())
    hashed.write(file)
    file.write(fingerprint(unique)[order].astype("<u4").tobytes())
    file.write(rows[first][order].astype("<u4").tobytes() + count[order].astype("<u4").tobytes())


class Shard:
    """One shard, opened for reading."""

    def __init__(self, path: str):
        self.files, self.path = _files(path)
        with self.files.open_input_file(self.path + ".idx") as file:
            data = memoryview(file.read())
        version, self.width, rows, keys = np.frombuffer(data, "<i8", 4).tolist()
        if version != VERSION:
            raise ValueError(f"{path}: version {version} of the index is unknown")
        self.keys = np.frombuffer(data, "<i8", rows, 32)
        self.nulls = np.frombuffer(data, "u1", rows, 32 + 8 * rows)
        self.ends = np.frombuffer(data, "<i8", rows, 32 + 9 * rows)
        self.hash, size = PerfectHash.read(data[32 + 17 * rows:])
        at = 32 + 17 * rows + size
        self.prints, self.first, self.count = (np.frombuffer(data, "<u4", keys, at + 4 * keys * k) for k in range(3))

    def rows_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of each key; no rows for a key whose fingerprint is not the stored one."""
        place = self.hash.places(keys)
        known = place >= 0
        known[known] = self.prints[place[known]] == fingerprint(keys[known])
        first, count = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        first[known], count[known] = self.first[place[known]], self.count[place[known]]
        return first, count

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids between two places of the shard."""
        with self.files.open_input_file(self.path + ".ids") as file:
            file.seek(first * self.width)
            raw = file.read((last - first) * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of every document with this key."""
        first, count = (int(x[0]) for x in self.rows_of(np.array([key], dtype=np.int64)))
        ends = self.ends
        return [self.ids(int(ends[r - 1]) if r else 0, int(ends[r])) for r in range(first, first + count)]


def _writer(vocabulary: str, end_id: int, folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tool = encoder(vocabulary)
        width = 2 if max(tool.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        path = f"{folder.rstrip('/')}/shard-{part:06d}-{uuid.uuid4().hex}"
        files, place = _files(path)
        files.create_dir(place.rpartition("/")[0], recursive=True)
        keys, nulls, sizes = [], [], []
        with files.open_output_stream(place + ".ids") as out:
            for batch in batches:
                ids = batch.column("doc_id")
                nulls.append(ids.is_null().to_numpy(zero_copy_only=False))
                keys.append(ids.fill_null(0).to_numpy())
                for one in tool.encode(batch.column("text"), end_id):
                    sizes.append(len(one))
                    out.write(one.astype(f"<u{width}").tobytes())
        if not sizes:
            return
        keys, nulls = np.concatenate(keys), np.concatenate(nulls)
        ends = np.cumsum(np.array(sizes, dtype=np.int64))
        with files.open_output_stream(place + ".idx") as out:
            _write_index(out, width, keys, nulls, ends)
        known = keys[~nulls]
        low, high = (int(known[0]), int(known[-1])) if len(known) else (None, None)
        yield pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([path]), pa.array([len(keys)], pa.int64()),
            pa.array([int(ends[-1])], pa.int64()), pa.array([low], pa.int64()), pa.array([high], pa.int64())],
            names=["shard", "path", "n_rows", "n_tokens", "low_key", "high_key"])

    return write


def write_token_files(documents: DataFrame, vocabulary: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the ids of all documents in ascending ``doc_id`` and return the manifest, one row for each shard.

    A null text is empty: it has the end id alone. Rows without ``doc_id`` come first and are not in the
    index; rows that repeat a ``doc_id`` follow each other by a hash of their text, and the key finds all of
    them. Texts move once, in ranges of ``doc_id``; a task encodes a range as a stream into its shard.
    ``folder`` is one that all executors reach; the session's checkpoint folder by default.
    """
    spark = documents.sparkSession
    folder = folder or work_folder(spark, "token-files")
    docs = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .repartitionByRange(tasks_of(spark), "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text")))
    return stored(docs.mapInArrow(_writer(vocabulary, end_id, folder), MANIFEST), "token-manifest")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
            shard = Shard(path)
            first, count = shard.rows_of(shard.keys)
            row = np.arange(len(shard.keys))
            lost = (shard.nulls == 0) & ((row < first) | (row >= first + count))
            if lost.any():
                raise ValueError(f"{path}: the index does not find {int(lost.sum())} rows")
            begins = np.concatenate([[0], shard.ends[:-1]])
            a = 0
            while a < len(row):
                b = max(a + 1, int(np.searchsorted(shard.ends, begins[a] + READ_IDS)))
                ids = shard.ids(int(begins[a]), int(shard.ends[b - 1]))
                cuts = (begins[a:b] - begins[a]).tolist(), (shard.ends[a:b] - begins[a]).tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array(shard.keys[a:b], pa.int64(), mask=shard.nulls[a:b] == 1),
                    pa.array(base + begins[a:b], pa.int64()), pa.array(shard.ends[a:b] - begins[a:b], pa.int64()),
                    pa.array([zlib.crc32(ids[i:j]) for i, j in zip(*cuts)], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
                a = b


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files, found through the index.

    ``start`` counts the ids of all shards before. A task reads one shard, a bounded piece at a time.
    """
    base = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row for each shard.
    shards = manifest.withColumn("base", base).repartitionById(tasks_of(manifest.sparkSession), F.col("shard"))
    return shards.select("path", "base").mapInArrow(
        _reader, "doc_id long, start long, n_tokens long, ids_crc32 long")
