"""Document fingerprints from content-defined chunks.

A text's UTF-8 bytes are cut where a gear hash of the last 16 bytes meets a mask. The chunk size is
normalised: below the normal size a hard mask must be met, above it an easy one, so sizes gather around
the normal one; no chunk is shorter than the minimum (but the last) or longer than the maximum. Cuts
depend on nearby bytes only, so an insertion changes the chunks around it and no others. A fingerprint
is the set of chunk digests with their lengths; likeness is the share of one document's distinct chunks,
by length, that another document has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickharbor.llm.tables import tasks_of
from tickharbor.llm.textbytes import SpanHash, column_bytes, row_blocks

LEAST, NORMAL, MOST = 16, 32, 128
_HARD, _EASY = np.uint16(0xFC00), np.uint16(0xF000)
_GEAR = np.random.default_rng(16).integers(0, 1 << 16, 256, dtype=np.uint16)
_ENTRY = np.dtype([("digest", ">u8"), ("length", "u1")])

Print = tuple[np.ndarray, np.ndarray]
NOTHING: Print = (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))


def gear(data: np.ndarray) -> np.ndarray:
    """At each byte the 16-bit gear hash, to which the last 16 bytes contribute."""
    value = _GEAR[data]
    for step in (1, 2, 4, 8):
        longer = value.copy()
        longer[step:] += value[:-step] << np.uint16(step)
        value = longer
    return value


def cut(size: int, places: list[int], hard: list[bool]) -> list[int]:
    """Ends of the chunks of a text, given the ends that meet the easy mask and whether they meet the hard one."""
    ends, start = [], 0
    for place, is_hard in zip(places, hard):
        while place - start > MOST:
            start += MOST
            ends.append(start)
        length = place - start
        if length >= NORMAL or (is_hard and length >= LEAST):
            ends.append(place)
            start = place
    while size - start > MOST:
        start += MOST
        ends.append(start)
    if size > start:
        ends.append(size)
    return ends


def fingerprints(column: pa.Array) -> Iterator[Print]:
    """Sorted distinct chunk digests and their lengths, for each text."""
    data, offsets = column_bytes(column)
    for first, last in row_blocks(offsets):
        block = data[offsets[first]:offsets[last]]
        own = offsets[first:last + 1] - offsets[first]
        value = gear(block)
        marks = np.flatnonzero((value & _EASY) == 0)
        hard = ((value[marks] & _HARD) == 0).tolist()
        bounds = np.searchsorted(marks, own)
        places = (marks + 1).tolist()
        ends, counts = [], []
        for row in range(last - first):
            base, a, b = int(own[row]), bounds[row], bounds[row + 1]
            found = cut(int(own[row + 1]) - base, [p - base for p in places[a:b]], hard[a:b])
            ends += [base + e for e in found]
            counts.append(len(found))
        stops = np.array(ends, dtype=np.int64)
        rows = np.concatenate([[0], np.cumsum(counts)])
        starts = np.empty_like(stops)
        starts[1:] = stops[:-1]
        starts[rows[:-1][np.diff(rows) > 0]] = own[:-1][np.diff(rows) > 0]
        digests = SpanHash(block).of(starts, stops)
        sizes = stops - starts
        for a, b in zip(rows[:-1], rows[1:]):
            unique, where = np.unique(digests[a:b], return_index=True)
            yield unique, sizes[a:b][where]


def written(print_: Print) -> str:
    """Text form: 16 hex digits of digest and 2 of length for each chunk, in order of digest."""
    entries = np.empty(len(print_[0]), dtype=_ENTRY)
    entries["digest"], entries["length"] = print_
    return entries.tobytes().hex()


def parsed(text: str) -> Print:
    entries = np.frombuffer(bytes.fromhex(text), dtype=_ENTRY)
    return entries["digest"].astype(np.uint64), entries["length"].astype(np.int64)


def likeness(of: Print, within: Print) -> float:
    """Share of a document's distinct chunks, weighted by length, that the other one has; two empty ones are alike."""
    if not len(of[0]) or not len(within[0]):
        return float(len(of[0]) == len(within[0]))
    at = np.minimum(np.searchsorted(within[0], of[0]), len(within[0]) - 1)
    shared = (within[0][at] == of[0]) & (within[1][at] == of[1])
    return float(of[1][shared].sum() / of[1].sum())


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.select(["doc_id"]).append_column(
            "fingerprint", pa.array([written(x) for x in fingerprints(batch.column("text"))], pa.string()))


def document_fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` for every row; a null text counts as empty, whose fingerprint is ''."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .mapInArrow(_fingerprint_rows, "doc_id long, fingerprint string")


def _buckets_of(ends: list[int]):
    """Bucket of each id; the last id of a bucket also goes to the next bucket, the very last to the first."""
    limits = np.array(ends, dtype=np.int64)

    def buckets(ids: pa.Array) -> pa.Array:
        places = []
        for value, place in zip(ids.to_pylist(), np.searchsorted(limits, ids.fill_null(0).to_numpy(zero_copy_only=False))):
            if value is None:
                places.append([])
            elif value == limits[place]:
                places.append([int(place), (int(place) + 1) % len(limits)])
            else:
                places.append([int(place)])
        return pa.array(places, pa.list_(pa.int32()))

    return F.arrow_udf(buckets, "array<int>")


def _edited_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before, before_print = "", NOTHING
    for batch in batches:
        _, offsets = column_bytes(batch.column("text"))
        for first, last in row_blocks(offsets):
            part = batch.slice(first, last - first)
            ids, carried, texts = (part.column(c).to_pylist() for c in ("doc_id", "carried", "text"))
            edited, order = [], []
            for doc_id, text in zip(ids, texts):
                half = len(text) // 2
                edited.append(text[:len(text) - half] + (before[:half] if doc_id is not None else ""))
                if doc_id is not None:
                    before = text
            prints = list(fingerprints(part.column("text")))
            edited_prints = list(fingerprints(pa.array(edited, pa.string())))
            rows = []
            for k, doc_id in enumerate(ids):
                if not carried[k]:
                    follower = before_print if doc_id is not None else NOTHING
                    rows.append((
                        doc_id, len(texts[k]), hashlib.sha256(edited[k].encode()).hexdigest(), written(prints[k]),
                        written(edited_prints[k]), likeness(prints[k], edited_prints[k]), likeness(prints[k], follower)))
                if doc_id is not None:
                    before_print = prints[k]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(zip(*rows), (
                        pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                           "near_next"])


def edited_fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are.

    The next document is that with the next smaller ``doc_id``, after the last the first; rows that repeat
    a ``doc_id`` follow each other by a hash of their text. The edited text ends with the beginning of the
    next one instead of its own second half. A null text is empty. A row without ``doc_id`` stands outside
    the order: its next document is the empty text. Other columns are ignored; an empty table gives no rows.

    Ids alone are ranged first; the last id of every range tells which rows the next range needs too. Then
    each text moves once, to its range, where rows are sorted and read as a stream.
    """
    spark = documents.sparkSession
    parts = tasks_of(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = (docs.select("doc_id").where("doc_id IS NOT NULL").repartitionByRange(parts, "doc_id")
              .groupBy(F.spark_partition_id().alias("part")).agg(F.max("doc_id").alias("last")))
    # One number for each shuffle partition.
    ends = sorted(row["last"] for row in ranges.collect()) or [0]
    placed = docs.withColumn("bucket", F.when(
        F.col("doc_id").isNull(), F.array(F.pmod(F.xxhash64("text"), F.lit(len(ends))).cast("int")))
        .otherwise(_buckets_of(ends)("doc_id")))
    moved = (placed.select("doc_id", "text", F.posexplode("bucket").alias("copy", "bucket"))
             .select("doc_id", "text", "bucket", (F.col("copy") > 0).alias("carried"))
             .repartitionById(len(ends), F.col("bucket"))
             .sortWithinPartitions(F.desc("carried"), "doc_id", F.xxhash64("text")))
    return moved.select("doc_id", "carried", "text").mapInArrow(
        _edited_rows, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                      "edited_fingerprint string, near_edited double, near_next double")
