"""Exact repeats of 100 bytes and more across all documents, by enhanced suffix arrays of sampled suffixes.

Suffixes are sampled by content: of the 32-byte strings in every 100 bytes the one with the least hash is an
anchor, the first of equal ones. Two equal strings of 100 bytes have the same anchor at the same place, so
only suffixes at anchors that occur twice matter. An anchor's context is what one string of 100 bytes with
it can reach: 68 bytes before it and 100 from it on.

Occurrences with the same context form a class, found by hash; all but its first occurrence repeat the whole
context. Where an anchor has several classes, their contexts make an enhanced suffix array: sorted suffixes
with the lengths of common prefixes. A stack scan gives its interval tree; within each interval the left
contexts are scanned in the same way, and where they branch stands a maximal repeat, with all occurrences:
it can be extended neither to the right nor to the left. All occurrences but the first are marked. An
anchor with more classes than a task should hold goes another exact way: its strings of 100 bytes are
counted by themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickharbor.llm.tables import drop_shuffles
from tickharbor.llm.textbytes import SpanHash, column_bytes, mix, row_blocks
from tickharbor.session import stored

LENGTH = 100
ANCHOR = 32
BEFORE = LENGTH - ANCHOR
# Contexts of one anchor that a task compares at once.
GROUP_LIMIT = 10_000

# Bytes of a block, small enough for its arrays to stay in a core's cache.
BLOCK = 1 << 17

_PLACE_BITS = np.uint64(28)
_PLACE = np.uint64((1 << 28) - 1)
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
_LEFT = np.uint64(0xC2B2AE3D27D4EB4F)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in the block, hash and context hash of the anchors of a block of texts."""
    none = np.empty(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    spans = SpanHash(data)
    hashes = spans.windows(ANCHOR)
    least = (hashes >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while size * 2 <= BEFORE + 1:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = BEFORE + 1 - size
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    # least[i] belongs to the string of LENGTH bytes from i on; strings that leave their row do not count.
    tails = offsets[1:, None] - np.arange(1, LENGTH)
    tails = tails[(tails >= offsets[:-1, None]) & (tails < len(least))]
    inside = np.ones(len(least), dtype=bool)
    inside[tails] = False
    least = least[inside]
    chosen = np.zeros(len(data), dtype=bool)
    chosen[(least & _PLACE).astype(np.int64)] = True
    place = np.flatnonzero(chosen)
    row = np.searchsorted(offsets, place, side="right") - 1
    first, last = np.maximum(offsets[row], place - BEFORE), np.minimum(offsets[row + 1], place + LENGTH)
    context = mix(spans.of(first, last) + (place - first).astype(np.uint64) * _LEFT)
    return row, place, hashes[place], context


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = column_bytes(batch.column("text"))
        docs, keys = batch.column("doc").to_numpy(), batch.column("text_key").to_numpy()
        for first, last in row_blocks(offsets, BLOCK):
            own = offsets[first:last + 1] - offsets[first]
            row, place, anchor, context = anchors(data[offsets[first]:offsets[last]], own)
            if len(row):
                tag = (keys[first + row] << 32) | (place - own[row])
                yield pa.RecordBatch.from_arrays([
                    pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), pa.array(docs[first + row]),
                    pa.array(tag)], names=["anchor", "context", "doc", "tag"])


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    size = min(len(a), len(b))
    differ = int.from_bytes(a[:size], "big") ^ int.from_bytes(b[:size], "big")
    return size - (differ.bit_length() + 7) // 8


def intervals(prefixes: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """The interval tree of a sorted array by a stack scan: (common prefix, first, last) of each node, last exclusive.

    ``prefixes[i]`` is the common prefix of entries i and i + 1; nodes below ``least`` are left out.
    """
    stack: list[tuple[int, int]] = []
    for at, length in enumerate([*prefixes, -1]):
        first = at
        while stack and stack[-1][0] > length:
            known, first = stack.pop()
            if known >= least:
                yield known, first, at + 1
        if length >= 0 and (not stack or stack[-1][0] < length):
            stack.append((length, first))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes before, bytes from the anchor on, occurrences) of each maximal repeat of ``length`` bytes or more.

    ``lefts`` are read backwards from the anchor. Each group has at least two different bytes, or an end of
    text, on either side.
    """
    array = sorted(range(len(rights)), key=rights.__getitem__)
    shared = [common(rights[a], rights[b]) for a, b in zip(array, array[1:])]
    rank = {k: r for r, k in enumerate(sorted(range(len(lefts)), key=lefts.__getitem__))}
    deepest = max(map(len, lefts), default=0)
    for after, first, last in intervals(shared, length - deepest):
        members = sorted(array[first:last], key=rank.__getitem__)
        behind = [common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        for before, low, high in intervals(behind, max(0, length - after)):
            yield before, after, members[low:high]


def _marked(group: list[tuple[int, int, bytes, bytes]]) -> Iterator[tuple[int, int, int, int]]:
    """(doc, tag, bytes before, bytes after) of the contexts that repeat an earlier one."""
    order = [(doc, tag) for doc, tag, _, _ in group]
    before, after = [0] * len(group), [0] * len(group)
    for left, right, members in maximal_repeats([g[2] for g in group], [g[3] for g in group]):
        first = min(members, key=order.__getitem__)
        for k in members:
            if k != first:
                before[k], after[k] = max(before[k], left), max(after[k], right)
    for k, (doc, tag) in enumerate(order):
        if after[k]:
            yield doc, tag, before[k], after[k]


_MARKS = "doc long, tag long, before int, after int"


def _mark_batch(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()),
         pa.array(columns[3], pa.int32())], names=["doc", "tag", "before", "after"])


def _mark_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor; a group may go on in the next batch."""
    group: list[tuple[int, int, bytes, bytes]] = []
    current, rows = None, []
    for batch in batches:
        for anchor, *member in zip(*(batch.column(c).to_pylist() for c in ("anchor", "doc", "tag", "left", "right"))):
            if anchor != current:
                rows += _marked(group)
                current, group = anchor, []
            group.append(tuple(member))
        if rows:
            yield _mark_batch(rows)
            rows = []
    rows += _marked(group)
    if rows:
        yield _mark_batch(rows)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes before each anchor, backwards, and from it on."""
    for batch in batches:
        out = []
        for text, doc, places in zip(*(batch.column(c).to_pylist() for c in ("text", "doc", "places"))):
            raw = text.encode()
            for p in places:
                at = p["tag"] & 0xFFFFFFFF
                out.append((p["anchor"], doc, p["tag"], raw[max(0, at - BEFORE):at][::-1], raw[at:at + LENGTH]))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             names=["anchor", "doc", "tag", "left", "right"])


def _by_strings(contexts: DataFrame) -> DataFrame:
    """Marks of anchors with very many contexts: each string of LENGTH bytes counted by itself."""
    strings = (contexts.withColumn("before", F.explode(F.sequence(F.lit(0), F.least(F.lit(BEFORE), F.octet_length("left")))))
               .withColumn("after", LENGTH - F.col("before")).where(F.octet_length("right") >= F.col("after"))
               .withColumn("string", F.concat(F.expr("substring(left, 1, before)"), F.lit(b"|"), F.expr("substring(right, 1, after)"))))
    firsts = strings.groupBy("string").agg(F.min(F.struct("doc", "tag")).alias("first"))
    return (strings.join(firsts, "string").where(F.struct("doc", "tag") > F.col("first"))
            .select("doc", "tag", F.col("before").cast("int"), F.col("after").cast("int")))


def _documents(documents: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    key = F.xxhash64(text)
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), key).alias("doc"), F.shiftrightunsigned(key, 33).alias("text_key"))


def repeated_spans(documents: DataFrame) -> DataFrame:
    """``doc, text_key, spans``: the parts of each document that repeat what starts earlier, as (begin, end) of anchors' reach.

    Spans may overlap and pass the ends of the text by up to LENGTH bytes; those that a text cuts below LENGTH
    bytes do not count.
    """
    drop_shuffles(documents.sparkSession)
    docs = _documents(documents)
    seen = docs.select("doc", "text_key", "text").mapInArrow(_occurrences, "anchor long, context long, doc long, tag long")
    often = seen.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1").select("anchor")
    repeated = stored(seen.join(often.hint("merge"), "anchor"), "repeated-anchors")
    classes = stored(repeated.groupBy("anchor", "context").agg(F.min(F.struct("doc", "tag")).alias("first"), F.count("*").alias("times"))
                     .select("anchor", "context", "first.doc", "first.tag", "times"), "anchor-contexts")
    later = stored(repeated.join(classes.where("times > 1").select("anchor", "context", F.col("doc").alias("first_doc"), F.col("tag").alias("first_tag"))
                           .hint("merge"), ["anchor", "context"])
                   .where("doc <> first_doc OR tag <> first_tag")
                   .select("doc", "tag", F.lit(BEFORE).alias("before"), F.lit(LENGTH).alias("after")), "later-marks")
    mixed = classes.groupBy("anchor").agg(F.count("*").alias("contexts")).where("contexts > 1")
    members = (classes.join(mixed.hint("merge"), "anchor")
               .withColumn("text_key", F.shiftright("tag", 32)))
    places = members.groupBy("doc", "text_key").agg(F.collect_list(F.struct("anchor", "tag", "contexts")).alias("places"))
    held = stored(docs.select("doc", "text_key", "text").join(places.hint("merge"), ["doc", "text_key"])
                  .dropDuplicates(["doc", "text_key"])
                  .select("doc", "text", "places").mapInArrow(
                      _contexts, "anchor long, doc long, tag long, left binary, right binary"), "contexts")
    large = mixed.where(F.col("contexts") > GROUP_LIMIT).select("anchor")
    few = held.join(large, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    # Each step is written by itself, so that the shuffles of one are gone before the next.
    marks = (later.unionByName(stored(few.mapInArrow(_mark_groups, _MARKS), "context-marks"))
             .unionByName(stored(_by_strings(held.join(large, "anchor", "left_semi")), "string-marks")))
    place = F.col("tag").bitwiseAND(0xFFFFFFFF)
    return stored(marks.groupBy("doc", F.shiftright("tag", 32).alias("text_key"))
                  .agg(F.collect_list(F.struct((place - F.col("before")).alias("begin"), (place + F.col("after")).alias("end"))).alias("spans")),
                  "repeat-spans")


def merged(begins: np.ndarray, ends: np.ndarray, size: int, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal runs that the spans cover within a text of ``size`` bytes."""
    begins, ends = np.maximum(begins, 0), np.minimum(ends, size)
    whole = ends - begins >= length
    order = np.argsort(begins[whole], kind="stable")
    begins, ends = begins[whole][order], np.maximum.accumulate(ends[whole][order])
    if not len(begins):
        return begins, ends
    fresh = np.append(True, begins[1:] > ends[:-1])
    return begins[fresh], ends[np.append(fresh[1:], True)]


_RUN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = column_bytes(batch.column("text"))
        raw, spans = memoryview(data), batch.column("spans")
        begins, ends = (spans.values.field(k).to_numpy() for k in range(2))
        bounds, missing = spans.offsets.to_numpy(), spans.is_null().to_numpy(zero_copy_only=False)
        sizes, gone, counts, digests, runs = np.diff(offsets), [], [], [], [[np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]]
        for row, base in enumerate(offsets[:-1].tolist()):
            own = slice(bounds[row], bounds[row] if missing[row] else bounds[row + 1])
            first, last = merged(begins[own], ends[own], int(sizes[row]))
            digest, at = hashlib.sha256(), base
            for begin, end in zip((first + base).tolist(), (last + base).tolist()):
                digest.update(raw[at:begin])
                at = end
            digest.update(raw[at:int(offsets[row + 1])])
            gone.append(int((last - first).sum()))
            counts.append(len(first))
            digests.append(digest.hexdigest())
            runs[0].append(first)
            runs[1].append(last)
        places = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        listed = pa.StructArray.from_arrays([pa.array(np.concatenate(r), pa.int64()) for r in runs], fields=list(_RUN))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(counts, pa.int64()),
            pa.array(digests, pa.string()), pa.ListArray.from_arrays(places, listed)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])


def without_repeats(documents: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed`` for each row of ``documents(doc_id, text)``.

    A byte is removed if a string of 100 bytes over it also starts earlier: in a smaller ``doc_id``, or in the
    same document before. ``removed`` has the maximal runs in bytes. A null text is empty; texts below 100 bytes
    lose nothing. Rows with the same ``doc_id`` and text are one document with equal results; different texts
    of one ``doc_id`` follow each other by hash; a row without ``doc_id`` is ordered by the hash of its text.
    Other columns are ignored; an empty table gives no rows.
    """
    docs, spans = _documents(documents), repeated_spans(documents)
    return docs.join(spans.hint("merge"), ["doc", "text_key"], "left").select("doc_id", "text", "spans").mapInArrow(
        _removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                  "removed array<struct<begin: long, end: long>>")
