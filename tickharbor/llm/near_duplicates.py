"""Near-duplicate documents: many universal hash minima, banding, verification, components.

Documents are sets of five-word shingles. Equal sets are folded into one class first. Each class has
128 minima of universal hash functions; classes that agree on all four minima of one of 32 bands are
candidates. Candidates are compared by signature, then exactly on their full texts. A band bucket is
never expanded into pairs: its members are first compared with its least member only, and components
are built; only buckets that then still hold several components are compared further, block by block
within tasks, and only across components. Joins are merges at every size, so plans grow with the input.

At a similarity of 0.75 a pair shares no band with probability (1 - 0.75**4)**32 = 5e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickharbor.llm.components import components
from tickharbor.llm.textbytes import column_bytes, mix, row_blocks, word_hashes
from tickharbor.session import stored

WORDS = 5
PERCENT = 75
BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
# A pair at the threshold has an estimate below this with probability 1e-7 (five standard deviations).
LEAST_ESTIMATE = 0.55
# Members of a block of a bucket, and their shingles; a task compares two blocks at once.
BLOCK_MEMBERS, BLOCK_SHINGLES = 2048, 1 << 21

_RANDOM = np.random.default_rng(9)
_FACTOR = _RANDOM.integers(0, 1 << 31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _RANDOM.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
_PLACE = _RANDOM.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = _RANDOM.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RANDOM.integers(0, 1 << 63, BANDS, dtype=np.uint64)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than five make one shingle."""
    data, offsets = column_bytes(column)
    for first, last in row_blocks(offsets):
        own = offsets[first:last + 1] - offsets[first]
        words, firsts = word_hashes(data[offsets[first]:offsets[last]], own)
        rows = len(words) - WORDS + 1
        runs = np.zeros(max(rows, 0), dtype=np.uint64)
        if rows > 0:
            for k in range(WORDS):
                runs += words[k:k + rows] * _PLACE[k]
            runs = mix(runs)
        for a, b in zip(firsts[:-1], firsts[1:]):
            if b - a >= WORDS:
                yield np.unique(runs[a:b - WORDS + 1])
            elif b > a:
                short = (words[a:b] * _PLACE[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                yield mix(np.array([short], dtype=np.uint64))
            else:
                yield words[:0]


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set."""
    least = np.full(MINIMA, 0xFFFFFFFF, dtype=np.uint32)
    halves = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(halves), 1024):
        np.minimum(least, (halves[i:i + 1024, None] * _FACTOR + _SHIFT).min(axis=0), out=least)
    return least


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, marks, bands = [], [], [], []
        for shingles in shingle_sets(batch.column("text")):
            sizes.append(len(shingles))
            if not len(shingles):
                digests.append(None)
                marks.append(None)
                bands.append(None)
                continue
            least = minima(shingles)
            digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            marks.append((least >> np.uint32(16)).astype(np.uint16).tobytes())
            keys = mix((least.reshape(BANDS, ROWS).astype(np.uint64) * _FOLD).sum(axis=1, dtype=np.uint64) + _BAND)
            bands.append(keys.view(np.int64))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id").cast(pa.int64()), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
            pa.array(marks, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "text_hash", "n_shingles", "digest", "signature", "bands"])


def _texts_of(documents: DataFrame) -> DataFrame:
    """``doc_id, text_hash, text``: the hash tells the texts of a repeated id apart."""
    whole = F.coalesce("text", F.lit(""))
    return documents.select("doc_id", F.xxhash64(whole).alias("text_hash"), whole.alias("text"))


def signatures(documents: DataFrame) -> DataFrame:
    """Size, digest, minima (upper halves) and band keys of each document's shingle set."""
    return _texts_of(documents).mapInArrow(
        _signatures, "doc_id long, text_hash long, n_shingles long, digest binary, signature binary, bands array<long>")


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, MINIMA)
                for c in ("mark_a", "mark_b"))
        keep = (a == b).mean(axis=1) >= LEAST_ESTIMATE
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose signatures agree often enough."""
    for side in ("a", "b"):
        marks = classes.select(F.col("node").alias(side), F.col("signature").alias(f"mark_{side}"))
        pairs = pairs.join(marks.hint("merge"), side)
    return pairs.select("a", "b", "mark_a", "mark_b").mapInArrow(_estimated, "a long, b long")


def _is_link(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both)


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(shingle_sets(batch.column("text_a")), shingle_sets(batch.column("text_b"))):
            keep.append(_is_link(x, y))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _texts(documents: DataFrame, wanted: DataFrame, classes: DataFrame) -> DataFrame:
    """A text of each wanted ``node``, stored; the others move once and are left behind."""
    owners = classes.select("node", "doc_id", "text_hash").join(wanted.hint("merge"), "node", "left_semi")
    texts = _texts_of(documents).join(owners.hint("merge"), ["doc_id", "text_hash"])
    return stored(texts.select("node", "text").dropDuplicates(["node"]), "candidate-texts")


def _verified(pairs: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """The pairs that are links, from the full texts of both."""
    texts = _texts(documents, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), classes)
    for side in ("a", "b"):
        own = texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}"))
        pairs = pairs.join(own.hint("merge"), side)
    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(_alike, "a long, b long")


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join components of a cell, each pair compared in the first band that it shares."""
    table = pa.Table.from_batches(list(batches))
    ids, labels, own = (table.column(c).to_numpy().copy() for c in ("node", "component", "own"))
    bucket, one_block = table.column("bucket")[0].as_py(), len(np.unique(own)) == 1
    marks = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint16).reshape(-1, MINIMA)
    bands = np.array(table.column("bands").to_pylist(), dtype=np.int64)
    sets: dict[int, np.ndarray] = {}
    texts = table.column("text")

    def shingles(k: int) -> np.ndarray:
        if k not in sets:
            sets[k] = next(shingle_sets(texts.slice(k, 1)))
        return sets[k]

    found = []
    for x in range(len(ids)):
        other = np.flatnonzero(labels[x + 1:] != labels[x]) + x + 1
        if not one_block:
            other = other[own[other] != own[x]]
        other = other[(marks[other] == marks[x]).mean(axis=1) >= LEAST_ESTIMATE]
        other = other[bands[other, (bands[other] == bands[x]).argmax(axis=1)] == bucket]
        for y in other.tolist():
            if labels[x] != labels[y] and _is_link(shingles(x), shingles(y)):
                found.append((ids[x], ids[y]))
                labels[labels == labels[y]] = labels[x]
    if found:
        a, b = np.array(found, dtype=np.int64).T
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _remaining(buckets: DataFrame, labels: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """Links across components within buckets that still hold several components.

    Members of a bucket are dealt into blocks; a cell of two blocks is compared in one task, which gives
    the links that join its components, so a cell never gives more rows than it has.
    """
    sized = buckets.join(classes.select("node", "n_shingles").hint("merge"), "node")
    named = (sized.join(labels, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    mixed = (named.groupBy("bucket").agg(
        F.count("*").alias("members"), F.sum("n_shingles").alias("shingles"), F.min("component").alias("low"),
        F.max("component").alias("high"))
        .where("members > 2 AND low < high").select("bucket", F.ceil(F.greatest(
            F.col("members") / BLOCK_MEMBERS, F.col("shingles") / BLOCK_SHINGLES)).alias("blocks")))
    left = stored(named.join(mixed.hint("merge"), "bucket"), "mixed-buckets")
    texts = _texts(documents, left.select("node").distinct(), classes)
    cells = (left.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                     "node", "component")
             .join(classes.select("node", "signature", "bands").hint("merge"), "node")
             .join(texts.hint("merge"), "node"))
    return cells.groupBy("bucket", "i", "j").applyInArrow(_across, "a long, b long").distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``documents(doc_id, text)``.

    Words are runs without ASCII white space, with A-Z in lower case. Two documents are linked if
    100 * intersection >= 75 * union of their sets; a component is named by its least ``doc_id``, whose
    row is kept. A null or empty text has an empty set and no link. Rows that repeat a ``doc_id`` belong
    to one component. A row without ``doc_id`` is linked with nothing: its component is null and it is
    kept. Other columns are ignored; an empty table gives no rows.
    """
    sets = stored(signatures(documents), "signatures")
    known = sets.where("doc_id IS NOT NULL AND n_shingles > 0")
    heads = known.groupBy("digest").agg(F.min("doc_id").alias("head"))
    members = stored(known.select("doc_id", "digest").join(heads, "digest").select("doc_id", "digest", "head"), "classes")
    # A class of equal sets is a node. Its least document stands for it, which may stand for several: a repeated id has several texts.
    leads = members.where("doc_id = head").select("doc_id", "digest").distinct()
    classes = known.join(leads.hint("merge"), ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id", "digest"])
    # Numbers given as the table is written stay as they are from then on.
    classes = stored(classes.select(
        F.monotonically_increasing_id().alias("node"), "doc_id", "text_hash", "n_shingles", "signature", "bands"), "class-signatures")
    placed = classes.select("node", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead < last")
    buckets = stored(placed.join(shared.select("bucket", "lead").hint("merge"), "bucket"), "buckets")
    stars = buckets.where("node > lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(_verified(stored(_plausible(stars, classes), "star-pairs"), classes, documents), "star-links")
    labels = stored(components(links.select(F.col("b").alias("u"), F.col("a").alias("v"))), "star-components")
    more = stored(_remaining(buckets.select("bucket", "node"), labels, classes, documents), "rest-links")
    edges = links.unionByName(more)
    for node, end in (("b", "u"), ("a", "v")):
        edges = edges.join(classes.select(F.col("node").alias(node), F.col("doc_id").alias(end)).hint("merge"), node)
    edges = edges.select("u", "v")
    # The same doc_id with several texts is one document.
    edges = edges.unionByName(members.where("doc_id > head").select(F.col("doc_id").alias("u"), F.col("head").alias("v")))
    final = components(edges).withColumnRenamed("node", "doc_id")
    return (sets.select("doc_id", "n_shingles").join(final, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
