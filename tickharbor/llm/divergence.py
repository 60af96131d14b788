"""How the sources of a language differ: exact term vectors of documents, sums by group, sparse pairs of groups.

Documents become sparse vectors of exact counts, as a count vectorizer per language makes them with a least
document frequency and no bound on its vocabulary. Spark's own keeps that vocabulary on the driver and sends it to every
task; here it is a table. Tasks add the vectors of their documents by source and language, together with
the numbers of documents, and hand on bounded pieces of the sums; these are added by term, where the
language's document frequency decides which terms stay.

Two groups are compared on the terms that both have. The rest of the sum over the vocabulary
depends on one group's counts and the other's total alone, and comes from the counts of counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickharbor.session import ship, stored

MIN_DOCUMENTS = 3
TERM_RANKS = 200
SCALE = 1_000_000_000
# Entries of the sums that a task holds before it hands them on, and rows of a batch.
SUM_ENTRIES, BATCH_ROWS = 1 << 19, 1 << 16
# Sources of a tile, rows of a cell and pairs of rows that a task compares at once.
TILE_SOURCES, CELL_ROWS, PAIRS = 256, 1 << 18, 1 << 20

# Letters and all bytes of characters beyond ASCII stay, A-Z in lower case; every other byte ends a term.
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_SUMS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("documents", pa.int64())])


def vector(text: str) -> Counter:
    """The terms of a text and how often each occurs."""
    return Counter(text.encode().translate(_LETTERS).split())


def _group_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the vectors of each group, and documents with each term, as far as one task has them."""
    groups: dict[tuple[str, str], tuple[dict[bytes, int], Counter]] = {}
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (sums, documents) in groups.items():
            terms = list(sums)
            for i in range(0, len(terms), BATCH_ROWS):
                part = terms[i:i + BATCH_ROWS]
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(lang, len(part)), pa.repeat(source, len(part)), pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array([sums[t] for t in part]), pa.array([documents[t] for t in part])], schema=_SUMS)

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            sums, documents = groups.setdefault((lang, source), ({}, Counter()))
            before = len(sums)
            own = vector(text)
            for term, n in own.items():
                sums[term] = sums.get(term, 0) + n
            documents.update(own.keys())
            held += len(sums) - before
            if held >= SUM_ENTRIES:
                yield from rows()
                groups, held = {}, 0
    yield from rows()


def group_terms(documents: DataFrame) -> DataFrame:
    """``lang, source, term, n, total``: occurrences of each kept term in each group and in its language; stored.

    ``documents`` has ``lang``, ``source`` and ``text`` without nulls.
    """
    pieces = documents.mapInArrow(_group_sums, "lang string, source string, term string, n long, documents long")
    # One shuffle: the groups of a term, and all that have it, are added where the term is.
    sums = pieces.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    term = Window.partitionBy("lang", "term")
    counted = sums.select("lang", "source", "term", "n", F.sum("n").over(term).alias("total"), F.sum("documents").over(term).alias("documents"))
    return stored(counted.where(F.col("documents") >= MIN_DOCUMENTS).drop("documents"), "group-terms")


def share(count: Column, total: Column) -> Column:
    """1 + floor(10**9 * (count + 1) / total), exactly; 1 where there is no vocabulary."""
    return F.when(total == 0, F.lit(1).cast("long")).otherwise(
        1 + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"), total.cast("decimal(20,0)")))


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _added(place: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers by place, modulo 2**64: thirds of 21 or 22 bits are exact as doubles."""
    total = np.zeros(size, dtype=np.int64)
    for shift, mask in ((0, 0x1FFFFF), (21, 0x1FFFFF), (42, None)):
        part = values >> shift
        total += np.bincount(place, part if mask is None else part & mask, size).astype(np.int64) << shift
    return total


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The part of the pair values that one cell's terms give, modulo 2**64."""
    table = pa.Table.from_batches(list(batches))
    sources = table.column("source").combine_chunks().dictionary_encode()
    names, own = sources.dictionary, sources.indices.to_numpy()
    ids, check, p, p0, tile = (table.column(c).to_numpy() for c in ("id", "check", "p", "p0", "tile"))
    size, one_tile = len(names), table.column("i")[0] == table.column("j")[0]
    lows, tiles, vocabulary = (np.zeros(size, dtype=np.int64) for _ in range(3))
    lows[own], tiles[own], vocabulary[own] = p0, tile, table.column("vocabulary").to_numpy()
    real = np.flatnonzero(table.column("real").to_numpy(zero_copy_only=False))
    real = real[np.lexsort((check[real], ids[real]))]
    ids, check, p, own = ids[real], check[real], p[real], own[real]
    constant = _f(lows[:, None], lows[None, :])
    # Terms that at least one side lacks: from how often each count occurs.
    members = np.bincount(own, minlength=size)
    value = -(members[:, None] + members[None, :]) * constant
    for a in range(size):
        level, times = np.unique(p[own == a], return_counts=True)
        for i in range(0, len(level), 4096):
            some, n = level[i:i + 4096, None], times[i:i + 4096]
            value[a, :] += n @ _f(some, lows[None, :])
            value[:, a] += n @ _f(lows[None, :], some)
    if table.column("slice")[0].as_py() == 0:
        value += vocabulary[:, None] * constant
    # Terms that both sides have.
    first = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (check[1:] != check[:-1])]) if len(ids) else np.empty(0, dtype=np.int64)
    many = np.diff(np.r_[first, len(ids)])
    until = np.cumsum(many * many)
    start = 0
    while start < len(first):
        stop = max(start + 1, int(np.searchsorted(until, (until[start - 1] if start else 0) + PAIRS, side="right")))
        k = np.repeat(many[start:stop], many[start:stop])
        head = np.repeat(first[start:stop], many[start:stop])
        left = np.repeat(np.arange(first[start], first[start] + len(k)), k)
        right = np.arange(len(left)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(head, k)
        start = stop
        apart = tiles[own[left]] != tiles[own[right]] if not one_tile else left != right
        left, right = left[apart], right[apart]
        x, y = own[left], own[right]
        both = _f(p[left], p[right]) - _f(p[left], lows[y]) - _f(lows[x], p[right]) + constant[x, y]
        value += _added(x * size + y, both, size * size).reshape(size, size)
    x, y = np.nonzero(tiles[:, None] != tiles[None, :] if not one_tile else ~np.eye(size, dtype=bool))
    if len(x):
        yield pa.RecordBatch.from_arrays([
            pa.repeat(table.column("lang")[0], len(x)), names.take(pa.array(x)), names.take(pa.array(y)),
            pa.array(value[x, y])], names=["lang", "source", "item", "value"])


def pair_values(scored: DataFrame, groups: DataFrame, tile_sources: int = TILE_SOURCES, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``lang, source, item, value`` for every ordered pair of sources of a language.

    Sources are dealt into tiles and terms into slices; a cell holds a slice of the terms of two tiles. Terms are
    known there by hashes of 96 bits. Every cell has a row of its own for each source of its tiles.
    """
    shape = groups.groupBy("lang").agg(
        F.ceil(F.count("*") / tile_sources).alias("tiles"),
        (F.floor(F.sum("terms") / cell_rows) + 1).alias("slices"))
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).alias("tile")
    rows = scored.join(shape, "lang").select(
        "lang", "source", F.lit(True).alias("real"), F.xxhash64("term").alias("id"), F.hash("term").alias("check"), "p", "p0", "vocabulary",
        tile, "tiles", F.pmod(F.xxhash64("term"), F.col("slices")).alias("slice"))
    every = groups.join(shape, "lang").select(
        "lang", "source", F.lit(False).alias("real"), F.lit(0).cast("long").alias("id"), F.lit(0).alias("check"), F.col("p0").alias("p"), "p0",
        "vocabulary", tile, "tiles", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    cells = rows.unionByName(every).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    parts = (cells.select("lang", "slice", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
                          "tile", "source", "real", "id", "check", "p", "p0", "vocabulary")
             .groupBy("lang", "slice", "i", "j").applyInArrow(_compared, "lang string, source string, item string, value long"))
    total = F.sum(F.col("value").cast("decimal(38,0)"))
    return parts.groupBy("lang", "source", "item").agg(F.pmod(total, F.lit(str(2**64)).cast("decimal(38,0)")).cast("long").alias("value"))


def source_divergence(documents: DataFrame, tile_sources: int = TILE_SOURCES, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``lang, source, part, item, value, rank``: how the sources of each language differ, by pair and by term.

    ``documents`` has ``text``, ``lang`` and ``source``; nulls are empty texts and names, other columns are
    ignored, and repeated rows count as often as they occur. A term that at least three documents of its
    language have is kept. Every group appears in part ``pair`` if its language has another source, also
    without terms, with value 0 where the language has none. Ties are ordered by item. A very long text is one
    vector like any other. An empty table gives no rows. Counts may reach 9e9 times a billion: shares are decimals.
    """
    spark = documents.sparkSession
    ship(spark)
    texts = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = group_terms(texts)
    totals = counted.groupBy("lang", "term").agg(F.first("total").alias("total"))
    languages = totals.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("total").alias("lang_terms"))
    own = counted.groupBy("lang", "source").agg(F.sum("n").alias("occurrences"), F.count("*").alias("terms"))
    groups = (texts.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(languages, "lang", "left")
              .na.fill(0, ["occurrences", "terms", "vocabulary", "lang_terms"])
              .withColumn("p0", share(F.lit(0), F.col("occurrences") + F.col("vocabulary"))))
    groups = stored(groups, "source-groups")
    scored = (counted.join(groups.drop("terms"), ["lang", "source"])
              .withColumn("p", share(F.col("n"), F.col("occurrences") + F.col("vocabulary"))))
    p, q = F.col("p"), F.col("q")
    value = F.call_function("div", (p - q) * (p - q), q)
    by_term = (scored.withColumn("q", share(F.col("total"), F.col("lang_terms") + F.col("vocabulary")))
               .where(p > q).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value")))
    by_pair = pair_values(scored, groups, tile_sources, cell_rows).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    return by_pair.select("*", rank).unionByName(by_term.select("*", rank).where(F.col("rank") <= TERM_RANKS))
