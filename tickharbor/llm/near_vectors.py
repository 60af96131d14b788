"""Near-duplicate vectors by binary codes of a random rotation, with bounds that decide what is computed exactly.

A unit vector is rotated at random; the signs of its components are its code, and the inner product of the
rotated vector with the code, divided by the root of the width, is its stored correction factor. Code times another
rotated vector, over the factor, estimates their cosine without bias; the error at a cosine of the threshold has the
deviation of ``bound_of``. Only pairs whose estimate plus ``CONFIDENCE`` deviations reaches the
threshold are computed exactly. A pair at the threshold is missed with probability 3e-7, a closer one less often.

Dense groups are kept out of that work. Leaders, found in a bounded sample, have caps of half the
threshold's angle: any two members of a cap are linked, which needs no pair of them. Other vectors meet a cap only
if they lie within its radius and the threshold's angle together, and no link is longer. Vectors in no cap
are compared in pairs of blocks, each within one task that returns counts and a spanning forest, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickharbor.llm.components import components
from tickharbor.llm.vectors import blocks, matrix, packed, row_key, unpacked, width
from tickharbor.session import ship, stored

THRESHOLD = 0.9
# Deviations of an estimate that a pair may fall short of the threshold by.
CONFIDENCE = 5.0
# Rows of the sample that leaders are looked for in, members a cap needs there, and leaders at most.
SAMPLE, CAP_SAMPLE, LEADERS = 4096, 4, 512
# Rows of a block; a task compares two blocks at once, so many rows of one at a time.
BLOCK_ROWS, STEP = 8192, 256
# Least width of a code; shorter vectors are filled up with zeros.
CODE_BITS = 64
# What rounding may take from a cosine; caps are drawn that much narrower, distances wider.
SLACK = 1e-9

_CODED = "row long, vec_id long, unit binary, code binary, factor double"


def _angles(threshold: float) -> tuple[float, float]:
    """Least cosine to a leader of a cap's members, and of vectors that can be linked with a member."""
    reach = math.acos(threshold)
    return math.cos(reach / 2) + SLACK, math.cos(min(1.5 * reach, math.pi)) - SLACK


def units(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows over their lengths, and which rows have one."""
    largest = np.abs(values).max(axis=1, initial=0.0)
    scaled = values / np.where(largest > 0, largest, 1.0)[:, None]
    length = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
    return scaled / np.where(length > 0, length, 1.0)[:, None], largest > 0


def rotation(size: int) -> np.ndarray:
    """The same random rotation in every task."""
    q, r = np.linalg.qr(np.random.default_rng(11).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated vectors, and the correction factors."""
    own = unit @ turned.T
    return np.packbits(own > 0, axis=1), np.abs(own).sum(axis=1) / math.sqrt(turned.shape[0])


def bound_of(factor: np.ndarray, size: int, threshold: float) -> np.ndarray:
    """Deviation of the estimate of a pair whose cosine is the threshold."""
    return np.sqrt(np.maximum(1 - factor**2, 0)) / factor * math.sqrt((1 - threshold**2) / (size - 1))


def estimates(code: np.ndarray, factor: np.ndarray, unit: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """Estimated cosines of every coded row with every unit vector."""
    size = turned.shape[0]
    signs = np.unpackbits(code, axis=1, count=size).astype(np.float32) * 2 - 1
    own = (unit @ turned.T).astype(np.float32)
    return signs @ own.T / (factor * math.sqrt(size)).astype(np.float32)[:, None]


def _coded(size: int, length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned = rotation(size)
        for batch in blocks(batches, size):
            values, whole = matrix(batch.column("embedding"), size)
            unit, long = units(values)
            code, factor = encode(unit, turned)
            lost = pa.array(~(whole & long))
            names = ["row", "vec_id", "unit", "code", "factor"]
            columns = [batch.column("row"), batch.column("vec_id"), packed(unit), packed(code), pa.array(factor)]
            yield pa.RecordBatch.from_arrays(
                columns[:2] + [pa.compute.if_else(lost, pa.scalar(None, c.type), c) for c in columns[2:]], names=names)

    return rows


def leaders(sample: np.ndarray, threshold: float) -> np.ndarray:
    """Sampled vectors whose caps hold several others, taken greedily from the fullest."""
    least, _ = _angles(threshold)
    near = sample @ sample.T >= least if len(sample) else np.zeros((0, 0), dtype=bool)
    free, found = np.ones(len(sample), dtype=bool), []
    while len(found) < LEADERS and free.any():
        held = near @ free.astype(np.int64)
        held[~free] = 0
        best = int(held.argmax())
        if held[best] < CAP_SAMPLE:
            break
        found.append(best)
        free &= ~near[best]
    return sample[found]


def _placed(caps: np.ndarray, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The cap that each vector lies in, or -1, and the caps that it is compared with: it is their guest."""
    least, reach = _angles(threshold)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = caps.shape[1]
        for batch in blocks(batches, size):
            near = unpacked(batch.column("unit"), size) @ caps.T
            best = near.argmax(axis=1)
            home = np.where(near[np.arange(len(near)), best] >= least, best, -1)
            # Members of two caps are compared in the cap of the lesser number.
            guest = (near >= reach) & ((home[:, None] < 0) | (home[:, None] > np.arange(len(caps))[None, :]))
            at = np.r_[0, np.cumsum(guest.sum(axis=1))].astype(np.int32)
            guests = pa.ListArray.from_arrays(pa.array(at), pa.array(np.nonzero(guest)[1].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home.astype(np.int32)), guests],
                                             names=[*batch.schema.names, "home", "guest_of"])

    return rows


class _Forest:
    """Links that join trees, found step by step among the rows of two blocks."""

    def __init__(self, rows: int) -> None:
        self.label = np.arange(rows)
        self.edges: list[tuple[int, int]] = []

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            # Of every tree that is not the lesser of a link, one link: these never close a circle.
            high = np.maximum(x, y)
            trees, at = np.unique(high, return_index=True)
            target = np.arange(len(self.label))
            target[trees] = np.minimum(x, y)[at]
            self.edges.extend(zip(a[at].tolist(), b[at].tolist()))
            while True:
                further = target[target]
                if (further == target).all():
                    break
                target = further
            self.label = target[self.label]


def _linked(size: int, threshold: float, within: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of links and a spanning forest of one cell: rows of side 0 against rows of side 1.

    A cell of a block with itself has side 0 alone; ``within`` says that such cells occur.
    """
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        side, ids = table.column("side").to_numpy(), table.column("row").to_numpy()
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1)
        alone = within and not len(right)
        right = left if alone else right
        if not len(left) or not len(right):
            return
        unit = unpacked(table.column("unit"), size)
        code, factor = unpacked(table.column("code"), size // 8, np.uint8), table.column("factor").to_numpy()
        turned, counts, forest = rotation(size), np.zeros(len(ids), dtype=np.int64), _Forest(len(ids))
        own = (unit[right] @ turned.T).astype(np.float32)
        for start in range(0, len(left), STEP):
            some = left[start:start + STEP]
            signs = np.unpackbits(code[some], axis=1, count=size).astype(np.float32) * 2 - 1
            enough = (threshold - CONFIDENCE * bound_of(factor[some], size, threshold)) * factor[some] * math.sqrt(size)
            first = start if alone else 0
            maybe = signs @ own[first:].T >= enough.astype(np.float32)[:, None] - np.float32(1e-4)
            if alone:
                maybe &= np.arange(first, len(right))[None, :] > np.arange(start, start + len(some))[:, None]
            if maybe.sum() * 8 > maybe.size:
                maybe &= unit[some] @ unit[right[first:]].T >= threshold
                a, b = np.nonzero(maybe)
            else:
                a, b = np.nonzero(maybe)
                sure = np.concatenate([np.einsum("ij,ij->i", unit[some[a[i:i + 65536]]], unit[right[first + b[i:i + 65536]]])
                                       for i in range(0, len(a), 65536)] or [np.empty(0)]) >= threshold
                a, b = a[sure], b[sure]
            a, b = some[a], right[first + b]
            counts += np.bincount(a, minlength=len(ids)) + np.bincount(b, minlength=len(ids))
            forest.join(a, b)
        touched = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(ids[touched]), pa.nulls(len(touched), pa.int64()), pa.array(counts[touched])], schema=kind)
        if forest.edges:
            x, y = np.array(forest.edges).T
            yield pa.RecordBatch.from_arrays([pa.array(ids[x]), pa.array(ids[y]), pa.nulls(len(x), pa.int64())], schema=kind)

    return cell


def _cells(placed: DataFrame, size: int, threshold: float, block_rows: int) -> list[DataFrame]:
    """``a, b, n``: links of a forest, and counts where ``b`` is null, of all pairs but those within one cap."""
    found = "a long, b long, n long"
    names = ["row", "unit", "code", "factor"]
    loose = placed.where("home < 0")
    parts = max(1, math.ceil(loose.count() / block_rows))
    own = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    cells = (loose.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
             .select(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", *names)
             .withColumn("side", (F.col("own") != F.col("i")).cast("int")))
    result = [cells.groupBy("i", "j").applyInArrow(_linked(size, threshold, True), found)]
    members = placed.where("home >= 0").withColumn("cap", F.col("home"))
    guests = placed.withColumn("cap", F.explode("guest_of"))
    sizes = members.groupBy("cap").agg(F.count("*").alias("m")).join(guests.groupBy("cap").agg(F.count("*").alias("g")), "cap")
    shape = stored(sizes.select("cap", F.ceil(F.col("m") / block_rows).cast("int").alias("members"),
                                F.ceil(F.col("g") / block_rows).cast("int").alias("guests")), "cap-shapes")
    dealt = []
    for rows, side, mine, theirs in ((members, 0, "members", "guests"), (guests, 1, "guests", "members")):
        block = F.pmod(F.xxhash64("row"), F.col(mine)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(theirs) - 1))
        dealt.append(rows.join(shape, "cap").select("cap", block.alias(f"{mine}_block"), every.alias(f"{theirs}_block"),
                                                    F.lit(side).alias("side"), *names))
    both = dealt[0].unionByName(dealt[1])
    result.append(both.groupBy("cap", "members_block", "guests_block").applyInArrow(_linked(size, threshold, False), found))
    return result


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors(vec_id, embedding)``.

    Vectors of a cosine of ``threshold`` or more are linked; a component is named by its least ``vec_id``, whose row is
    kept. A vector that is null, zero, or has a null or non-finite component has no link. Vectors shorter than the
    longest count as filled up with zeros. Rows that repeat a ``vec_id`` are vectors of their own, which count and
    link each other as any do, and share a component. A row without ``vec_id`` counts and links too, but gives no name:
    its component is null if nothing in it has an id, and then it is kept. Other columns, such as labels,
    are ignored; an empty table gives no rows. Leaders come from at most ``sample`` rows; all rows are compared.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    length = width(rows, "embedding")
    size = max(CODE_BITS, -(-length // 8) * 8)
    coded = stored(rows.withColumn("row", row_key()).mapInArrow(_coded(size, length), _CODED), "vector-codes")
    known = coded.where("unit IS NOT NULL")
    drawn = known.select("unit", F.xxhash64("row").alias("h")).orderBy("h").limit(sample).select("unit").toArrow()
    caps = leaders(unpacked(drawn.column("unit"), size), threshold) if drawn.num_rows else np.empty((0, size))
    if len(caps):
        placed = stored(known.mapInArrow(_placed(caps, threshold), f"{_CODED}, home int, guest_of array<int>"), "vector-caps")
    else:
        placed = known.withColumns({"home": F.lit(-1), "guest_of": F.array().cast("array<int>")})
    results = _cells(placed, size, threshold, block_rows)
    found = results[0].unionByName(results[1]) if len(caps) else results[0]
    found = stored(found, "vector-links")
    # All members of a cap are linked with each other.
    capped = placed.where("home >= 0").select("row", "home")
    heads = capped.groupBy("home").agg(F.min("row").alias("head"), (F.count("*") - 1).alias("n"))
    inside = capped.join(heads, "home").select("row", "head", "n")
    counts = (found.where("b IS NULL").select(F.col("a").alias("row"), "n").unionByName(inside.select("row", "n"))
              .groupBy("row").agg(F.sum("n").alias("n_links")))
    same = known.where("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("row").alias("head"))
    repeated = coded.select("row", "vec_id").join(same, "vec_id").select(F.col("row").alias("u"), F.col("head").alias("v"))
    edges = (found.where("b IS NOT NULL").select(F.col("a").alias("u"), F.col("b").alias("v"))
             .unionByName(inside.select(F.col("row").alias("u"), F.col("head").alias("v"))).unionByName(repeated).where("u <> v"))
    labels = components(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))).withColumnRenamed("node", "row")
    named = coded.select("row", "vec_id").join(labels, "row", "left")
    names = named.where("component IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("component_id"))
    result = named.join(names, "component", "left").join(counts, "row", "left")
    component = F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return result.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
