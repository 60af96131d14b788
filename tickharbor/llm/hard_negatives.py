"""Hard negatives of anchors: rows of other labels whose scores lie in a window below those of the positives.

All rows are dealt into the cells of a hyperplane tree (``hyperplane_tree``). Its upper levels are fitted on a bounded
sample; the distance ranges of their subtrees come from all rows. Each block of a cell grows its own lower levels
in the task that searches it. Anchors go to the cells that the ranges leave, with their windows: first scores at least
as good as the best found in their own cell, to find the positives, then the windows of these.
Scores are exact: inner products of whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickharbor.llm import hyperplane_tree as T
from tickharbor.llm.vectors import blocks, matrix, packed, row_key, unpacked, width
from tickharbor.session import ship, stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# Least and largest score of a negative, in percent of the positive's.
LOW_PERCENT, HIGH_PERCENT = 50, 95
# Rows of the sample that the upper levels are fitted on, rows that a cell should have, and cells at most.
SAMPLE, CELL_ROWS, CELLS = 16_384, 8192, 2048
# Rows of a block and anchors of a chunk: a task searches one block for one chunk.
BLOCK_ROWS, CHUNK_ANCHORS = 16_384, 8192
# Whole numbers up to this are exact as doubles, also as sums; beyond it scores are computed with Python's.
EXACT = 2.0**53
_MOST = 2**63 - 1
# Below every score, and still a whole number when negated.
_NOTHING = -_MOST

_SCALED = "row long, vec_id long, label long, vector binary"
_HIT = "anchor long, w int, score long, vec_id long, row long"


def _scaled(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, size):
            values, whole = matrix(batch.column("embedding"), size)
            with np.errstate(over="ignore"):
                values = np.floor(SCALE * values)
            whole &= np.isfinite(values).all(axis=1)
            names = ["row", "vec_id", "label"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [packed(values)], names=[*names, "vector"]).filter(pa.array(whole))

    return rows


def _lengths(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows, largest squared length and largest component of a task's rows."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, longest, largest = 0, 0.0, 0.0
        for batch in blocks(batches, size):
            values = unpacked(batch.column("vector"), size)
            with np.errstate(over="ignore"):
                longest = max(longest, float(np.einsum("ij,ij->i", values, values).max(initial=0.0)))
            largest = max(largest, float(np.abs(values).max(initial=0.0)))
            rows += len(values)
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([longest]), pa.array([largest])],
                                         names=["rows", "longest", "largest"])

    return task


class Top:
    """The upper levels: nodes in a list, whose parts are numbers of nodes, or ~cell."""

    def __init__(self, sample: np.ndarray, longest: float, cells: int) -> None:
        self.longest, self.nodes, self.cells = longest, [], 0
        self.root = self._grow(sample, cells)

    def _grow(self, rows: np.ndarray, cells: int) -> int:
        if cells > 1 and len(rows) > 1:
            points, far, nearest = T.split(rows, self.longest, min(T.ARITY, cells))
            if len(points) > 1:
                node = T.Node(points, *T.ranges(far[:0], nearest[:0]))
                self.nodes.append(node)
                number = len(self.nodes) - 1
                node.parts = [self._grow(rows[nearest == j], math.ceil(cells * (nearest == j).mean())) for j in range(len(points))]
                return number
        self.cells += 1
        return ~(self.cells - 1)

    def place(self, rows: np.ndarray, seen: Callable | None = None) -> np.ndarray:
        """The cell of each lifted row; ``seen`` gets the distances at each node on the way."""
        cell = np.zeros(len(rows), dtype=np.int32)

        def at(part: int, own: np.ndarray) -> None:
            if part < 0:
                cell[own] = ~part
            elif len(own):
                node = self.nodes[part]
                far = T.distances(rows[own], node.points, self.longest)
                nearest = far.argmin(axis=1)
                if seen:
                    seen(part, far, nearest)
                for j, below in enumerate(node.parts):
                    at(below, own[nearest == j])

        at(self.root, np.arange(len(rows)))
        return cell

    def tree(self, part: int | None = None):
        """The nodes as a tree whose leaves are cells."""
        part = self.root if part is None else part
        if part < 0:
            return ~part
        node = self.nodes[part]
        return T.Node(node.points, node.low, node.high, [self.tree(p) for p in node.parts])


def _placed(top: Top, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, size):
            cell = top.place(T.lifted(unpacked(batch.column("vector"), size), top.longest))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    return rows


def _ranges(top: Top, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Least and largest distance from each split point to a task's rows of each subtree."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def seen(number: int, far: np.ndarray, nearest: np.ndarray) -> None:
            low, high = T.ranges(far, nearest)
            if number in known:
                low, high = np.minimum(low, known[number][0]), np.maximum(high, known[number][1])
            known[number] = low, high

        for batch in blocks(batches, size):
            top.place(T.lifted(unpacked(batch.column("vector"), size), top.longest), seen)
        for number, (low, high) in known.items():
            i, j = np.nonzero(np.isfinite(low))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), number)), pa.array(i), pa.array(j), pa.array(low[i, j]), pa.array(high[i, j])],
                names=["node", "i", "j", "low", "high"])

    return task


def _windows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of the query and of the window within it, least and largest score; infinite where null."""
    sizes = table.column("lows").combine_chunks().value_lengths().to_numpy()
    asked = np.repeat(np.arange(table.num_rows), sizes)
    ends = [np.array(table.column(c).combine_chunks().flatten().cast(pa.float64(), safe=False).fill_null(none))
            for c, none in (("lows", -np.inf), ("highs", np.inf))]
    return asked, np.arange(len(asked)) - np.repeat(np.cumsum(sizes) - sizes, sizes), *ends


def _routed(top: Top, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each query with the cells that may hold rows of its windows, but the one it has seen."""
    tree = top.tree()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, size):
            table = pa.Table.from_batches([batch])
            queries = unpacked(batch.column("vector"), size)
            squares = np.einsum("ij,ij->i", queries, queries)
            asked, _, low, high = _windows(table)
            seen = batch.column("seen").to_numpy(zero_copy_only=False)
            found: list[tuple[np.ndarray, int]] = []
            T.descend(tree, queries, squares, top.longest, asked, low, high, np.arange(len(asked)),
                      lambda cell, alive: found.append((np.unique(asked[alive]), cell)))
            own = np.concatenate([q for q, _ in found] or [np.empty(0, dtype=np.int64)]).astype(np.int64)
            cell = np.repeat(np.array([c for _, c in found], dtype=np.int32), [len(q) for q, _ in found])
            own, cell = own[seen[own] != cell], cell[seen[own] != cell]
            order = np.argsort(own, kind="stable")
            at = np.r_[0, np.cumsum(np.bincount(own, minlength=len(queries)))].astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(at), pa.array(cell[order]))],
                                             names=[*batch.schema.names, "cells"])

    return rows


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers; beyond 63 bits the nearest that fits."""
    most = np.abs(queries).max(initial=0.0) * np.abs(rows).max(initial=0.0) * queries.shape[1]
    if most < EXACT:
        return (queries @ rows.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in side], dtype=object) for side in (queries, rows)]
    return np.clip(whole[0] @ whole[1].T, 1 - _MOST, _MOST).astype(np.int64)


def _searched(size: int, longest: float, most: int, same: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The first ``most`` rows of each window within one block, of the query's label or of others."""
    schema = pa.schema([("anchor", pa.int64()), ("w", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64())])

    def block(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return schema.empty_table()
        rows = rows.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        ids, numbers, labels = (rows.column(c).to_numpy() for c in ("vec_id", "row", "label"))
        values, asking = unpacked(rows.column("vector"), size), unpacked(queries.column("vector"), size)
        own_row, own_label = (queries.column(c).to_numpy() for c in ("row", "label"))
        asked, w, low, high = _windows(queries)
        # Row numbers follow the order of ties.
        best = np.full((len(asked), most), _NOTHING)
        place = np.full((len(asked), most), len(ids))

        def leaf(part: np.ndarray, alive: np.ndarray) -> None:
            for first in range(0, len(part), T.LEAF_ROWS):
                some = part[first:first + T.LEAF_ROWS]
                own, at = np.unique(asked[alive], return_inverse=True)
                score = scores(asking[own], values[some])
                fits = (labels[some][None, :] == own_label[own][:, None]) == same
                fits &= numbers[some][None, :] != own_row[own][:, None]
                score = np.where(fits, score, _NOTHING)[at]
                score[(score < low[alive][:, None]) | (score > high[alive][:, None])] = _NOTHING
                hit = np.flatnonzero(score.max(axis=1) > _NOTHING)
                if not len(hit):
                    continue
                mine = alive[hit]
                both = np.concatenate([best[mine], score[hit]], axis=1)
                where = np.concatenate([place[mine], np.broadcast_to(some, (len(hit), len(some)))], axis=1)
                order = np.lexsort((where, -both), axis=1)[:, :most]
                best[mine], place[mine] = np.take_along_axis(both, order, 1), np.take_along_axis(where, order, 1)
                last = best[mine, -1]
                low[mine] = np.where(last > _NOTHING, np.maximum(low[mine], last), low[mine])

        squares = np.einsum("ij,ij->i", asking, asking)
        T.descend(T.grow(T.lifted(values, longest), longest), asking, squares, longest, asked, low, high, np.arange(len(asked)), leaf)
        x, k = np.nonzero(best > _NOTHING)
        at = place[x, k]
        return pa.table([own_row[asked[x]], w[x].astype(np.int32), best[x, k], ids[at], numbers[at]], schema=schema)

    return block


def _search(rows: DataFrame, queries: DataFrame, shape: DataFrame, chunks: int, size: int, longest: float, most: int, same: bool) -> DataFrame:
    """Search the cells in ``cells`` of each query: blocks of cells meet chunks of queries."""
    sent = (queries.withColumn("cell", F.explode("cells")).join(shape, "cell")
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("cell", "block", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("chunk"), "row", "label", "vector", "lows", "highs"))
    kept = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    keys = ["cell", "block", "chunk"]
    return kept.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(_searched(size, longest, most, same), _HIT)


def _first(hits: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "vec_id", "row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(vectors: DataFrame, anchor_step: int, positives: int = POSITIVES, negatives: int = NEGATIVES, sample: int = SAMPLE,
                   cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS, chunk_anchors: int = CHUNK_ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``vectors(vec_id, label, embedding)``.

    Anchors are the rows whose ``vec_id`` is divisible by ``anchor_step``. Components become floor(256 * x); a
    score is their inner product with the anchor. Higher scores come first, ties by ``vec_id``. For each of the first
    ``positives`` other rows of the anchor's label, the first ``negatives`` rows of other labels whose scores are from
    50 to 95 percent of the positive's are returned.

    Rows without ``vec_id`` or label, with a null vector, or a null or non-finite component (also after scaling) take no
    part. Shorter vectors count as filled up with zeros. Rows that repeat a ``vec_id`` are rows of their own. Scores
    beyond 63 bits are the nearest that fits. Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    size = max(1, width(rows, "embedding"))
    scaled = stored(rows.withColumn("row", row_key()).mapInArrow(_scaled(size), _SCALED), "scaled-vectors")
    total = scaled.mapInArrow(_lengths(size), "rows long, longest double, largest double").agg(F.sum("rows"), F.max("longest")).first()
    count, longest = total[0] or 0, total[1] or 0.0
    drawn = scaled.select("vector", F.xxhash64("row").alias("h")).orderBy("h").limit(sample).select("vector").toArrow()
    top = Top(T.lifted(unpacked(drawn.column("vector"), size), longest), longest, min(CELLS, math.ceil(count / cell_rows)))
    if top.nodes:
        found = (scaled.mapInArrow(_ranges(top, size), "node long, i long, j long, low double, high double")
                 .groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")))
        for r in found.toLocalIterator():  # one row per pair of subtrees of the upper levels
            top.nodes[r.node].low[r.i, r.j], top.nodes[r.node].high[r.i, r.j] = r.low, r.high
    cells = stored(scaled.mapInArrow(_placed(top, size), f"{_SCALED}, cell int"), "vector-cells")
    shape = cells.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    shape = stored(shape, "cell-blocks")
    blocked = cells.join(shape, "cell").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")).drop("blocks")
    anchors = stored(cells.where(F.col("vec_id") % anchor_step == 0), "anchors")
    chunks = max(1, math.ceil(anchors.count() / chunk_anchors))

    def one(column: str | None):
        return F.array(F.col(column) if column else F.lit(None).cast("long"))

    route = f"{_SCALED}, seen int, lows array<long>, highs array<long>, cells array<int>"
    at_home = anchors.select("*", F.array("cell").alias("cells"), one(None).alias("lows"), one(None).alias("highs"))
    near = stored(_search(blocked, at_home, shape, chunks, size, longest, positives, True), "home-positives")
    least = _first(near, positives).where(F.col("rank") == positives).select(F.col("anchor").alias("row"), F.col("score").alias("least"))
    further = (anchors.join(least, "row", "left").select("row", "vec_id", "label", "vector", F.col("cell").alias("seen"),
                                                         one("least").alias("lows"), one(None).alias("highs")))
    routed = further.mapInArrow(_routed(top, size), route)
    far = _search(blocked, routed, shape, chunks, size, longest, positives, True)
    best = stored(_first(near.unionByName(far), positives).select("anchor", "rank", "score", "vec_id"), "positives")
    # Windows of scores below zero are empty.
    exact = F.col("score").cast("decimal(20,0)")
    window = F.struct("rank", F.call_function("div", exact * LOW_PERCENT + 99, F.lit(100).cast("decimal(20,0)")).alias("low"),
                      F.call_function("div", exact * HIGH_PERCENT, F.lit(100).cast("decimal(20,0)")).alias("high"))
    windows = (best.where("score >= 0").groupBy("anchor").agg(F.sort_array(F.collect_list(window)).alias("windows"))
               .select(F.col("anchor").alias("row"), F.col("windows.low").alias("lows"), F.col("windows.high").alias("highs"),
                       F.col("windows.rank").alias("ranks")))
    asking = anchors.join(windows, "row").select("row", "vec_id", "label", "vector", F.lit(-1).alias("seen"), "lows", "highs")
    hits = _search(blocked, asking.mapInArrow(_routed(top, size), route), shape, chunks, size, longest, negatives, False)
    chosen = _first(hits, negatives).select("anchor", (F.col("w") + 1).alias("positive_rank"), "rank", "score", "vec_id")
    positive = best.select("anchor", F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (chosen.join(positive, ["anchor", "positive_rank"]).join(named, "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
