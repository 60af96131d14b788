"""Benchmark passages in documents by latent semantic retrieval and common subsequences.

Documents are cut into passages of 32 words that overlap by half; a passage is a TF-IDF vector over hashed
words. The leading right singular vectors of the matrix of all passages come from a distributed randomised
decomposition: every task multiplies its passages with a random matrix and back, the sums are one matrix of
fixed size, and from it follow singular vectors and values (Nystroem's form for the Gram matrix). In the
latent space, scaled by singular values, passages near to a passage of a benchmark item by cosine are
candidates. A candidate counts if the item's words are its longest common subsequence for the most part, and,
where a paraphrase leaves less, if the answer (the item's last sentence) is there.

Words are runs of letters and digits; case and punctuation do not count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickharbor.llm.memory import freed
from tickharbor.llm.textbytes import column_bytes, plain_word_hashes, row_blocks

WINDOW, STRIDE = 32, 16
TERMS, DIMENSIONS = 1 << 15, 64
# Cosine of a candidate; passages that share no words pass it by chance about once in a hundred.
LEAST_COSINE = 0.3
# Share of an item's words in the common subsequence: enough alone, and enough with this share of the answer.
SHARE, PARAPHRASE, ANSWER = 0.75, 0.55, 0.8
# Share of an item passage's terms that a passage must have before the words are compared in order.
LEAST_OVERLAP = 0.3
# Words of items that are searched for in one pass, and cosines that a task holds at once.
PASS_WORDS = 1 << 18
COSINES = 1 << 21
# Bytes of a block and passages of a step, small enough for their arrays to stay in a core's cache.
BLOCK, STEP = 1 << 17, 512
CHUNK = 64
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def passages(words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and first word of every passage, and its terms (TERMS where there is none or it is there already)."""
    counts = np.diff(firsts)
    each = np.where(counts > WINDOW, -(-(counts - WINDOW) // STRIDE) + 1, (counts > 0).astype(np.int64))
    row = np.repeat(np.arange(len(counts)), each)
    number = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    start = firsts[row] + number * STRIDE
    known = np.append((words & np.uint64(TERMS - 1)).astype(np.int32), np.int32(TERMS))
    place = start[:, None] + np.arange(WINDOW)
    # Only the last passage of a text can reach beyond it.
    short = np.flatnonzero(start + WINDOW > firsts[row + 1])
    place[short] = np.where(place[short] < firsts[row[short] + 1][:, None], place[short], len(words))
    terms = known[place]
    terms.sort(axis=1)
    terms[:, 1:][terms[:, 1:] == terms[:, :-1]] = TERMS
    return row, start, terms


def _blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, offsets = column_bytes(column)
    for first, last in row_blocks(offsets, BLOCK):
        yield first, *plain_word_hashes(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages with each term; at TERMS the number of passages."""
    counts = np.zeros(TERMS + 1, dtype=np.int64)
    for batch in batches:
        for _, words, firsts in _blocks(batch.column("text")):
            terms = passages(words, firsts)[2]
            counts[:TERMS] += np.bincount(terms.ravel(), minlength=TERMS + 1)[:TERMS]
            counts[TERMS] += len(terms)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used])], names=["term", "n"])


def _random_matrix() -> np.ndarray:
    return np.random.default_rng(5).standard_normal((TERMS, DIMENSIONS)).astype(np.float32)


def _summed(rows: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """The sum of the rows of each passage's terms, added place by place: one row of each passage at a time is held."""
    rows = np.ascontiguousarray(rows)
    out = np.empty((len(terms), rows.shape[1]), dtype=np.float32)
    held = np.empty((min(STEP, len(terms)), rows.shape[1]), dtype=np.float32)
    for i in range(0, len(terms), STEP):
        first, *others = terms[i:i + STEP].T.astype(np.intp, order="C")
        here, row = out[i:i + STEP], held[:len(first)]
        # Terms are within the rows; "clip" only saves a copy.
        rows.take(first, axis=0, out=here, mode="clip")
        for term in others:
            here += rows.take(term, axis=0, out=row, mode="clip")
    return out


def _some_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The terms of all passages, so many at once that the arrays of a step stay small whatever the texts' lengths."""
    held, rows = [], 0
    for batch in batches:
        for _, words, firsts in _blocks(batch.column("text")):
            terms = passages(words, firsts)[2]
            held.append(terms)
            rows += len(terms)
            if rows >= 16 * STEP:
                joined = np.concatenate(held)
                for i in range(0, len(joined) - 16 * STEP + 1, 16 * STEP):
                    yield joined[i:i + 16 * STEP]
                held, rows = [joined[len(joined) // (16 * STEP) * 16 * STEP:].copy()], len(joined) % (16 * STEP)
    if rows:
        yield np.concatenate(held)


def _multiplier(weights: np.ndarray):
    """Each task's share of AᵀAΩ, in chunks of rows."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.append(weights, 0).astype(np.float32)
        right = np.vstack([_random_matrix() * weight[:-1, None], np.zeros((1, DIMENSIONS), dtype=np.float32)])
        sums = np.zeros((DIMENSIONS, TERMS + 1))
        for terms in _some_passages(batches):
            norm = np.maximum((weight[terms] ** 2).sum(axis=1), 1e-12)
            # Both as counting wants them, once for all dimensions.
            left = (_summed(right, terms) / norm[:, None]).T.astype(np.float64, order="C")
            flat = terms.ravel().astype(np.int64)
            for dimension in range(DIMENSIONS):
                sums[dimension] += np.bincount(flat, np.repeat(left[dimension], WINDOW), TERMS + 1)
        product = sums[:, :-1].T * weight[:-1, None]
        if product.any():
            yield pa.RecordBatch.from_arrays([
                pa.array(range(TERMS // CHUNK), pa.int32()),
                pa.array([product[k:k + CHUNK].astype(np.float32).tobytes() for k in range(0, TERMS, CHUNK)], pa.binary())],
                names=["chunk", "sums"])

    return multiply


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the parts of each chunk as they come; a task holds one sum for each of its chunks."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, part in zip(batch.column("chunk").to_pylist(), batch.column("sums").to_pylist()):
            totals[chunk] = totals.get(chunk, 0) + np.frombuffer(part, dtype=np.float32).astype(np.float64)
    if totals:
        yield pa.RecordBatch.from_arrays([pa.array(totals.keys(), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())],
                                         names=["chunk", "sums"])


@dataclass
class Space:
    """Latent coordinates of a term: its weight times its singular vectors, over the singular values."""

    coordinates: np.ndarray
    values: np.ndarray

    def place(self, terms: np.ndarray) -> np.ndarray:
        """Unit vectors of passages; a passage of unknown terms only is zero."""
        out = _summed(self.coordinates, terms)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def latent_space(documents: DataFrame) -> Space:
    """The leading singular vectors of the TF-IDF matrix of all passages of ``documents(text)``.

    The driver gets one number for each term and one matrix of TERMS by DIMENSIONS, whatever the input.
    """
    texts = documents.select(F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.mapInArrow(freed(_frequencies), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(TERMS + 1)
    counts[counted["term"].to_numpy()] = counted["n"].to_numpy()
    weights = np.where(counts[:-1] > 0, np.log((1 + counts[-1]) / (1 + counts[:-1])), 0.0)
    sums = (texts.mapInArrow(freed(_multiplier(weights)), "chunk int, sums binary").repartition("chunk")
            .mapInArrow(_added, "chunk int, sums binary").toArrow())
    product = np.zeros((TERMS, DIMENSIONS))
    for chunk, part in zip(sums["chunk"].to_pylist(), sums["sums"].to_pylist()):
        product[chunk * CHUNK:(chunk + 1) * CHUNK] = np.frombuffer(part).reshape(CHUNK, DIMENSIONS)
    random = _random_matrix().astype(np.float64)
    core = random.T @ product
    values, turn = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-9 * max(values.max(), 1e-30)
    factor = product @ (turn[:, good] / np.sqrt(values[good]))
    vectors, singular, _ = np.linalg.svd(factor, full_matrices=False)
    known = singular > 1e-6 * max(singular.max(initial=0.0), 1e-30)
    scaled = vectors[:, known] / singular[known] * weights[:, None]
    return Space(np.vstack([scaled, np.zeros((1, scaled.shape[1]))]).astype(np.float32, order="C"), singular[known])


@dataclass
class Items:
    """Benchmark items of one pass: words and answers, and the passages that stand for them."""

    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    owner: np.ndarray
    terms: np.ndarray


def _words(texts: list[str]) -> list[np.ndarray]:
    out = []
    for _, words, firsts in _blocks(pa.array(texts, pa.string())):
        out += [words[a:b] for a, b in zip(firsts[:-1], firsts[1:])]
    return out


def read_items(rows: list) -> Items:
    """Items with words; the answer is the last sentence."""
    kept = [(r["item_id"], r["text"]) for r in rows if r["text"]]
    words = _words([t for _, t in kept])
    answers = _words([_SENTENCE.split(t.strip())[-1] for _, t in kept])
    used = [k for k, w in enumerate(words) if len(w)]
    flat = np.concatenate([words[k] for k in used]) if used else np.empty(0, dtype=np.uint64)
    owner, _, terms = passages(flat, np.cumsum([0] + [len(words[k]) for k in used]))
    return Items([kept[k][0] for k in used], [words[k] for k in used],
                 [answers[k] if len(answers[k]) else words[k] for k in used], owner, terms)


def common_subsequence(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence, a machine word of columns at a time."""
    full = (1 << size) - 1
    state = full
    for word in words:
        here = state & masks.get(word, 0)
        state = ((state + here) | (state - here)) & full
    return size - state.bit_count()


def _masks(words: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for k, word in enumerate(words.tolist()):
        masks[word] = masks.get(word, 0) | (1 << k)
    return masks


class Search:
    """Finds the items of one pass in columns of texts."""

    def __init__(self, space: Space, items: Items):
        self.space, self.items = space, items
        self.queries = space.place(items.terms)
        self.terms = [t[t < TERMS] for t in items.terms]
        self.sorted = [np.unique(w) for w in items.words]
        self.masks = [(_masks(w), _masks(a)) for w, a in zip(items.words, items.answers)]

    def _check(self, item: int, words: np.ndarray) -> tuple[float, float] | None:
        """Shares of the item and of its answer in the common subsequence, if they count."""
        size, own = len(self.items.words[item]), self.sorted[item]
        at = np.minimum(np.searchsorted(own, words), len(own) - 1)
        words = words[own[at] == words]
        if len(words) < PARAPHRASE * size:
            return None
        words = words.tolist()
        share = common_subsequence(self.masks[item][0], size, words) / size
        answer = common_subsequence(self.masks[item][1], len(self.items.answers[item]), words) / len(self.items.answers[item])
        return (share, answer) if share >= SHARE or (share >= PARAPHRASE and answer >= ANSWER) else None

    def _candidates(self, terms: np.ndarray) -> Iterator[tuple[int, int]]:
        """(passage, item) near by cosine and with enough terms in common."""
        wanted = np.zeros(TERMS + 1, dtype=np.uint8)
        step = max(64, COSINES // max(1, len(self.queries)))
        for i in range(0, len(terms), step):
            queries, near = np.nonzero(self.queries @ self.space.place(terms[i:i + step]).T >= LEAST_COSINE)
            used, begin = np.unique(queries, return_index=True)
            for query, a, b in zip(used.tolist(), begin.tolist(), [*begin[1:].tolist(), len(queries)]):
                own = self.terms[query]
                wanted[own] = 1
                some = near[a:b] + i
                shared = wanted.take(terms.take(some, axis=0), mode="clip").sum(axis=1, dtype=np.uint8)  # at most WINDOW
                for passage in some[shared >= LEAST_OVERLAP * len(own)].tolist():
                    yield passage, int(self.items.owner[query])
                wanted[own] = 0

    def find(self, column: pa.Array) -> Iterator[tuple[int, int, float, float]]:
        """(row, item, share, answer share) of every item in a text, at its best passage."""
        for base, words, firsts in _blocks(column):
            row, start, terms = passages(words, firsts)
            best: dict[tuple[int, int], tuple[float, float]] = {}
            for passage, item in self._candidates(terms):
                r, margin = int(row[passage]), len(self.items.words[item])
                if best.get((r, item), (0.0,))[0] == 1.0:
                    continue
                a = max(int(firsts[r]), int(start[passage]) - margin)
                b = min(int(firsts[r + 1]), int(start[passage]) + WINDOW + margin)
                found = self._check(item, words[a:b])
                if found:
                    best[r, item] = max(best.get((r, item), (0.0, 0.0)), found)
            for (r, item), (share, answer) in sorted(best.items()):
                yield base + r, item, share, answer


def item_passes(benchmark: DataFrame) -> Iterator[Items]:
    """The items in parts of bounded size, so that what every task gets is bounded too."""
    known = benchmark.select("item_id", "text").where("text IS NOT NULL AND text <> ''").distinct()
    words = known.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-words // (4 * PASS_WORDS)))
    for part in range(parts):
        items = read_items(known.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).collect())
        if items.ids:
            yield items


def _finder(space: Space, items: Items):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(space, items)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            found = [(ids[r], items.ids[k], share, answer) for r, k, share, answer in search.find(batch.column("text"))]
            if found:
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)],
                                                 names=["doc_id", "item_id", "share", "answer_share"])

    return find


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, share, answer_share`` for each document and benchmark item that it holds.

    ``share`` is the part of the item's words in the common subsequence at the best passage. Texts that are
    null or have no words hold nothing; items without words are held by none. Equal rows count once for each
    row; a row without ``doc_id`` is reported without it. Other columns are ignored; if either table is
    empty there are no rows. Documents are read three times, and nothing of them is moved but the counts.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    space, out = latent_space(docs), None
    known = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    for items in item_passes(known):
        found = docs.mapInArrow(freed(_finder(space, items)), "doc_id long, item_id long, share double, answer_share double")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return documents.sparkSession.createDataFrame([], "doc_id long, item_id long, share double, answer_share double")
    return out


def _cleaner(space: Space, items: Items):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(space, items)
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            keep[[r for r, *_ in search.find(batch.column("text"))]] = False
            yield batch.filter(pa.array(keep))

    return clean


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that hold no benchmark item, with all their columns."""
    space, out = latent_space(documents), documents
    for items in item_passes(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")):
        out = out.mapInArrow(freed(_cleaner(space, items)), documents.schema)
    return out
