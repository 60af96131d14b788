"""Personal data in texts: fixed patterns, and identifiers found by the contexts that those induce.

Fixed patterns give the base spans; they are the seeds. The one and two words before a seed are lexical
patterns. What looks like an identifier but matches no fixed pattern is a candidate: a word with digits or an
"@", and a whole run of adjacent words like numbers, whose pattern is read before the run. Spark builds the graph
of patterns and instances and scores it in rounds: a pattern is worth the share of all its occurrences in
the corpus that are followed by a known instance; a candidate is worth what its good patterns make likely.
Candidates that end up likely are found, wherever they occur; within a run that is found, its parts are not told.

Counting a pattern's occurrences needs every word of the corpus, but only patterns that several different
seeds have are wanted: a bitmap of fixed size keeps the others out of the shuffle, and a join is exact.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickharbor.llm.memory import freed
from tickharbor.llm.textbytes import LOWER, SpanHash, column_bytes, mix, row_blocks, word_spans
from tickharbor.session import stored

KINDS = ("email", "ip", "card", "phone")
FOUND = "other"
# Different seeds that a pattern must precede, and shares that make a pattern good and a candidate found.
LEAST_SEEDS, GOOD_PATTERN, LIKELY = 2, 0.5, 0.6
ROUNDS = 3
CANDIDATE_DIGITS = 5
BITMAP = 1 << 20

_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(rb"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(rb"[^0-9]+")
# Candidates of several words: IBANs in groups, whose groups may lack digits; digits with brackets, dots, slashes,
# hyphens and dashes, and single spaces (also no-break ones), with the letters that the outermost digits are joined to.
_JOINT = rb"(?:[().\[\]/+-]|\xE2\x80[\x90-\x95])*+"
_RUN = re.compile(
    rb"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20[0-9A-Z]{4}){2,7}(?:\x20[0-9A-Z]{1,3})?(?![0-9A-Za-z])"
    rb"|\+?[(\[]{0,2}\+?[0-9](?:" + _JOINT + rb"(?:(?:\x20|\xC2\xA0|\xE2\x80\xAF)" + _JOINT + rb")?+[0-9])+[A-Za-z0-9]*")
_SEPARATE = re.compile(rb"\x20|\xC2\xA0|\xE2\x80\xAF")
_TRIM = b"\"'()[]{}<>,.;:!?"
_LETTERS = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_DIGIT = np.zeros(256, dtype=np.int64)
_DIGIT[0x30:0x3A] = 1
_PAIR = np.uint64(0xA24BAED4963EE407)
_START = np.uint64(0x9FB21C651E98DF25)

Span = tuple[int, int, int]


def luhn(digits: bytes) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = (digit - 48) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: bytes) -> Iterator[Span]:
    done, at = 0, text.find(b"@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        while domain and start > done and text[start - 1] in _LOCAL:
            start -= 1
        if domain and start < at:
            done = domain.end()
            yield 0, start, done
            at = text.find(b"@", done)
        else:
            at = text.find(b"@", at + 1)


def base_spans(text: bytes) -> list[Span]:
    """(kind, start, end) in bytes by kind, then start. A match that fails its check is dropped and not retried."""
    found = list(_emails(text))
    for match in _IP.finditer(text):
        if all(len(p.lstrip(b"0")) <= 3 and int(p.lstrip(b"0") or b"0") <= 255 for p in match[0].split(b".")):
            found.append((1, *match.span()))
    for match in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub(b"", match[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *match.span()))
    for match in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub(b"", match[0])) <= 15:
            found.append((3, *match.span()))
    return found


def runs(text: bytes, spans: list[Span]) -> list[tuple[int, int, bool]]:
    """(start, end, whole) of candidates of several words outside the base spans, by start.

    Where a dot and a space stand within a run, a sentence may end: its parts are candidates as well, not whole.
    """
    if spans:
        blank = bytearray(text)
        for _, a, b in spans:
            blank[a:b] = bytes(b - a)
        text = bytes(blank)
    found = []
    for match in _RUN.finditer(text):
        start, end = match.span()
        if not _SEPARATE.search(match[0]):
            continue
        while start and text[start] in _LETTERS and text[start - 1] in _LETTERS:
            start -= 1
        pieces, at = [(start, end)], start
        for part in text[start:end].split(b". ") if b". " in match[0] else []:
            pieces.append((at, at + len(part)))
            at += len(part) + 2
        for k, (a, b) in enumerate(pieces):
            while text[a] in b"([" and sum(map(text[a:b].count, (b"(", b"["))) > sum(map(text[a:b].count, (b")", b"]"))):
                a += 1
            if len(_NOT_DIGIT.sub(b"", text[a:b])) >= CANDIDATE_DIGITS and _SEPARATE.search(text, a, b):
                found.append((a, b, not k))
    return found


class Words:
    """Words of a block of texts, and the patterns before each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.starts, self.ends, self.firsts = word_spans(data, offsets)
        self.spans = SpanHash(LOWER[data])
        hashes = self.spans.of(self.starts, self.ends)
        order = np.arange(len(hashes))
        first = np.repeat(self.firsts[:-1], np.diff(self.firsts))
        one = np.where(order - 1 >= first, np.roll(hashes, 1), _START)
        two = np.where(order - 2 >= first, np.roll(hashes, 2), _START)
        self.one, self.two = mix(one), mix(one + two * _PAIR)


_SHAPE = pa.list_(pa.struct([("seed", pa.bool_()), ("outer", pa.bool_()), ("instance", pa.int64()), ("one", pa.int64()), ("two", pa.int64()),
                             ("begin", pa.int64()), ("end", pa.int64())]))
_SCAN = ("doc_id long, text_key long, base string, n_email long, n_ip long, n_card long, n_phone long, mentions "
         "array<struct<seed: boolean, outer: boolean, instance: long, one: long, two: long, begin: long, end: long>>")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = column_bytes(batch.column("text"))
        bases, counts, mentions = [], [], []
        for first, last in row_blocks(offsets):
            block = data[offsets[first]:offsets[last]]
            own = offsets[first:last + 1] - offsets[first]
            raw, words = block.tobytes(), Words(block, own)
            points = np.concatenate([[0], np.cumsum((block & 0xC0) != 0x80)])
            digits = np.concatenate([[0], np.cumsum(_DIGIT[block])])
            marked = np.concatenate([[0], np.cumsum(block == 0x40)])
            likely = np.flatnonzero((digits[words.ends] - digits[words.starts] >= CANDIDATE_DIGITS)
                                    | (marked[words.ends] > marked[words.starts]))
            bounds = np.searchsorted(likely, words.firsts)
            for row in range(last - first):
                base, zero = int(own[row]), points[own[row]]
                spans = base_spans(raw[base:int(own[row + 1])])
                taken = [(True, base + a, base + b, True) for _, a, b in spans]
                # Starts of the base spans in order, and how far the spans up to each reach.
                begins, reach = zip(*sorted((a, b) for _, a, b, _ in taken)) if taken else ((), ())
                reach = list(accumulate(reach, max))
                more = [(False, base + a, base + b, whole) for a, b, whole in runs(raw[base:int(own[row + 1])], spans)]
                heads = np.searchsorted(words.starts, [a for _, a, _, whole in more if whole], side="right") - 1
                heads = set(heads.tolist())
                for word in likely[bounds[row]:bounds[row + 1]].tolist():
                    a, b = int(words.starts[word]), int(words.ends[word])
                    piece = raw[a:b].lstrip(_TRIM)
                    a, b = b - len(piece), b - len(piece) + len(piece.rstrip(_TRIM))
                    before = bisect_left(begins, b)
                    if a < b and not (before and reach[before - 1] > a):
                        taken.append((False, a, b, word not in heads))
                taken += more
                bases.append(",".join(f"{KINDS[k]}:{points[base + a] - zero}:{points[base + b] - zero}" for k, a, b in spans))
                counts.append([sum(k == kind for k, _, _ in spans) for kind in range(4)])
                if not taken:
                    mentions.append([])
                    continue
                begin, end = (np.array([t[k] for t in taken]) for k in (1, 2))
                at = np.searchsorted(words.starts, begin, side="right") - 1
                named = words.spans.of(begin, end).view(np.int64).tolist()
                mentions.append([
                    {"seed": t[0], "outer": t[3], "instance": n, "one": o, "two": p, "begin": int(points[t[1]] - zero), "end": int(points[t[2]] - zero)}
                    for t, n, o, p in zip(taken, named, words.one[at].view(np.int64).tolist(), words.two[at].view(np.int64).tolist())])
        table = np.array(counts, dtype=np.int64).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(bases, pa.string()),
             *(pa.array(table[:, k]) for k in range(4)), pa.array(mentions, _SHAPE)],
            names=["doc_id", "text_key", "base", *(f"n_{k}" for k in KINDS), "mentions"])


def _keyed(documents: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _occurrences(wanted: np.ndarray):
    """Counts of the patterns in a task's texts whose place in the bitmap is set."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            kept = [np.empty(0, dtype=np.uint64)]
            for first, last in row_blocks(offsets):
                words = Words(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
                for patterns in (words.one, words.two):
                    kept.append(patterns[wanted[(patterns & np.uint64(BITMAP - 1)).astype(np.int64)]])
            patterns, times = np.unique(np.concatenate(kept), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(patterns.view(np.int64)), pa.array(times, pa.int64())],
                                             names=["pattern", "times"])

    return count


def discovered(documents: DataFrame, scanned: DataFrame) -> DataFrame:
    """``doc_id, text_key, begin, end`` of identifiers beyond the base spans, in code points."""
    mentions = scanned.select(F.explode("mentions").alias("m")).select("m.*")
    # Of candidates that begin in the same word only the longest counts as what follows the pattern there.
    edges = stored(mentions.select("seed", "outer", "instance", F.explode(F.array("one", "two")).alias("pattern"))
                   .groupBy("pattern", "instance", "seed").agg(F.count_if("outer").alias("times")), "pattern-instances")
    seeded = stored(edges.where("seed").groupBy("pattern").agg(F.count("*").alias("seeds"))
                    .where(F.col("seeds") >= LEAST_SEEDS).select("pattern"), "seed-patterns")
    places = seeded.select(F.col("pattern").bitwiseAND(BITMAP - 1).alias("place")).distinct().toArrow()  # at most BITMAP rows
    wanted = np.zeros(BITMAP, dtype=bool)
    wanted[places["place"].to_numpy()] = True
    shared = documents.sparkSession.sparkContext.broadcast(wanted)
    texts = documents.select(F.coalesce("text", F.lit("")).alias("text"))
    totals = (texts.mapInArrow(lambda batches: _occurrences(shared.value)(batches), "pattern long, times long")
              .groupBy("pattern").agg(F.sum("times").alias("total")).join(seeded, "pattern"))
    graph = stored(edges.join(totals, "pattern"), "pattern-graph")
    scores = None
    for _ in range(ROUNDS):
        known = graph.withColumn("score", F.when(F.col("seed"), 1.0).otherwise(0.0))
        if scores is not None:
            known = (graph.join(scores, "instance", "left")
                     .withColumn("score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("likely", F.lit(0.0)))))
        worth = known.groupBy("pattern").agg(F.least(F.lit(0.999), F.sum(F.col("times") * F.col("score"))
                                                     / F.first("total")).alias("worth")).where(F.col("worth") >= GOOD_PATTERN)
        scores = stored(graph.where("NOT seed").join(worth, "pattern").groupBy("instance")
                        .agg((1 - F.exp(F.sum(F.log1p(-F.col("worth"))))).alias("likely")), "instance-scores")
    likely = scores.where(F.col("likely") >= LIKELY).select("instance")
    spans = scanned.select("doc_id", "text_key", F.explode("mentions").alias("m")).where("NOT m.seed")
    found = (spans.select("doc_id", "text_key", "m.instance", "m.begin", "m.end").join(likely, "instance")
             .select("doc_id", "text_key", "begin", "end").distinct())
    # Of nested ones the longest is found.
    before = Window.partitionBy("doc_id", "text_key").orderBy("begin", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    return (found.withColumn("covered", F.max("end").over(before))
            .where("covered IS NULL OR end > covered").drop("covered"))


def personal_data(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, base, n_email, n_ip, n_card, n_phone, found`` for each row of ``documents(doc_id, text)``.

    ``base`` has the spans of the fixed patterns as kind:start:end in code points, end exclusive, joined by
    commas; the counts are theirs. ``found`` is an array of (begin, end), in order, of further identifiers; they
    overlap no base span. A null or empty text has none. Rows that repeat a ``doc_id`` are told apart by a hash
    of their text; equal rows have equal spans. Other columns are ignored; an empty table gives no rows.
    """
    scanned = stored(_keyed(documents).mapInArrow(_scan, _SCAN), "personal-data")
    more = (discovered(documents, scanned).groupBy("doc_id", "text_key")
            .agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("found")))
    rows, more = scanned.drop("mentions").alias("s"), more.alias("f")
    same = F.col("s.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("s.text_key") == F.col("f.text_key"))
    return rows.join(more, same, "left").select("s.*", F.coalesce(
        "f.found", F.expr("CAST(array() AS array<struct<begin: bigint, end: bigint>>)")).alias("found"))


def spans_text(base: str = "base", found: str = "found") -> F.Column:
    """All spans as text: the base spans, then those found, as kind:start:end joined by commas."""
    more = F.transform(found, lambda s: F.concat_ws(":", F.lit(FOUND), s["begin"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", F.when(F.col(base) != "", F.col(base)), F.when(F.size(found) > 0, F.array_join(more, ",")))


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, more in zip(batch.column("text").to_pylist(), batch.column("__found").to_pylist()):
            if text is None:
                texts.append(None)
                continue
            raw = text.encode()
            marks = [(len(raw[:a].decode()), len(raw[:b].decode()), KINDS[k]) for k, a, b in base_spans(raw)]
            marks += [(m["begin"], m["end"], FOUND) for m in more or []]
            # Spans of different kinds may overlap: the first by start covers what overlaps it.
            parts, at = [], 0
            for a, b, kind in sorted(marks):
                if a >= at:
                    parts += [text[at:a], f"[{kind.upper()}]"]
                at = max(at, b)
            texts.append("".join(parts) + text[at:])
        place = batch.schema.get_field_index("text")
        yield batch.set_column(place, "text", pa.array(texts, batch.schema.field(place).type)).drop_columns(["__found"])


def masked(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` with every span of personal data replaced by its kind in brackets.

    All columns stay; only ``text`` changes. Null texts stay null.
    """
    more = personal_data(documents).where(F.size("found") > 0).select(
        F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key"), F.col("found").alias("__found")).distinct()
    key = F.xxhash64(F.coalesce(documents["text"], F.lit("")))
    rows = documents.join(more, documents["doc_id"].cast("long").eqNullSafe(more["__doc"]) & (key == more["__key"]), "left")
    return rows.select(*documents.columns, "__found").mapInArrow(freed(_masked), documents.schema)
