"""Language of a text from unigram pieces, summed over all segmentations.

The vocabulary is fixed: the pieces of a public tokenizer that consist of letters, in lower case, with or
without the mark of a word's beginning. Each language has a probability for each piece. A word's probability
is the sum over all ways to cut it into pieces, by the forward algorithm; a text's is the product over its
words. Probabilities are learned by expectation maximisation over the words of labelled documents, where
forward and backward sums give the expected number of times a piece is used. A further hypothesis, letters
drawn evenly, stands for text of no learned language.

Words are found and hashed with vector operations; each different word is scored once per worker and kept
in a table of fixed size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickharbor.llm.memory import freed
from tickharbor.llm.textbytes import LOWER, SpanHash, column_bytes, row_blocks
from tickharbor.session import stored

# Labelled documents of each language that the model is fitted on, at most; those with the least hash of their id.
SAMPLE = 1500
ROUNDS = 3
# Probability of a letter that no piece covers, and of a piece that a language never used.
UNKNOWN, SMOOTHING = 1e-6, 0.01
# Score below which a document is in none of the languages; a short text does not get that low by chance.
KEPT_SCORE = 0.01
# Letters of the even hypothesis.
EVEN_LETTERS = 40
# Longer runs of letters are scored in stretches of this many.
STRETCH = 48
SLOTS = 1 << 19
BEGIN = "▁"

_LETTERS = re.compile(r"[^\W\d_]+")
# Keeps forward sums near one: about the inverse probability of a letter.
_SCALE = 10.0


def vocabulary_pieces(path: str) -> list[str]:
    """Lower-cased letter pieces of a sentencepiece vocabulary, with BEGIN where they begin a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if p == BEGIN or _LETTERS.fullmatch(p.removeprefix(BEGIN)))


class Lattice:
    """All pieces that occur in words, found by walking a trie from every position at once."""

    def __init__(self, pieces: list[str]):
        edges, terminal, nodes = {}, {0: -1}, 1
        for number, piece in enumerate(pieces):
            node = 0
            for letter in piece:
                key = (node << 21) | ord(letter)
                if key not in edges:
                    edges[key] = nodes
                    terminal[nodes] = -1
                    nodes += 1
                node = edges[key]
            terminal[node] = number
        self.pieces = len(pieces)
        self.keys = np.array(sorted(edges), dtype=np.int64)
        self.children = np.array([edges[k] for k in self.keys.tolist()], dtype=np.int64)
        self.terminal = np.array([terminal[n] for n in range(nodes)], dtype=np.int64)

    def matches(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Word, start, end and piece of each occurrence in order of start; a letter without a piece has piece -1."""
        sizes = np.array([len(w) + 1 for w in words], dtype=np.int64)
        letters = np.frombuffer("".join(BEGIN + w for w in words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        room = sizes[word] - place
        lane, node = np.arange(len(letters)), np.zeros(len(letters), dtype=np.int64)
        found, single, length = [], np.zeros(len(letters), dtype=bool), 0
        while len(lane):
            key = (node << 21) | letters[lane + length]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            lane, node = lane[hit], self.children[at[hit]]
            length += 1
            ends = self.terminal[node] >= 0
            found.append((lane[ends], np.full(ends.sum(), length), self.terminal[node[ends]]))
            if length == 1:
                single[lane[ends]] = True
            more = room[lane] > length
            lane, node = lane[more], node[more]
        bare = np.flatnonzero(~single)
        found.append((bare, np.ones(len(bare), dtype=np.int64), np.full(len(bare), -1)))
        lane, size, piece = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(place[lane], kind="stable")
        lane, size, piece = lane[order], size[order], piece[order]
        return word[lane], place[lane], place[lane] + size, piece

    def forward(self, words: list[str], probabilities: np.ndarray) -> np.ndarray:
        """Log probability of each word (rows) by each language (columns)."""
        word, start, end, piece = self.matches(words)
        weight = np.vstack([probabilities, np.full(probabilities.shape[1], UNKNOWN)])[piece]
        weight *= (_SCALE ** (end - start))[:, None]
        sizes = np.array([len(w) + 1 for w in words])
        sums = np.zeros((len(words), sizes.max() + 1, probabilities.shape[1]))
        sums[:, 0] = 1.0
        bounds = np.searchsorted(start, np.arange(sizes.max() + 1))
        for at in range(sizes.max()):
            now = slice(bounds[at], bounds[at + 1])
            sums[word[now], end[now]] += sums[word[now], at] * weight[now]
        return np.log(sums[np.arange(len(words)), sizes]) - (sizes * np.log(_SCALE))[:, None]

    def expected(self, words: list[str], times: np.ndarray, probabilities: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in words that occur ``times``, by one language's probabilities."""
        word, start, end, piece = self.matches(words)
        weight = np.append(probabilities, UNKNOWN)[piece] * _SCALE ** (end - start)
        sizes = np.array([len(w) + 1 for w in words])
        ahead = np.zeros((len(words), sizes.max() + 1))
        back = np.zeros_like(ahead)
        ahead[:, 0], back[np.arange(len(words)), sizes] = 1.0, 1.0
        bounds = np.searchsorted(start, np.arange(sizes.max() + 1))
        for at in range(sizes.max()):
            now = slice(bounds[at], bounds[at + 1])
            ahead[word[now], end[now]] += ahead[word[now], at] * weight[now]
        for at in reversed(range(sizes.max())):
            now = slice(bounds[at], bounds[at + 1])
            np.add.at(back, (word[now], at), weight[now] * back[word[now], end[now]])
        share = ahead[word, start] * weight * back[word, end] / back[word, 0] * times[word]
        return np.bincount(piece[piece >= 0], share[piece >= 0], self.pieces)


def letter_runs(text: str) -> list[str]:
    """Runs of letters in lower case, long ones in stretches."""
    return [run[i:i + STRETCH] for run in _LETTERS.findall(text.lower()) for i in range(0, len(run), STRETCH)]


@dataclass
class Model:
    """Piece probabilities of each language; ``languages`` may be empty if nothing was learned."""

    languages: list[str]
    pieces: list[str]
    probabilities: np.ndarray


class Scorer:
    """Log probabilities of whole texts by every language of a model and by the even hypothesis."""

    def __init__(self, model: Model):
        self.model = model
        self.lattice = Lattice(model.pieces)
        self.keys = np.zeros(SLOTS, dtype=np.uint64)
        # One column for each language, then the even hypothesis, then the number of letters.
        self.values = np.zeros((SLOTS, len(model.languages) + 2))

    def words(self, texts: list[str]) -> np.ndarray:
        """Sums over the letter runs of each string."""
        runs, owner = [], []
        for k, text in enumerate(texts):
            found = letter_runs(text)
            runs += found
            owner += [k] * len(found)
        out = np.zeros((len(texts), self.values.shape[1]))
        order = sorted(range(len(runs)), key=lambda k: len(runs[k]))
        for i in range(0, len(order), 8192):
            some = order[i:i + 8192]
            chosen = [runs[k] for k in some]
            sizes = np.array([len(r) for r in chosen], dtype=float)
            scores = np.column_stack([self.lattice.forward(chosen, self.model.probabilities),
                                      -np.log(EVEN_LETTERS) * (sizes + 1), sizes])
            np.add.at(out, np.array(owner)[some], scores)
        return out

    def block(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Sums over each row of a block. Looked-up words are runs of ASCII letters and bytes beyond ASCII."""
        if not len(data):
            return np.zeros((len(offsets) - 1, self.values.shape[1]))
        lowered = LOWER[data]
        solid = ((lowered >= 0x61) & (lowered <= 0x7A)) | (data >= 0x80)
        begins, finishes = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        finishes[:-1] &= ~solid[1:]
        filled = offsets[:-1] < offsets[1:]
        begins[offsets[:-1][filled]] = solid[offsets[:-1][filled]]
        finishes[offsets[1:][filled] - 1] = solid[offsets[1:][filled] - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
        hashes = SpanHash(lowered).of(starts, ends)
        slots = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        values = self.values[slots]
        new = np.flatnonzero(self.keys[slots] != hashes)
        if len(new):
            unique, example, place = np.unique(hashes[new], return_index=True, return_inverse=True)
            raw, at = lowered.tobytes(), new[example]
            scored = self.words([raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            values[new] = scored[place]
            self.keys[slots[at]], self.values[slots[at]] = unique, scored
        sums = np.vstack([np.zeros((1, values.shape[1])), np.cumsum(values, axis=0)])
        firsts = np.searchsorted(starts, offsets)
        return sums[firsts[1:]] - sums[firsts[:-1]]

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        data, offsets = column_bytes(column)
        names, scores = [], []
        for first, last in row_blocks(offsets):
            own = offsets[first:last + 1] - offsets[first]
            sums = self.block(data[offsets[first]:offsets[last]], own)
            letters, logs = sums[:, -1] > 0.5, sums[:, :-1]
            if not self.model.languages:
                letters[:] = False
            best = logs[:, :-1].argmax(axis=1) if self.model.languages else np.zeros(len(logs), dtype=int)
            top = logs.max(axis=1, keepdims=True)
            shares = np.exp(logs - top)
            share = shares[np.arange(len(best)), best] / shares.sum(axis=1)
            scores.append(np.where(letters, share, 0.0))
            names += [self.model.languages[b] if known else "und" for b, known in zip(best, letters)]
        return names, np.concatenate(scores) if scores else np.empty(0)


def _counter(pieces: list[str], languages: list[str], probabilities: np.ndarray | None):
    """Expected piece counts of a task's words, for each language; equal probabilities in the first round."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces)
        sums = np.zeros((len(languages), len(pieces)))
        for batch in batches:
            tags = np.array(batch.column("lang").to_pylist(), dtype=object)
            words, times = batch.column("word").to_pylist(), batch.column("times").to_numpy()
            for k, language in enumerate(languages):
                own = sorted(np.flatnonzero(tags == language).tolist(), key=lambda i: len(words[i]))
                for i in range(0, len(own), 8192):
                    some = own[i:i + 8192]
                    current = probabilities[:, k] if probabilities is not None else np.full(len(pieces), 1 / len(pieces))
                    sums[k] += lattice.expected([words[j] for j in some], times[some], current)
        which, piece = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(which, pa.int32()), pa.array(piece, pa.int32()), pa.array(sums[which, piece])],
            names=["which", "piece", "uses"])

    return count


def _run_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            runs = letter_runs(text)
            if runs:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(runs)), pa.array(runs)], names=["lang", "word"])


def learn(labelled: DataFrame, pieces: list[str], sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Fit a model to ``labelled(doc_id, text, lang)``, at most ``sample`` documents of each language.

    Rows without text, language or id are not used. The model has one number for each piece and language.
    """
    usable = labelled.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    # Twice the sample is left to be ranked, however many rows a language has.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    ids = usable.select("doc_id", "lang", place.alias("place"))
    counts = ids.groupBy("lang").agg(F.count("*").alias("n"))
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = stored(ids.join(counts, "lang").where(F.col("place") <= F.lit(2.0 * sample * (1 << 40)) / F.col("n"))
                    .withColumn("rank", F.row_number().over(order))
                    .where(F.col("rank") <= sample).select("doc_id", "lang").distinct(), "language-sample")
    words = stored(usable.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"], "left_semi")
                   .select("lang", "text").mapInArrow(_run_words, "lang string, word string")
                   .groupBy("lang", "word").agg(F.count("*").alias("times")), "language-words")
    # One row for each language.
    languages = sorted(r["lang"] for r in chosen.select("lang").distinct().collect())
    if not languages:
        return Model([], pieces, np.zeros((len(pieces), 0)))
    probabilities = None
    for _ in range(rounds):
        uses = np.full((len(pieces), len(languages)), SMOOTHING)
        counted = (words.mapInArrow(_counter(pieces, languages, probabilities), "which int, piece int, uses double")
                   .groupBy("which", "piece").agg(F.sum("uses").alias("uses")))
        table = counted.toArrow()  # at most one row for each piece and language
        uses[table["piece"].to_numpy(), table["which"].to_numpy()] += table["uses"].to_numpy()
        probabilities = uses / uses.sum(axis=0)
    return Model(languages, pieces, probabilities)


def _predictor(model: Model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            names, scores = scorer.predict(batch.column("text"))
            yield batch.drop_columns(["text"]).append_column("lang_pred", pa.array(names, pa.string())) \
                .append_column("score", pa.array(scores, pa.float64()))

    return predict


def predict(documents: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The columns named, then ``lang_pred`` and ``score``, from the text alone."""
    chosen = documents.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    shape = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in chosen.drop("text").schema)
    return chosen.mapInArrow(_predictor(model), shape + "lang_pred string, score double")


def _keeper(model: Model):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            if model.languages:
                _, scores = scorer.predict(batch.column("text"))
                yield batch.filter(pa.array(scores >= KEPT_SCORE))
            else:
                yield batch.filter(pa.array([bool(t and _LETTERS.search(t)) for t in batch.column("text").to_pylist()], pa.bool_()))

    return keep


def in_known_language(documents: DataFrame, model: Model) -> DataFrame:
    """The rows whose text has a letter and is not far likelier as even letters than in any language; all columns stay.

    If nothing was learned, only texts without a letter go.
    """
    return documents.mapInArrow(freed(_keeper(model)), documents.schema)


def is_held_out() -> F.Column:
    """True for the third of the documents that are never learned from; false without an id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def languages(documents: DataFrame, pieces: list[str]) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``documents(doc_id, text, lang)``.

    Learned from the labelled rows that are not held out; predicted from the text only. ``score`` is the
    share of the predicted language among all languages and the even hypothesis. A text that is null or
    has no letter is ``und`` with score 0, as is every text if no row has a label. Ties go to the language
    first in order. Other columns are ignored; an empty table gives no rows.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = learn(docs.where(~is_held_out()), pieces)
    return predict(docs.withColumn("held_out", is_held_out()), model, "doc_id", "held_out")
